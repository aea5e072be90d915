"""Domain columns of animal records: ages, seasons, groups, codes, breed fractions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from herdframe.functions.base import ColumnLike, col, if_else3, recode, text_key
from herdframe.functions.text import extract

# fixed values: code standardisation tables, target -> spellings
SEX_CODES = {"F": ["C", "COW", "F"], "M": ["B", "M"], None: ["U"]}
BREED_CODES = {"AN": ["ANGUS"], "SIM": ["SIMAN"], "GEL": ["BAL"], "HFD": ["Hereford"]}
COLOR_CODES = {
    "BLACK": ["BLK", "B", "8LK"],
    "RED WHITE FACE": ["REDWHITEFACE", "R/WF", "RWF"],
    "BLACK WHITE FACE": ["BWF"],
    "RED SPOTTED": ["REDSPOTTED"],
    "GREY": ["SMOKE"],
    "RED": ["ED", "R"],
    "YELLOW": ["Y"],
    None: ["GB", "BM", "RM", "YM", "BB", "RB"],
}
FESCUE_CODES = {"YES": ["Y", "TRUE"], "NO": ["N", "FALSE"]}
# fixed values: accepted codes after cleaning
BREEDS_ALLOWED = ["AN", "ANR", "BG", "CHIA", "CHA", "CROS", "SIM", "HFD", "SIMB", "MAAN", "GEL", "SH", "BRN"]
COLORS_ALLOWED = [
    "BLACK", "BLACK ROAN", "BLACK SPOTTED", "BLACK WHITE FACE", "BROWN", "BRINDLE", "RED", "RED ROAN",
    "RED SPOTTED", "RED WHITE FACE", "WHITE", "GREY", "YELLOW",
]
# fixed values: breed code -> registry prefix
REGISTRY_KEEP = {"AAA": ["AN"], "RAN": ["ANR"], "BGR": ["BG"], "BSW": ["BRN"], "RDP": ["MAAN"], "HER": ["HFD"]}
# fixed values: herds with one calving season, herds on endophyte-infected fescue
SEASON_BY_HERD = {"UMCT": "SPRING", "UMF": "FALL"}
FESCUE_HERDS = ["BAT", "CRC"]
# fixed values: age group bins (label, lowest age, highest age or None), the variants in use
AGE_BINS = {
    "growing": [("yearling", 1, 1), ("growing", 2, 3), ("mature", 4, 9), ("old", 10, None)],
    "twothree": [("yearling", 1, 1), ("twothree", 2, 3), ("mature", 4, 7), ("old", 8, None)],
    "first_calf": [("yearling", 1, 1), ("fch", 2, 2), ("three", 3, 3), ("mature", 4, None)],
    "coded": [("1", 1, 1), ("2", 2, 3), ("3", 4, 7), ("4", 8, None)],
}


def sold_code(c: ColumnLike) -> Column:
    return F.coalesce(col(c).isin("YES", "SOLD"), F.lit(False))


def sex_code(c: ColumnLike) -> Column:
    return recode(c, SEX_CODES)


def breed_code(c: ColumnLike) -> Column:
    return recode(c, BREED_CODES)


def color_code(c: ColumnLike, breed: ColumnLike | None = None, default_from_breed: bool = False) -> Column:
    """Colour spelling; with the flag a missing colour takes the usual colour of two breeds."""
    out = recode(F.upper(col(c)), COLOR_CODES)
    if default_from_breed and breed is not None:
        usual = F.when(col(breed) == "AN", "BLACK").when(col(breed) == "HFD", "RED WHITE FACE")
        out = F.coalesce(out, usual)
    return out


def season_code(c: ColumnLike, sex: ColumnLike | None = None) -> Column:
    text = F.upper(col(c))
    known = F.when(text.startswith("S"), "SPRING").when(text.startswith("F"), "FALL")
    return known if sex is None else F.when(F.coalesce(col(sex) != "M", F.lit(True)), known)


def fescue_code(c: ColumnLike) -> Column:
    return recode(c, FESCUE_CODES)


def excel_serial_to_date(c: ColumnLike) -> Column:
    return F.date_add(F.lit("1899-12-30").cast("date"), col(c).try_cast("double").cast("int"))


def may_first(year: ColumnLike) -> Column:
    return F.make_date(col(year).cast("int"), F.lit(5), F.lit(1))


def age_in_days(scored: ColumnLike, dob: ColumnLike, raw: ColumnLike, year: ColumnLike) -> Column:
    """Days of age at scoring (or at 1 May of the year) from a birth date, else from a birth date hidden in
    the raw age text: ``m/d/yyyy`` or a spreadsheet serial above 1000."""
    text = F.regexp_replace(col(raw).cast("string"), r"YEARS|[ \t]", "")
    typed = F.when(text.contains("/"), F.try_to_date(text, "M/d/yyyy"))
    serial = F.when(text.try_cast("double") > 1000, excel_serial_to_date(text))
    born = F.coalesce(col(dob), typed, serial)
    return F.date_diff(F.coalesce(col(scored), may_first(year)), born)


def age_class(days: ColumnLike) -> Column:
    """Class n for days in [365n-90, 365n+274], day 274 counts as class 1, classes 1 to 21."""
    d = col(days)
    return F.when(d.between(274, 7939), F.greatest(F.lit(1), F.floor((d + 90) / 365).cast("int")))


def age_in_years(raw: ColumnLike, klass: ColumnLike) -> Column:
    text = F.regexp_replace(col(raw).cast("string"), r"YEARS|[ \t]", "")
    return F.coalesce(col(klass).cast("int"), text.try_cast("double").try_cast("int"))


def age_group(age: ColumnLike, bins: str | list = "growing") -> Column:
    table = AGE_BINS[bins] if isinstance(bins, str) else bins
    a = col(age)
    out = None
    for label, low, high in table:
        cond = (a >= low) if high is None else a.between(low, high)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def season_default(
    herd: ColumnLike, dob: ColumnLike, season: ColumnLike, by_herd: dict[str, str] | None = None
) -> Column:
    """Herd rule first, then the recorded season, then the half year of birth."""
    fixed = None
    for name, value in (SEASON_BY_HERD if by_herd is None else by_herd).items():
        cond = col(herd) == name
        fixed = F.when(cond, value) if fixed is None else fixed.when(cond, value)
    born = F.when(F.month(col(dob)).between(1, 6), "SPRING").when(F.month(col(dob)).between(7, 12), "FALL")
    parts = [col(season), born] if fixed is None else [fixed, col(season), born]
    return F.coalesce(*parts)


def fescue_default(herd: ColumnLike, fescue: ColumnLike, herds: list[str] | None = None) -> Column:
    return if_else3(col(herd).isin(*(herds or FESCUE_HERDS)), "YES", col(fescue))


def full_registration(
    full: ColumnLike, breed: ColumnLike, registration: ColumnLike, herd: ColumnLike, animal: ColumnLike,
    temp: ColumnLike, prefixes: dict | None = None, keep_other: bool = True,
) -> Column:
    """Known pedigree id, else prefix + registration, else herd + animal + temporary id."""
    prefix = recode(breed, REGISTRY_KEEP if prefixes is None else prefixes, keep_other)
    made = F.when(col(registration).isNotNull(), text_key(prefix, registration)).otherwise(text_key(herd, animal, temp))
    return F.coalesce(col(full).cast("string"), made)


def f_to_c(c: ColumnLike) -> Column:
    return (col(c) - 32) * 5 / 9


def fraction_of(text: ColumnLike, code: str) -> Column:
    """Share of one breed in text such as ``3/4 AR 1/4 SM``, ``12.5% AR``, ``PB AR`` (whole)."""
    source = col(text)
    ratio = extract(source, rf"\d+/\d+(?= {code}\b)")
    num = F.split(ratio, "/").getItem(0).try_cast("double")
    den = F.split(ratio, "/").getItem(1).try_cast("double")
    pct = extract(source, rf"[0-9.]+(?=% {code}\b)").try_cast("double") / 100
    return (
        F.when(source.isin(f"PB {code}", f"100% {code}"), F.lit(1.0))
        .when(ratio.isNotNull(), F.try_divide(num, den))
        .otherwise(pct)
    )


def merge_breeds(parts: list[ColumnLike], cap: float = 1.0) -> Column:
    """Sum of shares that count as one breed, never above the cap."""
    total = reduce(lambda a, b: a + b, [F.coalesce(col(p).cast("double"), F.lit(0.0)) for p in parts])
    return F.least(total, F.lit(cap))


def red_angus_share(ar: ColumnLike, an: ColumnLike, others: list[ColumnLike]) -> Column:
    """Red and black lines count together when no third breed is present; capped at one."""
    a, b = col(ar), col(an)
    alone = (a != 0) & (b != 0)
    for other in others:
        alone = alone & (col(other) == 0)
    return F.least(F.when(alone, a + b).otherwise(a), F.lit(1.0))


def pure_label(shares: dict[str, ColumnLike], default: Column | None = None) -> Column:
    """First breed with a share of exactly one, by the order given."""
    out = None
    for label, share in shares.items():
        cond = F.round(col(share), 9) == 1.0
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(F.lit("CROS") if default is None else default)


def breed_label(rules: list[tuple[str, Column]], other: str = "Crossbred or other") -> Column:
    """First rule that holds names the breed."""
    out = None
    for label, cond in rules:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(other)


def dominant_breed(shares: dict[str, ColumnLike], threshold: float = 0.625) -> Column:
    return breed_label([(label, col(share) >= threshold) for label, share in shares.items()])
