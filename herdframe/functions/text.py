"""Text normalisation, extraction and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from herdframe.functions.base import ColumnLike, col, text_key

# fixed values: registry prefixes that mark a complete registration number
KNOWN_PREFIXES = ["BIR", "SIM", "HER", "RAN", "BSH", "CIA", "RDP", "CHA", "AAA", "BGR"]
# fixed values: registries whose numbers carry the prefix of both parents without a digit check
SHARED_PREFIXES = ["SIM", "HER", "RAN", "BSH", "CIA", "RDP", "CHA"]


def squish(c: ColumnLike) -> Column:
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def strip_chars(c: ColumnLike, punct: bool = True, space: bool = True) -> Column:
    classes = (r"\p{Punct}" if punct else "") + (r"\s" if space else "")
    return F.regexp_replace(col(c), f"[{classes}]", "") if classes else col(c)


def normalize_text(c: ColumnLike) -> Column:
    """Upper case with single inner blanks and no outer blanks."""
    return squish(F.upper(col(c)))


def extract(c: ColumnLike, pattern: str) -> Column:
    """First match of a Java pattern, null when there is none."""
    return F.regexp_substr(col(c), F.lit(pattern))


def clean_numeric(c: ColumnLike) -> Column:
    """Drop non-numeric text around a number, then cast."""
    return extract(col(c).cast("string"), r"-?\d+(\.\d+)?").try_cast("double")


def pad_left(c: ColumnLike, width: int, fill: str = "0") -> Column:
    """Left pad without ever cutting a longer value."""
    text = col(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, fill))


def sentence_case(c: ColumnLike) -> Column:
    text = col(c)
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def padded_international_id(prefix: str, sex: ColumnLike, number: ColumnLike, width: int = 12) -> Column:
    """Breed and country prefix, sex letter, zero-padded number; null parts read ``NA``."""
    return text_key(F.lit(prefix), col(sex), pad_left(F.coalesce(col(number).cast("string"), F.lit("NA")), width))


def year_from_name(name: ColumnLike) -> Column:
    return extract(name, r"(?<=_)\d{4}").cast("int")


def group_from_name(name: ColumnLike) -> Column:
    return extract(name, r"(?<=_)[A-Za-z0-9]+(?=_)")


def chr_of(marker: ColumnLike) -> Column:
    return extract(marker, r"\d{1,2}(?=:)").try_cast("int")


def pos_of(marker: ColumnLike) -> Column:
    return extract(marker, r"(?<=:)\d+").try_cast("bigint")


def prefix_registration(
    c: ColumnLike,
    keep: list[str],
    swap: dict[str, str] | None = None,
    default: str = "",
    missing: str = "0",
) -> Column:
    """Registry prefixes by priority.

    ``swap`` rewrites leading association codes (for example the code another herd book uses for the same
    registry), numbers that then start with a prefix in ``keep`` stay, all others get ``default`` in front.
    Null becomes ``missing``.
    """
    text = col(c).cast("string")
    for old, new in (swap or {}).items():
        text = F.regexp_replace(text, f"^{old}", new)
    kept = text.rlike("^(" + "|".join(keep) + ")") if keep else F.lit(False)
    return F.when(text.isNull(), F.lit(missing)).when(kept, text).otherwise(F.concat(F.lit(default), text))


def _starts(c: Column, lead: str) -> Column:
    return c.rlike(f"^({lead})")


def infer_prefix(
    number: ColumnLike, own: ColumnLike, first: ColumnLike, second: ColumnLike, role: str = "animal", animal_number: ColumnLike | None = None
) -> Column:
    """Registry prefix of an animal's, a sire's or a dam's number, from its own registry or from its two relatives.

    ``first`` and ``second`` are the registries of the relatives: sire and dam for an animal; the animal and the other parent for a
    parent. The number stays bare when no rule applies. Rules by priority: own registry; both relatives agree on a registry without
    digit rule; both AAA and a leading 1; one HER and a leading 4; for a sire of an animal numbered SAV or BAT the lead
    alone; for parents one AAA and a leading 1, CHA with the letter of the parent's sex (with E before it only for the animal's own
    registry), and RDP unless the number leads with 1.
    """
    if role not in ("animal", "sire", "dam"):
        raise ValueError(f"unknown role {role}")
    text, mine, a, b = col(number), col(own), col(first), col(second)
    is_ = lambda side, registry: F.coalesce(side == registry, F.lit(False))
    either = lambda registry: is_(a, registry) | is_(b, registry)
    made = lambda registry: text_key(F.lit(registry), text)
    out = F.when(mine.isNotNull(), text_key(mine, text))
    out = out.when((a == b) & a.isin(*SHARED_PREFIXES), text_key(a, text))
    out = out.when(is_(a, "AAA") & is_(b, "AAA") & _starts(text, "1"), made("AAA"))
    out = out.when(either("HER") & _starts(text, "4"), made("HER"))
    if role == "sire" and animal_number is not None:
        for lead, registry in (("4", "HER"), ("M", "CHA"), ("1", "AAA")):
            out = out.when(col(animal_number).rlike("SAV|BAT") & _starts(text, lead), made(registry))
    if role != "animal":
        letter = "M" if role == "sire" else "F"
        out = out.when(either("AAA") & _starts(text, "1"), made("AAA"))
        out = out.when(is_(a, "CHA") & _starts(text, f"{letter}|E{letter}"), made("CHA"))
        out = out.when(is_(b, "CHA") & _starts(text, letter), made("CHA"))
        out = out.when(either("RDP") & ~_starts(text, "1"), made("RDP"))
    return out.otherwise(text)


def known_registration(c: ColumnLike) -> Column:
    """Null unless the value starts with a known registry prefix."""
    text = col(c)
    return F.when(text.rlike("^(" + "|".join(KNOWN_PREFIXES) + ")"), text)


def with_thousands(c: ColumnLike) -> Column:
    whole = col(c).cast("bigint")
    # small numbers have no mark and need no formatting, which costs more than making the pairs they stand for
    return F.when(whole.between(-999, 999), whole.cast("string")).otherwise(F.format_number(whole, 0))


def percent(c: ColumnLike, digits: int = 1) -> Column:
    return F.concat(F.format_number(col(c).cast("double") * 100, digits), F.lit("%"))


def marker_label(chrom: ColumnLike, pos: ColumnLike) -> Column:
    """``chr:1,234`` label."""
    return F.concat(col(chrom).cast("string"), F.lit(":"), with_thousands(pos))


def span_label(chrom: ColumnLike, start: ColumnLike, end: ColumnLike) -> Column:
    """``chr:1,234-5,678``, or one position when both ends are equal."""
    one = marker_label(chrom, start)
    return F.when(col(start) == col(end), one).otherwise(F.concat(one, F.lit("-"), with_thousands(end)))
