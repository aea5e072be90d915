"""From record files to cleaned records: identities first, then values. All herds run in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.functions import records as R
from herdframe.functions.base import if_else3, text_key
from herdframe.functions.text import clean_numeric, extract, normalize_text, pad_left, strip_chars
from herdframe.operators.aggregates import any_flag, conflict_to, find_dup
from herdframe.operators.checks import verify
from herdframe.operators.joins import id_cascade, resolve_multi_match
from herdframe.operators.keys import attach, left_join_known, null_safe_join
from herdframe.operators.ordered import dense_code, hash_bins, running
from herdframe.operators.shape import add_missing_columns, stack_pairs
from herdframe.operators.windows import fill_downup, impute_age
from herdframe.session import cut_lineage

IDS = ["registration_number", "animal_id", "barcode"]


def normalise_records(records: DataFrame) -> DataFrame:
    """Id columns exist, every text is upper case without stray blanks."""
    rows = add_missing_columns(records, {c: "string" for c in [*IDS, "breed_code"]})
    texts = [c for c, t in rows.dtypes if t == "string" and c != "farm_id"]
    return rows.withColumns({c: normalize_text(c) for c in texts})


def animal_keys(rows: DataFrame) -> DataFrame:
    """Distinct animals of a herd: ids without blanks and marks. Combinations of the first year an animal id is
    seen in count; ids missing there come from the earliest later year. Rows without an animal id stand alone."""
    bare = rows.select("farm_id", "year", "breed_code", *[strip_chars(c).alias(c) for c in IDS])
    bare = bare.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in IDS})
    who = ["farm_id", "animal_id"]
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct("year", c))).alias(f"__{c}")
    facts = bare.filter("animal_id is not null").groupBy(*who).agg(
        F.min("year").alias("__year"), *[first(c) for c in ("registration_number", "barcode", "breed_code")]
    )
    seen = bare.join(facts, who, "left")
    seen = seen.filter(F.col("animal_id").isNull() | F.col("year").eqNullSafe(F.col("__year")))
    filled = seen.withColumns({c: F.coalesce(c, f"__{c}") for c in ("registration_number", "barcode", "breed_code")})
    return filled.select("farm_id", *IDS, "breed_code").distinct()


def match_animals(keys: DataFrame, register: DataFrame, bulk: str = "RAAA|ASA|Teagasc", prefixed: list[str] | None = None) -> DataFrame:
    """Lab ids from the register by an ordered list of id pairs, then one id per animal and a temporary id per herd.

    ``register``: lab_id, reg, ref_id2, ref_id3, breed_assoc_reg, comment. Herds in ``prefixed`` write the numbers of
    one registry without its prefix.
    """
    reg = F.col("registration_number")
    bare = F.col("farm_id").isin(*(prefixed or [])) & (F.col("breed_code") == "GEL") & ~reg.startswith("AMGV")
    keyed = keys.withColumn("registration_number", F.when(bare, F.concat(F.lit("AMGV"), reg)).otherwise(reg))
    keyed = keyed.withColumn("reg2", if_else3(reg.startswith("6"), F.concat(F.lit("BIR"), reg), reg))
    register = add_missing_columns(register, {c: "string" for c in ("ref_id2", "ref_id3", "breed_assoc_reg", "comment")})
    order = [
        ("registration_number", "reg"), ("barcode", "reg"), ("barcode", "ref_id2"), ("registration_number", "ref_id2"),
        ("barcode", "ref_id3"), ("registration_number", "ref_id3"), ("registration_number", "breed_assoc_reg"),
        ("reg2", "reg"), ("reg2", "breed_assoc_reg"),
    ]
    # the key table is far smaller than the records and is read many times below: stored once
    matched = cut_lineage(id_cascade(keyed, [(a, register, b) for a, b in order], "lab_id"))
    notes = register.select("lab_id", F.col("comment").rlike(bulk).alias("__bulk"))
    noted = left_join_known(matched, notes, "lab_id").withColumn("__bulk", F.coalesce("__bulk", F.lit(False)))
    single = resolve_multi_match(noted, ["farm_id", *IDS], "lab_id", "__bulk").drop("__bulk", "reg2")
    text = text_key(*IDS, F.col("lab_id"), F.col("breed_code"), sep="|", missing="")
    marked = single.withColumn("__digest", F.md5(text))
    ids = running(marked, ["farm_id"], hash_bins("__digest"), ["__digest"], {"temp_id": ("sum", F.lit(1))})
    return ids.withColumn("temp_id", F.col("temp_id").cast("bigint")).drop("__digest")


def attach_animals(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Temporary ids for record rows by registration, barcode, animal id inside the herd; ids of the key replace
    those of the rows. Every row must find its animal."""
    herd = lambda c: F.when(F.col(c).isNotNull(), F.concat_ws("|", "farm_id", c))
    bare = rows.withColumns({f"__{c}": herd(c) for c in IDS})
    bare = bare.withColumns({f"__{c}": F.concat_ws("|", "farm_id", strip_chars(F.col(c))) for c in IDS})
    bare = bare.withColumns({f"__{c}": F.when(F.col(c).isNotNull(), F.col(f"__{c}")) for c in IDS})
    lookup = keys.select("temp_id", *[herd(c).alias(f"k_{c}") for c in IDS])
    steps = [(f"__{c}", lookup, f"k_{c}") for c in ("registration_number", "barcode", "animal_id")]
    found = id_cascade(bare, steps, "temp_id").drop(*[f"__{c}" for c in IDS], *IDS)
    return null_safe_join(found, keys.select("farm_id", "temp_id", *IDS, "lab_id"), ["farm_id", "temp_id"])


def clean_farm_records(records: DataFrame, register: DataFrame, check: bool = True, **match) -> DataFrame:
    """Normalise, build the animal key, match it, put the ids back on the records."""
    rows = normalise_records(records)
    keys = cut_lineage(match_animals(animal_keys(rows), register, **match))
    out = attach_animals(rows, keys)
    return verify(out, F.col("temp_id").isNotNull(), "record without an animal") if check else out


def key_duplicates(keys: DataFrame) -> dict[str, DataFrame]:
    """Rows with repeated ids, per id column."""
    return {c: find_dup(keys, ["farm_id", c], c) for c in [*IDS, "lab_id"]}


def clean_joined(
    joined: DataFrame, register: DataFrame, extra: DataFrame | None = None, default_colors: bool = False, check: bool = True
) -> DataFrame:
    """Values of joined records: sold, age, score, sex, breed, colour, date, season, fescue, ages filled in.

    Each step follows the cleaning rules of the records; checks raise when a value outside the accepted codes is left.
    ``extra`` holds records of herds that are cleaned on their own.
    """
    animal = ["farm_id", "temp_id"]
    ensure = (lambda df, cond, text: verify(df, cond, text)) if check else (lambda df, cond, text: df)
    maybe = lambda c, ok: F.col(c).isNull() | F.col(c).isin(*ok)
    rows = joined.withColumn("score_date", F.col("score_date").cast("date"))
    rows = any_flag(rows.withColumn("sold", R.sold_code("sold")), animal, "sold")
    born = register.select("lab_id", F.col("dob").cast("date").alias("dob")).filter("lab_id is not null")
    rows = left_join_known(rows, born, "lab_id")
    rows = rows.withColumn("__days", R.age_in_days("score_date", "dob", "age", "year"))
    rows = rows.withColumn("age", R.age_in_years("age", R.age_class("__days")))
    # each step below reads its rows more than once: stored, or every step would double the work of those before it
    rows = cut_lineage(rows.filter((F.col("__days") >= 274) | F.col("__days").isNull()).drop("__days"))
    rows = fill_downup(rows, [*animal, "year"], ["score_date"], ["age"])
    rows = ensure(rows, F.col("age").isNull() | F.col("age").between(1, 22), "age")
    rows = rows.filter(F.col("score").isNotNull()).withColumn("score", clean_numeric("score"))
    if extra is not None:
        rows = rows.unionByName(extra.withColumn("fescue", F.lit("YES")), allowMissingColumns=True)
    rows = ensure(rows, F.col("score").between(1, 5), "score")
    rows = rows.withColumns({"sex": R.sex_code("sex"), "color": R.color_code("color", R.breed_code("breed_code"), default_colors)})
    rows = ensure(rows, maybe("sex", ["F", "M"]), "sex")
    rows = ensure(rows.withColumn("breed_code", R.breed_code("breed_code")), maybe("breed_code", R.BREEDS_ALLOWED), "breed")
    rows = ensure(rows, maybe("color", R.COLORS_ALLOWED), "color")
    rows = cut_lineage(one_sex(cut_lineage(rows), animal))
    rows = fill_downup(rows, animal, ["year", "score_date"], ["color"])
    rows = ensure(rows, F.col("score_date").isNull() | (F.year("score_date") == F.col("year")), "year of score date")
    rows = rows.withColumn("season", R.season_code("season", "sex")).withColumn("fescue", R.fescue_code("fescue"))
    rows = ensure(rows, maybe("fescue", ["YES", "NO"]), "fescue").distinct()
    return impute_age(cut_lineage(rows), animal)


def one_sex(rows: DataFrame, animal: list[str]) -> DataFrame:
    """Animals recorded with two sexes go; the others carry their one known sex on all rows. One aggregation does
    what a fill followed by a consistency filter would do."""
    facts = rows.groupBy(*animal).agg(F.min("sex").alias("__low"), F.max("sex").alias("__high"))
    joined = attach(rows, facts, animal).filter(F.col("__low").eqNullSafe(F.col("__high")))
    return joined.withColumn("sex", F.col("__low")).drop("__low", "__high")


def herd_sheets(sheets: list[DataFrame], pairs: list[list[tuple[str, str]]], keep: list[str]) -> DataFrame:
    """Sheets with several (date, score) column pairs to one long table."""
    out = None
    for sheet, columns in zip(sheets, pairs, strict=True):
        ids = [c for c in keep if c in sheet.columns]
        long = stack_pairs(sheet, ids, columns)
        out = long if out is None else out.unionByName(long, allowMissingColumns=True)
    return out


def clean_herd_sheets(
    rows: DataFrame, register: DataFrame, fall_herds: list[str], months: tuple[int, int] = (3, 8)
) -> DataFrame:
    """University-type herds: repair ids, keep scoring months of the sheet's year, match, fill, settle breeds.

    ``rows``: registration_number, animal_id, farm_id, year, sex, breed_code, color, age, season, fescue, comment,
    score_date, score, dna_id.
    """
    reg = F.col("registration_number")
    animal = F.coalesce("animal_id", extract(reg, r"(?<=SAV|BAT)[A-Za-z0-9]+$"))
    sex = F.coalesce("sex", extract(reg, "F|M"))
    rows = rows.withColumns({"animal_id": animal, "sex": sex})
    tidy_id = pad_left("animal_id", 4)
    lead = F.when(reg.isNotNull(), text_key(extract(reg, "F|M"))).otherwise(text_key("sex"))
    made = F.when(reg.isNotNull() | F.col("animal_id").isNotNull(), F.concat(lead, F.lit("00UA-"), text_key("farm_id", tidy_id)))
    rows = rows.withColumns({"__reg": made, "__animal": tidy_id})
    in_season = F.month("score_date").between(*months) & (F.year("score_date") == F.col("year"))
    rows = rows.filter(in_season)
    steps = [("__reg", register, "reg"), ("registration_number", register, "reg"), ("dna_id", register, "ref_id2")]
    rows = id_cascade(rows, steps, "lab_id")
    rows = rows.drop("registration_number", "animal_id", "dna_id").withColumnsRenamed(
        {"__reg": "registration_number", "__animal": "animal_id"}
    )
    fall = F.col("farm_id").isin(*fall_herds)
    rows = rows.withColumns(
        {
            "season": if_else3(fall, "FALL", F.col("season")), "fescue": if_else3(fall, "YES", F.col("fescue")),
            "age": F.col("age").try_cast("int"), "score": F.col("score").try_cast("int"),
        }
    )
    rows = fill_downup(rows, ["registration_number"], ["score_date"], ["breed_code", "color", "lab_id"])
    rows = fill_downup(rows, ["registration_number", "score_date"], ["year"], ["age", "comment", "fescue", "season"])
    rows = rows.distinct().withColumn("breed_code", F.coalesce("breed_code", F.lit("CROS")))
    # the filled table is read several times below
    rows = cut_lineage(impute_age(rows, ["registration_number", "animal_id"]))
    rows = rows.withColumn("breed_code", R.breed_code("breed_code"))
    rows = conflict_to(rows, ["registration_number", "farm_id", "lab_id"], {"breed_code": "CROS"})
    return dense_code(rows, "registration_number", ["farm_id"], "temp_id")
