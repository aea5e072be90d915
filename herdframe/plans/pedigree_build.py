"""One pedigree from many registries: one parametrised job per registry, then union, fill, conflicts, orphans."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.functions.text import infer_prefix, known_registration, padded_international_id, prefix_registration, strip_chars
from herdframe.operators.aggregates import conflict_to, keep_group_size
from herdframe.operators.joins import anti, id_cascade
from herdframe.operators.keys import left_join_known, null_safe_join
from herdframe.operators.pedigree import sex_from_role
from herdframe.operators.shape import wide_pedigree_to_long
from herdframe.operators.windows import keep_first

REGS = ["full_reg", "sire_reg", "dam_reg"]


@dataclass(frozen=True)
class Registry:
    """What differs between registries."""

    source: str
    prefix: str
    country_prefix: str
    keep: tuple[str, ...] = ()
    swap: dict[str, str] = field(default_factory=dict)
    clean: bool = True
    default_sex: str | None = None


def registry_rows(wide: DataFrame, triples: list[tuple[str, str, str]] | None, cfg: Registry, register: DataFrame, members: DataFrame) -> DataFrame:
    """Pedigree rows of one registry: (animal, sire, dam) rows, sex from role, lab ids, prefixes, one row per animal.

    ``register``: lab_id, breed_assoc_reg, international_id. ``members``: full_reg (bare number) with herd ids.
    """
    rows = wide_pedigree_to_long(wide, triples) if triples else wide.select(*REGS).distinct()
    if cfg.clean:
        rows = rows.withColumns({c: F.upper(F.regexp_replace(strip_chars(F.col(c).cast("string")), "[xX]", "")) for c in REGS})
    rows = rows.filter(F.col("full_reg").isNotNull()).distinct()
    rows = null_safe_join(rows, members, ["full_reg"]) if members is not None else rows
    rows = sex_from_role(rows, "sex", cfg.default_sex)
    rows = rows.withColumn("__iid", padded_international_id(cfg.country_prefix, "sex", "full_reg"))
    steps = [("full_reg", register, "breed_assoc_reg"), ("__iid", register, "international_id")]
    rows = id_cascade(rows, steps, "lab_id").drop("__iid")
    rows = rows.withColumns({c: prefix_registration(c, list(cfg.keep), cfg.swap, cfg.prefix) for c in REGS})
    order = [F.desc_nulls_last("sire_reg"), F.desc_nulls_last("dam_reg"), F.desc_nulls_last("lab_id")]
    rest = [F.asc_nulls_last(c) for c in rows.columns if c not in ("full_reg", "sire_reg", "dam_reg", "lab_id")]
    return keep_first(rows, ["full_reg"], order + rest).withColumn("source", F.lit(cfg.source))


def _fill_within(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Missing values from other rows of the same key (the smallest known value, so the result is repeatable)."""
    known = df.groupBy(*keys).agg(*[F.min(c).alias(f"__{c}") for c in cols])
    joined = null_safe_join(df, known, keys)
    return joined.withColumns({c: F.coalesce(c, f"__{c}") for c in cols}).drop(*[f"__{c}" for c in cols])


def combine(parts: list[DataFrame]) -> DataFrame:
    """Union of registries and orphans: fill, settle parent conflicts, drop unusable ids."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    out = out.withColumns({c: F.coalesce(strip_chars(F.col(c).cast("string")), F.lit("0")) for c in REGS}).distinct()
    out = _fill_within(out, ["full_reg"], ["lab_id"]).distinct()
    herd = [c for c in ("farm_id", "animal_id", "temp_id") if c in out.columns]
    if herd:
        out = _fill_within(out, ["lab_id", "full_reg"], herd)
    out = conflict_to(out, ["lab_id", "full_reg"], {"sire_reg": "0", "dam_reg": "0"}).distinct()
    out = out.withColumn("dam_reg", F.when(F.col("dam_reg") == F.col("full_reg"), "0").otherwise(F.col("dam_reg")))
    out = keep_group_size(out, ["full_reg"], 1, 1)
    if "animal_id" in herd:
        # an animal with numbers of two registries keeps the other one
        who = ["lab_id", *herd]
        several = out.groupBy(*who).agg((F.min("full_reg") < F.max("full_reg")).alias("__several"))
        out = null_safe_join(out, several, who)
        second = F.col("__several") & F.col("animal_id").isNotNull() & F.col("full_reg").contains("SIM")
        out = out.withColumn("full_reg", F.when(second, "0").otherwise(F.col("full_reg"))).drop("__several")
    out = out.withColumns({c: F.when(F.col(c).endswith("NA"), "0").otherwise(F.col(c)) for c in REGS})
    return out.filter("full_reg <> '0'")


def orphan_rows(animals: DataFrame, ped: DataFrame, register: DataFrame) -> DataFrame:
    """Recorded animals the pedigree lacks, with parents from the register and prefixes inferred from relatives.

    ``register``: lab_id, assoc, sire_reg, sire_assoc, dam_reg, dam_assoc and, if known, breed_code (Hereford numbers lose their P).
    Animals without a herd and without a known prefix go; animals of a herd without a number are named by their herd ids.
    """
    ids = ["lab_id", "farm_id", "animal_id", "temp_id"]
    lost = anti(animals.select(*ids, F.col("registration_number").alias("full_reg")).distinct(), ped, ids)
    rows = left_join_known(lost, register, "lab_id")
    rows = rows.withColumns({c: F.regexp_replace(strip_chars(F.col(c).cast("string")), "[xX]", "") for c in REGS})
    if "breed_code" in register.columns:
        hereford = F.coalesce(F.col("breed_code") == "HFD", F.lit(False))
        rows = rows.withColumns({c: F.when(hereford, F.regexp_replace(c, "[pP]", "")).otherwise(F.col(c)) for c in REGS})
    rows = rows.withColumns({c: F.regexp_replace(c, "^AAN", "AAA") for c in ("assoc", "sire_assoc", "dam_assoc")})
    made = {
        "full_reg": infer_prefix("full_reg", "assoc", "sire_assoc", "dam_assoc"),
        "sire_reg": infer_prefix("sire_reg", "sire_assoc", "assoc", "dam_assoc", "sire", "full_reg"),
        "dam_reg": infer_prefix("dam_reg", "dam_assoc", "assoc", "sire_assoc", "dam"),
    }
    rows = rows.withColumns(made)
    rows = rows.withColumns({c: known_registration(c) for c in ("sire_reg", "dam_reg")})
    named = F.when(F.col("farm_id").isNull(), known_registration("full_reg")).otherwise(
        F.coalesce("full_reg", F.concat_ws("", "farm_id", "animal_id", F.col("temp_id").cast("string")))
    )
    return rows.withColumn("full_reg", named).filter(F.col("full_reg").isNotNull()).select(*ids, *REGS)
