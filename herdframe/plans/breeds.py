"""Breed composition: registry tables to shares, matched to animals, labelled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdframe.functions.base import recode
from herdframe.functions.records import REGISTRY_KEEP, breed_label, full_registration, merge_breeds, pure_label, red_angus_share
from herdframe.operators.aggregates import keep_group_size
from herdframe.operators.joins import coalesce_join, id_cascade
from herdframe.operators.ordered import row_ids
from herdframe.operators.shape import pivot_wider
from herdframe.operators.windows import keep_first

SHARES = ["an", "ar", "br", "chi", "gv", "hfd", "sim"]
# fixed values: registry breed codes behind each share column
SHARE_CODES = {"an": ["AN"], "ar": ["AR"], "br": ["BR"], "chi": ["CA"], "gv": ["GV"], "hfd": ["HH", "HP"], "sim": ["SM", "CS"]}
# fixed values: spellings of the final breed label
LABELS = {"CROS": ["CROS", "cross", "MX"], "SIM": ["SIM", "SM"], "RAN": ["RAN", "AR"]}


def registry_shares(
    parts: DataFrame, scale: float, source: str, codes: dict[str, list[str]] = SHARE_CODES, unique_only: bool = False
) -> DataFrame:
    """Long registry rows (registration_number, brd, pct) to one row of shares per animal with a label and an id.

    Breeds that count as one are added up, shares are capped at one. ``unique_only`` drops breeds listed twice.
    """
    rows = parts.filter(F.col("pct").isNotNull()).withColumn("pct", F.col("pct") / scale)
    if unique_only:
        rows = keep_group_size(rows, ["registration_number", "brd"], 1, 1)
    used = sorted({c for spellings in codes.values() for c in spellings})
    wide = pivot_wider(rows, ["registration_number"], "brd", {"pct": "__"}, used, F.max)
    shares = wide.select("registration_number", *[merge_breeds([f"__{c}" for c in cs]).alias(k) for k, cs in codes.items()])
    for missing in [s for s in SHARES if s not in codes]:
        shares = shares.withColumn(missing, F.lit(0.0))
    shares = shares.withColumn("ar", red_angus_share("ar", "an", [s for s in SHARES if s not in ("ar", "an")]))
    labelled = shares.withColumn("cross", pure_label({"AR": "ar", "SIM": "sim", "AN": "an"}))
    ids = row_ids(labelled, ["registration_number"], "__row")
    return ids.withColumn("brd_source", F.concat(F.lit(source), "__row")).drop("__row")


def best_shares(tables: list[DataFrame]) -> DataFrame:
    """One row per registration over several tables of one registry, pure labels in alphabetical order first."""
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return keep_first(out.distinct(), ["registration_number"], [F.asc_nulls_last("cross"), F.asc("brd_source")])


def breed_key(
    animals: DataFrame, ped: DataFrame, registries: dict[str, DataFrame], herd_pure: dict[str, str] | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Shares and label of every recorded animal.

    ``animals``: farm_id, temp_id, animal_id, registration_number, breed_code. ``ped``: farm_id, temp_id, full_reg,
    source. ``registries``: id prefix -> table from ``registry_shares``. ``known``: shares given by herds.
    Shares are looked up by prefixed id for every registry first, then by the bare number.
    """
    base = animals.select("farm_id", "temp_id", "animal_id", "registration_number", "breed_code").distinct()
    if known is not None:
        base = coalesce_join(base, known, ["farm_id", "animal_id"], "left")
    for share in SHARES:
        if share not in base.columns:
            base = base.withColumn(share, F.lit(None).cast("double"))
    for text in ("cross", "brd_source"):
        if text not in base.columns:
            base = base.withColumn(text, F.lit(None).cast("string"))
    linked = base.join(ped.select("farm_id", "temp_id", "full_reg", "source").distinct(), ["farm_id", "temp_id"], "left")
    full = full_registration("full_reg", "breed_code", "registration_number", "farm_id", "animal_id", "temp_id")
    linked = linked.withColumns({"full_reg": full, "breed_code": recode("breed_code", REGISTRY_KEEP)})
    pure = herd_pure or {}
    for share in ("hfd", "an", "ar"):
        herds = [h for h, s in pure.items() if s == share]
        if herds:
            linked = linked.withColumn(share, F.when(F.col("farm_id").isin(*herds), F.lit(1.0)).otherwise(F.col(share)))
    is_pure = F.coalesce((F.col("hfd") == 1) | (F.col("an") == 1) | (F.col("ar") == 1), F.lit(False))
    linked = linked.withColumn("brd_source", F.coalesce("brd_source", F.when(is_pure, F.col("farm_id"))))
    steps = []
    for prefix, table in registries.items():
        steps.append(("full_reg", table.withColumn("__id", F.concat(F.lit(prefix), "registration_number")), "__id"))
    for table in registries.values():
        steps.append(("registration_number", table, "registration_number"))
    matched = id_cascade(linked, steps, "brd_source")
    for table in registries.values():
        matched = coalesce_join(matched, table.drop("registration_number"), ["brd_source"], "left")
    label = F.coalesce(
        F.col("cross"),
        F.when(F.col("full_reg").rlike("AAA|BIR") | F.col("registration_number").startswith("6"), "AN"),
        F.when(F.col("an") == 1, "AN"), F.when(F.col("hfd") == 1, "HFD"), F.when(F.col("ar") == 1, "RAN"),
    )
    label = F.coalesce(recode(label, LABELS), F.lit("CROS"))
    return matched.withColumns({"cross": label, **{s: F.coalesce(s, F.lit(0.0)) for s in SHARES}})


def label_scores(scores: DataFrame, shares: DataFrame, rules: list[tuple[str, Column]], other: str = "Crossbred or other") -> DataFrame:
    """Principal-component scores with the breed label of each animal."""
    return scores.join(shares, "full_reg", "left").withColumn("breed", breed_label(rules, other))
