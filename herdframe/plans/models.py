"""Datasets for models: contemporary groups, environments, year files, validation splits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdframe.functions import records as R
from herdframe.functions.base import text_key
from herdframe.operators.aggregates import keep_group_size
from herdframe.operators.checks import verify
from herdframe.operators.joins import lookup_with_default, semi
from herdframe.operators.keys import null_safe_join
from herdframe.operators.ordered import dense_codes, hash_bins, running
from herdframe.operators.windows import fill_downup, keep_first, nearest_in_time, random_one, trailing_lookup

from herdframe.session import cut_lineage


@dataclass(frozen=True)
class GroupRules:
    """How contemporary groups are formed."""

    bins: str = "growing"
    min_size: int = 5
    varying: bool = True
    season_by_herd: dict[str, str] = field(default_factory=lambda: dict(R.SEASON_BY_HERD))
    fescue_herds: tuple[str, ...] = tuple(R.FESCUE_HERDS)
    parts: tuple[str, ...] = ("farm_id", "year", "season", "age_group", "score_group", "fescue")
    require: tuple[str, ...] = ()


def prepare_females(records: DataFrame, rules: GroupRules, score_groups: DataFrame | None = None) -> DataFrame:
    """Females with score group, calving season, age group and fescue filled in."""
    rows = records.filter("sex = 'F'")
    if score_groups is not None:
        rows = lookup_with_default(rows, score_groups, ["farm_id", "score_date"], "score_group", 1)
    elif "score_group" not in rows.columns:
        rows = rows.withColumn("score_group", F.lit(1))
    ties = [c for c in ("rec_a", "rec_b") if c in rows.columns]
    # stored: groups are counted or numbered on the same rows that are kept
    rows = fill_downup(rows, ["farm_id", "temp_id"], ["score_date", *ties], ["season"], store=True)
    dob = "dob" if "dob" in rows.columns else F.lit(None).cast("date")
    rows = rows.withColumn("season", R.season_default("farm_id", dob, "season", rules.season_by_herd))
    rows = rows.withColumn("age_group", R.age_group("age", rules.bins))
    if "fescue" in rows.columns and rules.fescue_herds:
        rows = rows.withColumn("fescue", R.fescue_default("farm_id", "fescue", list(rules.fescue_herds)))
    for c in rules.require:
        rows = rows.filter(F.col(c).isNotNull())
    return rows


def contemporary_groups(records: DataFrame, rules: GroupRules | None = None, score_groups: DataFrame | None = None) -> DataFrame:
    """Records in groups that are large enough and vary; ``cg`` is the key text (missing parts read ``NA``)."""
    rules = rules or GroupRules()
    rows = prepare_females(records, rules, score_groups)
    rows = rows.withColumn("cg", text_key(*[p for p in rules.parts if p in rows.columns]))
    if rules.min_size <= 1 and not rules.varying:
        return rows
    # size and spread of a group come from one aggregation
    facts = rows.groupBy("cg").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
    keep = F.col("n") >= rules.min_size
    if rules.varying:
        keep = keep & (F.col("low") < F.col("high"))
    return rows.join(facts.filter(keep).select("cg"), "cg", "left_semi")


def number_groups(df: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with the number of their group among those of ``groups``."""
    return null_safe_join(df, dense_codes(groups, "cg", [], "cg_num"), ["cg"])


# fixed values: effects of the environment models, besides season, fescue and age group
MODELS: dict[str, dict] = {
    "fixed3": {"env": ["mean_apparent_high", "mean_day_length"]},
    "fixed5": {"env": ["mean_day_length"]},
    "fixed6": {"env": ["mean_apparent_high"]},
    "fixed9": {"groups": True},
    "fixed10": {"groups": True, "env": ["lat"]},
    "fixed11": {"env": ["mean_apparent_high", "lat"]},
    "fixed12": {"env": ["mean_day_length", "lat"]},
    "fixed13": {"env": ["mean_apparent_high", "mean_day_length"], "interaction": True},
    "fixed14": {"groups": True, "genotyped": True},
    "fixed15": {"groups": True, "genotyped": True, "scores": ["PC1", "PC2"]},
}


def environment(records: DataFrame, weather: DataFrame, places: DataFrame, days: int = 30, within: int | None = 60) -> DataFrame:
    """Records with coordinates and the means of the latest ``days`` days of weather up to scoring, of the last ``within`` days.

    ``weather``: lat, long, value (day), apparent_high, day_length; days may be repeated for several dates of scoring. ``places``: farm_id, lat, long.
    """
    keys = ["score_date", "lat", "long"]
    placed = records.filter(F.col("score_date").isNotNull()).join(places.select("farm_id", "lat", "long"), "farm_id", "left")
    daily = weather.groupBy("lat", "long", "value").agg(F.avg("apparent_high").alias("apparent_high"), F.avg("day_length").alias("day_length"))
    measures = {"mean_apparent_high": "apparent_high", "mean_day_length": "day_length"}
    means = trailing_lookup(placed, daily, ["lat", "long"], "score_date", "value", days, measures, within)
    return placed.join(means, keys, "left")


def interaction(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Product of two centred covariates."""
    means = df.agg(F.avg(a).alias("a"), F.avg(b).alias("b"))
    product = (F.col(a) - means.select("a").scalar()) * (F.col(b) - means.select("b").scalar())
    return df.withColumn(out, product)


def model_dataset(
    records: DataFrame, model: str, rules: GroupRules | None = None, score_groups: DataFrame | None = None,
    genotyped: DataFrame | None = None, scores: DataFrame | None = None, min_level: int = 5,
) -> DataFrame:
    """The columns of one named model, from records that already carry environment columns and ``full_reg``."""
    spec = MODELS[model]
    rules = rules or GroupRules()
    if spec.get("groups"):
        rows = contemporary_groups(records, rules, score_groups)
        effects = ["cg"]
    else:
        needed = GroupRules(bins="twothree", season_by_herd=rules.season_by_herd, fescue_herds=rules.fescue_herds,
                            require=("season", "fescue", "age_group"))
        # stored: group sizes, means and rows are read from it
        rows = keep_group_size(cut_lineage(prepare_females(records, needed, score_groups)), ["age_group"], min_level)
        effects = ["year", "season", "fescue", "age_group"]
    env = list(spec.get("env", []))
    if spec.get("interaction"):
        rows = interaction(rows, env[0], env[1], "centred_product")
        env.append("centred_product")
    for c in env:
        rows = verify(rows, F.col(c).isNotNull(), c)
    if spec.get("genotyped"):
        rows = semi(rows, genotyped, ["full_reg"])
    if "scores" in spec:
        rows = rows.join(scores.select("full_reg", *spec["scores"]), "full_reg")
        env += spec["scores"]
    return rows.select("full_reg", *effects, *env, "score")


def breed_subset(records: DataFrame, breed_key: DataFrame, cond: Column) -> DataFrame:
    """Records of animals whose breed key row satisfies a condition."""
    key = breed_key.filter(F.coalesce(cond, F.lit(False))).select("farm_id", "temp_id").distinct()
    return semi(records, key, ["farm_id", "temp_id"])


def year_files(
    records: DataFrame, ped: DataFrame, genotyped: DataFrame, ties: list[str], year: int | None = None,
    rules: GroupRules | None = None, score_groups: DataFrame | None = None,
) -> DataFrame:
    """Phenotype and group per genotyped animal and year: the score nearest to 1 May; one row per pedigree id.

    All years come from one job; ``year`` keeps one. ``genotyped``: full_reg, iid.
    """
    loose = GroupRules(bins="growing", min_size=1, varying=False) if rules is None else rules
    rows = groups = contemporary_groups(records, loose, score_groups)
    if year is not None:
        rows = rows.filter(F.col("year") == year)
    order = [F.asc_nulls_last(c) for c in ties]
    near = nearest_in_time(rows, ["farm_id", "temp_id", "year"], "score_date", R.may_first("year"), order)
    linked = near.join(ped.select("farm_id", "temp_id", "full_reg").distinct(), ["farm_id", "temp_id"], "left")
    full = R.full_registration("full_reg", "breed_code", "registration_number", "farm_id", "animal_id", "temp_id")
    single = keep_first(linked.withColumn("full_reg", full), ["full_reg", "year"], [F.asc_nulls_last("score_date"), *order])
    # all groups are numbered, but only the rows of the files are joined with their number
    files = single.join(genotyped.select("full_reg", "iid"), "full_reg")
    return number_groups(files, groups).select("year", "full_reg", "iid", "score", "cg_num")


def adjusted_phenotype(records: DataFrame, levels: DataFrame, solutions: DataFrame, effect: int = 1) -> DataFrame:
    """Score minus the solution of its contemporary group; records without a solution go.

    ``levels``: effect, id_original, id_renamed. ``solutions``: effect, id_renamed, solution.
    """
    named = levels.filter(F.col("effect") == effect).join(solutions, ["effect", "id_renamed"])
    blue = named.select(F.col("id_original").cast("bigint").alias("cg_num"), "solution")
    joined = records.join(blue, "cg_num").filter(F.col("solution").isNotNull())
    return joined.withColumn("adj_score", F.col("score") - F.col("solution"))


def environment_tables(
    family: DataFrame, records: DataFrame, env: str, total_order: list[str], seed: str, year: int | None = None
) -> DataFrame:
    """One random record per animal in the order of the genotype file: adjusted phenotype and environment; animals
    without a record keep a row. ``family``: ord, full_reg."""
    rows = records if year is None else records.filter(F.col("year") == year)
    one = random_one(rows, ["full_reg"], total_order, seed)
    return family.join(one.select("full_reg", "adj_score", env), "full_reg", "left").orderBy("ord")


def validation_split(
    data: DataFrame, animal: str, score: str, fraction: float, iterations: int, mask: float = -999, seed: str = "split"
) -> DataFrame:
    """All iterations in one table: the score of a random fraction of the animals is masked in each.

    Animals are ranked by a digest per iteration; all iterations run in the same job.
    """
    iters = F.explode(F.sequence(F.lit(1), F.lit(iterations))).alias("iter")
    animals = data.select(animal).distinct()
    size = animals.agg(F.round(F.count(F.lit(1)) * F.lit(fraction)).cast("bigint").alias("n"))
    text = F.concat_ws("|", F.col(animal).cast("string"), F.concat(F.lit(seed), F.col("iter").cast("string")))
    drawn = animals.select(animal, iters).withColumn("__digest", F.md5(text))
    ranked = running(drawn, ["iter"], hash_bins("__digest"), ["__digest", animal], {"__rank": ("sum", F.lit(1))})
    chosen = ranked.filter(F.col("__rank") <= size.scalar()).select(animal, "iter", F.lit(True).alias("__mask"))
    copies = data.select("*", iters)
    marked = copies.join(chosen, [animal, "iter"], "left")
    return marked.withColumn(score, F.when(F.col("__mask"), F.lit(mask)).otherwise(F.col(score))).drop("__mask")
