"""Group filters, consistency rules, tallies and summaries. Groups are reduced by partial aggregation and joined
back; no whole-group window is used, so a group may be arbitrarily large."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.functions.base import ColumnLike, all_of, col, n_distinct
from herdframe.functions.stats import corr_or_null
from herdframe.operators.keys import attach, null_safe_join
from herdframe.operators.ranks import median as exact_median
from herdframe.operators.ranks import numbered


def tally(df: DataFrame, by: list[str], out: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(out))


def add_count(df: DataFrame, by: list[str], out: str = "n") -> DataFrame:
    return attach(df, tally(df, by, out), by)


def summarise(df: DataFrame, by: list[str], value: str, median: bool = True) -> DataFrame:
    """n, min, mean, median, max and sample standard deviation; nulls are left out."""
    basic = df.groupBy(*by).agg(
        F.count(value).alias("n"), F.min(value).alias("min"), F.avg(value).alias("mean"),
        F.max(value).alias("max"), F.stddev_samp(value).alias("sd"),
    )
    if not median:
        return basic
    middle = exact_median(df, by, value)
    if not by:
        return basic.withColumn("median", middle.scalar())
    return null_safe_join(basic, middle, by)


def keep_group_size(df: DataFrame, by: list[str], low: int = 1, high: int | None = None) -> DataFrame:
    """Rows of groups with at least ``low`` (and at most ``high``) rows."""
    size = tally(df, by, "__n")
    cond = F.col("__n") >= low if high is None else F.col("__n").between(low, high)
    return null_safe_join(df, size.filter(cond).drop("__n"), by, "left_semi")


def keep_varying(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Rows of groups whose values differ; single-row groups go, as their variance is unknown."""
    spread = df.groupBy(*by).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    return null_safe_join(df, spread.filter("__low < __high").select(*by), by, "left_semi")


def find_dup(df: DataFrame, cols: list[str], not_null: str | None = None) -> DataFrame:
    """Rows whose key occurs more than once and whose marked column is known."""
    required = not_null or cols[0]
    known = df.filter(F.col(required).isNotNull())
    repeated = tally(df, cols, "__n").filter("__n > 1").select(*cols)
    return null_safe_join(known, repeated, cols, "left_semi")


def key_report(df: DataFrame, key: str, ids: dict[str, str]) -> DataFrame:
    """Missing keys and rows with a repeated id, one line per check. ``ids``: column -> line text."""
    missing = df.agg(F.count_if(F.col(key).isNull()).alias("n")).select(F.lit(f"Missing {key}").alias("error"), "n")
    lines = missing
    for column, text in ids.items():
        sizes = df.filter(F.col(column).isNotNull()).groupBy(column).count()
        line = sizes.agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("n"))
        lines = lines.unionByName(line.select(F.lit(text).alias("error"), "n"))
    return lines


def keep_consistent(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Rows of groups with exactly one distinct value, where null counts as a value."""
    kinds = df.groupBy(*by).agg(
        F.min(value).alias("__low"), F.max(value).alias("__high"),
        F.count_if(F.col(value).isNull()).alias("__nulls"), F.count(F.lit(1)).alias("__n"),
    )
    one = (F.col("__nulls") == F.col("__n")) | ((F.col("__nulls") == 0) & (F.col("__low") == F.col("__high")))
    return null_safe_join(df, kinds.filter(one).select(*by), by, "left_semi")


def any_flag(df: DataFrame, by: list[str], flag: str) -> DataFrame:
    """A flag that is true once becomes true on all rows of its group."""
    seen = df.groupBy(*by).agg(F.bool_or(F.coalesce(F.col(flag), F.lit(False))).alias("__any"))
    return attach(df, seen, by).withColumn(flag, F.col("__any")).drop("__any")


def conflict_to(df: DataFrame, by: list[str], values: dict[str, object]) -> DataFrame:
    """Groups with more than one distinct value (null counts as one) get a constant instead."""
    kinds = df.groupBy(*by).agg(
        *[
            F.coalesce(
                (F.min(c) != F.max(c)) | (F.bool_or(F.col(c).isNull()) & F.min(c).isNotNull()), F.lit(False)
            ).alias(f"__many_{c}")
            for c in values
        ]
    )
    out = attach(df, kinds, by)
    out = out.withColumns({c: F.when(F.col(f"__many_{c}"), F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})
    return out.drop(*[f"__many_{c}" for c in values])


def share_of_total(df: DataFrame, by: list[str]) -> DataFrame:
    counts = tally(df, by)
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return counts.withColumn("share", F.col("n") / total.scalar())


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlations of all column pairs, pairwise complete, one scan, long form."""
    pairs = list(combinations(cols, 2))
    stats = df.agg(*[corr_or_null(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs]
    return stats.select(F.inline(F.array(*cells)))


def simple_regression(df: DataFrame, by: list[str], y: str, x: str) -> DataFrame:
    """Slope, intercept, standard error of the slope, R2 and n of y on x per group; null where x does not vary."""
    fit = df.groupBy(*by).agg(
        F.regr_count(y, x).alias("n"), F.regr_avgx(y, x).alias("__mx"), F.regr_avgy(y, x).alias("__my"),
        F.regr_sxx(y, x).alias("__sxx"), F.regr_syy(y, x).alias("__syy"), F.regr_sxy(y, x).alias("__sxy"),
    )
    sxx, syy, sxy = F.col("__sxx"), F.col("__syy"), F.col("__sxy")
    fit = fit.withColumn("slope", F.try_divide(sxy, sxx))
    sse = F.greatest(syy - F.col("slope") * sxy, F.lit(0.0))
    return fit.select(
        *by, "n", "slope", (F.col("__my") - F.col("slope") * F.col("__mx")).alias("intercept"),
        F.try_divide(sxy * sxy, sxx * syy).alias("r2"),
        F.when(F.col("n") > 2, F.sqrt(F.try_divide(F.try_divide(sse, F.col("n") - 2), sxx))).alias("se"),
    )


def summary_of(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Min, mean, max and sd of statistics that were computed per iteration."""
    return summarise(df, by, value, median=False).drop("n")


def joined_list(
    df: DataFrame, by: list[str], order: list[ColumnLike], text: ColumnLike, out: str = "items", sep: str = "; "
) -> DataFrame:
    """Distinct texts per group, in order, joined into one string: for final, small reports; else see ``ordered_items``."""
    cell = F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)], col(text).alias("t"))
    cells = F.array_sort(F.collect_set(cell))
    return df.groupBy(*by).agg(F.array_join(F.transform(cells, lambda s: s["t"]), sep).alias(out))


def ordered_items(df: DataFrame, by: list[str], order: list[str], item: ColumnLike, out: str = "item") -> DataFrame:
    """Distinct items per group as rows with their place (1, 2, ...) in the order of ``order`` and the item: the long form of
    ``joined_list``, for groups of any size. Rows are sorted by range, so neither a list is held nor a group numbered in one task."""
    rows = df.select(*by, *order, col(item).alias(out)).distinct()
    places = numbered(rows, by, [*order, out], "place")
    return places.select(*by, F.col("place").cast("int").alias("place"), out)


def pass_fail(df: DataFrame, by: list[str], value: str, limit: float) -> DataFrame:
    """Passes below the limit, fails at or above it, and the share of fails."""
    out = df.groupBy(*by).agg(
        F.count_if(F.col(value) < limit).alias("n_pass"), F.count_if(F.col(value) >= limit).alias("n_fail")
    )
    out = out.filter((F.col("n_pass") + F.col("n_fail")) > 0)
    return out.withColumn("share_fail", F.col("n_fail") / (F.col("n_pass") + F.col("n_fail")))


def missing_counts(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"missing_{c}"), F.count(c).alias(f"has_{c}")]
    return df.groupBy(*by).agg(*aggs)


def binned_counts(df: DataFrame, axes: dict[str, tuple[str, float, float]], by: list[str] | None = None) -> DataFrame:
    """Counts in equal bins: ``{bin column: (source, low, width)}``; one axis or two."""
    binned = df.filter(all_of([F.col(c).isNotNull() for c, _, _ in axes.values()]))
    binned = binned.withColumns({out: F.floor((F.col(c) - low) / width) for out, (c, low, width) in axes.items()})
    return tally(binned, [*(by or []), *axes])


def group_size_distribution(df: DataFrame, by: list[str]) -> DataFrame:
    """How many groups have how many rows."""
    return tally(tally(df, by, "group_size"), ["group_size"], "n_groups")


def dataset_counts(df: DataFrame, dataset: str, animal: str, genotyped: DataFrame) -> DataFrame:
    """Records, distinct animals and genotyped animals per dataset."""
    animals = df.groupBy(dataset, animal).agg(F.count(F.lit(1)).alias("__n"))
    marked = animals.join(genotyped.select(animal).distinct().withColumn("__g", F.lit(1)), animal, "left")
    return marked.groupBy(dataset).agg(
        F.sum("__n").alias("n_records"), F.count(F.lit(1)).alias("n_animals"), F.count("__g").alias("n_genotyped")
    )


def distinct_values(df: DataFrame, by: list[str], values: dict[str, ColumnLike]) -> DataFrame:
    """Distinct counts per group where null counts as a value."""
    return df.groupBy(*by).agg(*[n_distinct(c).alias(out) for out, c in values.items()])
