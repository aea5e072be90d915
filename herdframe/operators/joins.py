"""Joins with shared columns, identity search, cascades, and lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.functions.base import all_of, text_key
from herdframe.operators.keys import attach, left_join_known, null_safe_join, spread_left_join


def natural_join(left: DataFrame, right: DataFrame, how: str = "left", null_safe: bool = True) -> DataFrame:
    """Join on all shared column names; by default null matches null."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no shared columns")
    return null_safe_join(left, right, shared, how) if null_safe else left.join(right, shared, how)


def coalesce_join(left: DataFrame, right: DataFrame, by: list[str], how: str = "full") -> DataFrame:
    """Join, then take each shared non-key column from the left side first. Left column order is kept."""
    shared = [c for c in left.columns if c in right.columns and c not in by]
    order = left.columns + [c for c in right.columns if c not in left.columns]
    renamed = right.withColumnsRenamed({c: f"__y_{c}" for c in shared})
    joined = null_safe_join(left, renamed, by, how)
    merged = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"__y_{c}")) for c in shared})
    return merged.select(*order)


def reduce_join(dfs: list[DataFrame], by: list[str], how: str = "full", coalesce: bool = True) -> DataFrame:
    step = (lambda a, b: coalesce_join(a, b, by, how)) if coalesce else (lambda a, b: null_safe_join(a, b, by, how))
    return reduce(step, dfs)


def reduce_pieces(df: DataFrame, by: list[str], piece: str, cols: list[str]) -> DataFrame:
    """The coalescing full join of all pieces of one table, such as its years, in the order of ``piece``: each column has its first known value.

    One aggregation, however many pieces there are; of several rows of a key in a piece the smallest value counts.
    """
    first = [F.min(F.when(F.col(c).isNotNull(), F.struct(piece, c)))[c].alias(c) for c in cols]
    return df.filter(F.col(piece).isNotNull()).groupBy(*by).agg(*first)


def id_search(
    source: DataFrame, source_col: str, search: DataFrame, search_col: str, key: str, match_source: str | None = None
) -> DataFrame:
    """Fill ``key`` on rows that lack it by matching one column pair; several matches give several rows.

    Rows that already have a key, or have nothing to match with, never meet the lookup.
    """
    kind = dict(search.dtypes)[key]
    if key not in source.columns:
        source = source.withColumn(key, F.lit(None).cast(kind))
    if source_col not in source.columns:
        source = source.withColumn(source_col, F.lit(None).cast("string"))
    choices = search.select(F.col(search_col).alias("__right"), F.col(key).alias("__found"))
    choices = choices.filter(F.col("__right").isNotNull())
    open_row = F.col(key).isNull() & F.col(source_col).isNotNull()
    joined = spread_left_join(source, choices, F.col(source_col), "__right", open_row)
    out = joined.withColumn(key, F.coalesce(F.col(key), F.col("__found")))
    if match_source is not None:
        label = F.when(F.col("__found").isNotNull(), F.lit(f"{source_col}-{search_col}"))
        earlier = F.col(match_source) if match_source in source.columns else F.lit(None).cast("string")
        out = out.withColumn(match_source, F.coalesce(earlier, label))
    return out.drop("__found")


def id_cascade(
    source: DataFrame, steps: list[tuple[str, DataFrame, str]], key: str, match_source: str | None = None
) -> DataFrame:
    """Ordered id searches in one pass: the first step with a match wins, all its matches are kept.

    Each distinct combination of ids is turned into (step, value) candidates, joined once with the stacked lookup
    columns, and the lowest step per combination is kept; the result is joined back by the combination. The
    number of shuffles does not grow with the number of steps.
    """
    cols = list(dict.fromkeys(c for c, _, _ in steps))
    kind = dict(steps[0][1].dtypes)[key]
    if key not in source.columns:
        source = source.withColumn(key, F.lit(None).cast(kind))
    ids = source.filter(F.col(key).isNull()).select(*cols).distinct()
    cells = [
        F.struct(F.lit(i).alias("__step"), F.col(c).cast("string").alias("__value")) for i, (c, _, _) in enumerate(steps)
    ]
    wanted = ids.select(*cols, F.inline(F.array(*cells))).filter(F.col("__value").isNotNull())
    # one scan per lookup frame: its searched columns are stacked together
    frames: dict[int, tuple[DataFrame, list]] = {}
    for i, (_, search, column) in enumerate(steps):
        frames.setdefault(id(search), (search, []))[1].append((i, column))
    stacked = None
    for search, pairs in frames.values():
        rows = F.array(*[F.struct(F.lit(i).alias("__step"), F.col(c).cast("string").alias("__value")) for i, c in pairs])
        part = search.select(F.inline(rows), F.col(key).alias("__found")).filter(F.col("__value").isNotNull())
        stacked = part if stacked is None else stacked.unionByName(part)
    found = wanted.join(stacked, ["__step", "__value"])
    found = found.filter(F.col("__found").isNotNull())
    best = found.groupBy(*cols).agg(F.min("__step").alias("__step"))
    matches = null_safe_join(found, best, [*cols, "__step"], "left_semi").select(*cols, "__step", "__found")
    combo = text_key(*cols, sep="\u0001", missing="\u0000")
    matches = matches.withColumn("__combo", combo).drop(*cols)
    open_row = F.col(key).isNull() & reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
    joined = spread_left_join(source, matches, combo, "__combo", open_row)
    out = joined.withColumn(key, F.coalesce(F.col(key), F.col("__found")))
    if match_source is not None:
        labels = F.array(*[F.lit(f"{c}-{s}") for c, _, s in steps])
        out = out.withColumn(match_source, F.try_element_at(labels, (F.col("__step") + 1).cast("int")))
    return out.drop("__found", "__step")


def match_counts(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """New matches and rows still without a key."""
    had = before.agg(F.count(key).alias("had")) if key in before.columns else before.agg(F.lit(0).alias("had"))
    now = after.agg(F.count(key).alias("now"), F.count_if(F.col(key).isNull()).alias("missing"))
    return now.select((F.col("now") - had.scalar()).alias("found"), "missing")


def resolve_multi_match(df: DataFrame, by: list[str], key: str, bulk: str) -> DataFrame:
    """Several keys for one animal: rows from bulk sources go, then the largest key stays; rows without a key stay.

    A null key counts as one of several keys, as in a distinct count that includes missing values. A group with a
    missing key left keeps only its rows without a key.
    """
    kinds = df.groupBy(*by).agg(
        ((F.min(key) != F.max(key)) | (F.bool_or(F.col(key).isNull()) & F.min(key).isNotNull())).alias("__many")
    )
    marked = attach(df, kinds, by)
    kept = marked.filter(~F.coalesce(F.col("__many") & F.col(bulk), F.lit(False))).drop("__many")
    tops = kept.groupBy(*by).agg(F.max(key).alias("__top"), F.bool_or(F.col(key).isNull()).alias("__open"))
    out = attach(kept, tops, by)
    largest = ~F.col("__open") & (F.col(key) == F.col("__top"))
    return out.filter(largest | F.col(key).isNull()).drop("__top", "__open")


def lookup_with_default(df: DataFrame, lookup: DataFrame, on: list[str], value: str, default) -> DataFrame:
    joined = null_safe_join(df, lookup.select(*on, value), on)
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def year_grid(df: DataFrame, year: str) -> DataFrame:
    """All ordered pairs of different years with their distance, from the set of years.

    The set of years is folded into one row by an aggregate, then unfolded twice; no join is made. For calendar years, of which there are a few hundred at
    most; more than 10,000 different values are an error.
    """
    years = df.agg(F.array_sort(F.collect_set(F.col(year))).alias("ys"))
    years = years.select(F.when(F.size("ys") <= 10_000, F.col("ys")).otherwise(F.raise_error(F.lit("not a column of years"))).alias("ys"))
    first = years.select("ys", F.explode("ys").alias("year1"))
    pairs = first.select("year1", F.explode("ys").alias("year2"))
    return pairs.filter("year1 <> year2").withColumn("dist", F.col("year1") - F.col("year2"))


def overlap(df: DataFrame, keys: list[str], dataset: str) -> DataFrame:
    """Rows whose key occurs in more than one dataset."""
    n = df.groupBy(*keys).agg(F.min(dataset).alias("__a"), F.max(dataset).alias("__b"), F.count(F.lit(1)).alias("n"))
    shared = n.filter("__a < __b").select(*keys, "n")
    return null_safe_join(df, shared, keys, "inner")


def passing_and_new(hits: DataFrame, reference: DataFrame, keys: list[str], passing) -> DataFrame:
    """Hits that also pass in the reference results, and hits that are new."""
    marked = hits.join(reference.filter(passing).select(*keys).distinct().withColumn("__p", F.lit(1)), keys, "left")
    return marked.agg(F.count("__p").alias("n_passing"), F.count_if(F.col("__p").isNull()).alias("n_new"))


def choose_sample_id(
    ped: DataFrame, register: DataFrame, samples: DataFrame, key: str = "lab_id", min_rate: float = 0.89
) -> DataFrame:
    """Sample id to use: the duplicate when only it was assayed, or when it has a dense assay with a good call rate.

    ``register``: key, duplicate. ``samples``: lab_id, assay, call_rate.
    """
    with_dup = left_join_known(ped, register.select(key, "duplicate"), key)
    own = samples.select(F.col("lab_id").alias(key), F.col("assay").alias("assay_orig"), F.col("call_rate").alias("rate_orig"))
    dup = samples.select(
        F.col("lab_id").alias("duplicate"), F.col("assay").alias("assay_dup"), F.col("call_rate").alias("rate_dup")
    )
    both = left_join_known(left_join_known(with_dup, own, key), dup, "duplicate")
    dense = F.col("assay_dup").rlike("F250|HD") & (F.col("rate_dup") > min_rate)
    use_dup = (F.col("assay_orig").isNull() & F.col("assay_dup").isNotNull()) | F.coalesce(dense, F.lit(False))
    return both.withColumn("final_id", F.when(use_dup, F.col("duplicate")).otherwise(F.col(key)))


def anti(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return null_safe_join(left, right.select(*on).distinct(), on, "left_anti")


def semi(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return null_safe_join(left, right.select(*on).distinct(), on, "left_semi")
