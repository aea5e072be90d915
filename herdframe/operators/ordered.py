"""Running values over very long ordered groups without collecting a group in one task.

A group (a chromosome, a whole table of p-values) is cut into bins that follow the order. Bin totals are carried
forward over the small table of bins, then each bin is scanned on its own. Every window below sees one bin or
one row per bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdframe.operators.keys import null_safe_join

_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


def _merge(kind: str, a: Column, b: Column) -> Column:
    if kind == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    return F.least(a, b) if kind == "min" else F.greatest(a, b)


def _window(keys: list[str], order: list[str], reverse: bool, current: bool):
    cols = [F.desc(c) if reverse else F.asc(c) for c in order]
    last = Window.currentRow if current else -1
    return Window.partitionBy(*keys).orderBy(*cols).rowsBetween(Window.unboundedPreceding, last)


def _group_key(by: list[str]) -> dict[str, Column]:
    """The group columns as one struct: never null itself, and structs with null fields compare equal, so plain
    equality joins and windows can share one partitioning."""
    return {"__by": F.struct(*by)} if by else {}


def _carry(bins: DataFrame, outer: list[str], levels: list[str], kinds: dict[str, str], reverse: bool) -> DataFrame:
    """Value of all earlier bins for each bin, level by level."""
    keys = outer + levels[:-1]
    w = _window(keys, levels[-1:], reverse, current=False)
    local = bins.select(*keys, levels[-1], *[_AGG[k](F.col(o)).over(w).alias(o) for o, k in kinds.items()])
    if len(levels) == 1:
        return local
    upper = bins.groupBy(*keys).agg(*[_AGG[k](F.col(o)).alias(o) for o, k in kinds.items()])
    above = _carry(upper, outer, levels[:-1], kinds, reverse)
    above = above.select(*keys, *[F.col(o).alias(f"__up_{o}") for o in kinds])
    return local.join(above, keys, "left").select(
        *keys, levels[-1], *[_merge(k, F.col(f"__up_{o}"), F.col(o)).alias(o) for o, k in kinds.items()]
    )


def running(
    df: DataFrame,
    by: list[str],
    levels: dict[str, Column],
    order: list[str],
    values: dict[str, tuple[str, Column | str]],
    reverse: bool = False,
    current: bool = True,
) -> DataFrame:
    """Add running sums, minima or maxima along ``order`` inside ``by``.

    ``levels`` names bins from coarse to fine; each must be known and non-decreasing along ``order``.
    ``values`` maps an output column to (``sum|min|max``, input). ``current=False`` leaves the row itself out.
    """
    group = _group_key(by)
    outer, names = list(group), list(levels)
    kinds = {out: kind for out, (kind, _) in values.items()}
    inputs = {f"__in_{out}": (F.col(src) if isinstance(src, str) else src) for out, (_, src) in values.items()}
    rows = df.withColumns({**group, **levels, **inputs})
    bins = rows.groupBy(*outer, *names).agg(*[_AGG[k](F.col(f"__in_{o}")).alias(o) for o, k in kinds.items()])
    carried = _carry(bins, outer, names, kinds, reverse)
    carried = carried.select(*outer, *names, *[F.col(o).alias(f"__up_{o}") for o in kinds])
    joined = rows.join(carried, outer + names, "left")
    w = _window(outer + names, order, reverse, current)
    done = joined.withColumns(
        {o: _merge(k, F.col(f"__up_{o}"), _AGG[k](F.col(f"__in_{o}")).over(w)) for o, k in kinds.items()}
    )
    return done.drop(*outer, *names, *[f"__up_{o}" for o in kinds], *[f"__in_{o}" for o in kinds])


def position_bins(pos: str, width: int = 100_000) -> dict[str, Column]:
    """Bins of a base-pair coordinate: at most a few thousand per chromosome."""
    return {"__bin": F.floor(F.col(pos) / width)}


def hash_bins(digest: str) -> dict[str, Column]:
    """Two levels of bins of a hexadecimal digest: evenly filled whatever the data."""
    return {"__coarse": F.substring(F.col(digest), 1, 3), "__fine": F.substring(F.col(digest), 1, 5)}


def row_ids(df: DataFrame, keys: list[str], out: str = "row_id", seed: str = "") -> DataFrame:
    """Ids 1..n over rows with unique ``keys``, in the order of a digest of the keys.

    The order is total and repeatable, and its bins are even, so no task sees more than its share.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(seed))
    rows = df.withColumn("__digest", F.md5(text))
    ids = running(rows, [], hash_bins("__digest"), ["__digest", *keys], {out: ("sum", F.lit(1))})
    return ids.withColumn(out, F.col(out).cast("bigint")).drop("__digest")


def dense_code(df: DataFrame, value: str, by: list[str] | None = None, out: str = "code") -> DataFrame:
    """Codes 1..k of the distinct values, over the table or inside ``by``. Null stays null.

    Inside groups the bins are the 4,096 of three digits: with the fine ones of ``hash_bins`` in each group there would be about as many bins as values.
    """
    by = by or []
    return null_safe_join(df, dense_codes(df, value, by, out), by + [value])


def dense_codes(df: DataFrame, value: str, by: list[str], out: str = "code") -> DataFrame:
    """The codes of ``dense_code``, one row per distinct value."""
    levels = df.filter(F.col(value).isNotNull()).select(*by, value).distinct()
    levels = levels.withColumn("__digest", F.md5(F.col(value).cast("string")))
    bins = {"__coarse": F.substring("__digest", 1, 3)} if by else hash_bins("__digest")
    codes = running(levels, by, bins, ["__digest", value], {out: ("sum", F.lit(1))})
    return codes.select(*by, value, F.col(out).cast("bigint").alias(out))
