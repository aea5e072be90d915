"""Fills, first-per-key, top days, sampling and age imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdframe.functions.base import all_of
from herdframe.operators.keys import attach, null_safe_join
from herdframe.operators.ordered import position_bins, row_ids, running
from herdframe.session import cut_lineage


def fill_downup(df: DataFrame, keys: list[str], order: list[str], cols: list[str], store: bool = False) -> DataFrame:
    """Fill nulls with the last known value before the row, else the first known value after it, inside ``keys``.

    Rows follow each other by all ``order`` columns, nulls of the first (usually a day) last, of the others first. Rows that
    are equal in all of them share what is known among them (the largest value before, the smallest after). Days are bins of a key:
    what earlier and later days know is carried over the table of days, and each day is scanned on its own, so the rows of a
    hot key are spread over tasks. With ``store``, for results that are read several times, the rows that have a null are filled once and stored;
    of the others only what they know is moved, and only the days of rows with a null are scanned.
    """
    moment, ties = order[0], order[1:]
    first = F.struct(F.col(moment).isNull().alias("late"), F.col(moment).alias("at"))
    rows = df.withColumns({"__by": F.struct(*keys), "__bin": first, "__row": F.struct(*[F.col(t) for t in ties]) if ties else F.lit(0)})
    marks = {c: F.when(F.col(c).isNotNull(), F.struct("__bin", "__row", F.col(c).alias("v"))) for c in cols}
    full_row = all_of([F.col(c).isNotNull() for c in cols])
    ends = [x for c in cols for x in (F.max(marks[c]).alias(f"__max_{c}"), F.min(marks[c]).alias(f"__min_{c}"))]
    days = rows.groupBy("__by", "__bin").agg(*ends, F.bool_and(full_row).alias("__full"))
    w = Window.partitionBy("__by").orderBy("__bin")
    past, future = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    carried = days.select(
        "__by", "__bin", "__full", *[x for c in cols for x in (F.max(f"__max_{c}").over(past).alias(f"__past_{c}"), F.min(f"__min_{c}").over(future).alias(f"__next_{c}"))]
    )
    day = Window.partitionBy("__by", "__bin").orderBy("__row")
    back = day.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = day.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    if store:
        others = [c for c in df.columns if c not in cols]
        known = rows.select("__by", "__bin", "__row", *cols, F.when(~full_row, F.struct(*others)).alias("__rest"))
        joined = known.join(carried.filter("not __full"), ["__by", "__bin"])
    else:
        joined = rows.join(carried, ["__by", "__bin"], "left")
    filled = {
        c: F.coalesce(
            F.col(c), F.coalesce(F.max(marks[c]).over(back), F.col(f"__past_{c}"))["v"], F.coalesce(F.min(marks[c]).over(ahead), F.col(f"__next_{c}"))["v"]
        )
        for c in cols
    }
    if not store:
        return joined.select(*[filled[c].alias(c) if c in cols else F.col(c) for c in df.columns])
    made = joined.select("__rest", *[filled[c].alias(c) for c in cols]).filter("__rest is not null")
    made = cut_lineage(made.select(*[F.col(c) if c in cols else F.col("__rest")[c].alias(c) for c in df.columns]))
    return df.filter(full_row).unionAll(made)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key by priority; give a full tie-break. Spark prunes to one row per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def nearest_in_time(df: DataFrame, keys: list[str], day: str, target: Column, ties: list[Column]) -> DataFrame:
    """The row closest to a target date per key."""
    gap = F.abs(F.date_diff(F.col(day), target))
    return keep_first(df, keys, [F.asc_nulls_last(gap), *ties])


def top_with_ties(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """Rows whose rank by ``value`` (largest first) is at most n, ties kept.

    Ranks come from counts per distinct value; at most n distinct values per key are ever looked at.
    """
    return null_safe_join(df, _top_values(df, keys, value, n), [*keys, value], "left_semi")


def _top_values(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys).orderBy(F.desc(value))
    near = counts.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    ahead = F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return near.withColumn("__ahead", ahead).filter(F.col("__ahead") < n).drop("__ahead", "__rn", "__n")


def trailing_mean(df: DataFrame, keys: list[str], day: str, n: int, means: dict[str, Column | str]) -> DataFrame:
    """Mean of each measure over the latest n days (ties kept) per key, from sums per day."""
    sums = []
    for out, c in means.items():
        c = F.col(c) if isinstance(c, str) else c
        sums += [F.sum(c).alias(f"__s_{out}"), F.count(c).alias(f"__c_{out}")]
    days = df.filter(F.col(day).isNotNull()).groupBy(*keys, day).agg(F.count(F.lit(1)).alias("__n"), *sums)
    w = Window.partitionBy(*keys).orderBy(F.desc(day))
    near = days.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    ahead = F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = near.withColumn("__ahead", ahead).filter(F.col("__ahead") < n)
    return kept.groupBy(*keys).agg(
        *[F.try_divide(F.sum(f"__s_{out}"), F.sum(f"__c_{out}")).alias(out) for out in means]
    )


def trailing_lookup(
    dates: DataFrame, series: DataFrame, keys: list[str], date: str, day: str, n: int, means: dict[str, Column | str], within: int | None = None
) -> DataFrame:
    """(keys, date, means): for each distinct date of a key, the mean of each measure over the latest ``n`` rows of the key's series up to the date.

    All rows of the earliest day that counts are kept. With ``within`` only days less than so many days before the date count; null without any.
    Sums run along the days of a key; a date looks up the last day up to it and, for the bound, the last day before the window. Work is dates and days: no row is
    made for the days of a window. Sums are decimals, so the difference of two is exact.
    """
    sums, totals = [], []
    for out, c in means.items():
        c = F.col(c) if isinstance(c, str) else c
        sums += [F.sum(c.cast("decimal(38,18)")).alias(f"__s_{out}"), F.count(c).alias(f"__c_{out}")]
        totals += [f"__s_{out}", f"__c_{out}"]
    known = lambda df, c: df.filter(" and ".join(f"`{x}` is not null" for x in [*keys, c]))
    days = known(series, day).groupBy(*keys, day).agg(F.count(F.lit(1)).alias("__n"), *sums)
    place = Window.partitionBy(*keys)
    along = place.orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = days.select(*keys, F.col(day).alias("__t"), *[F.coalesce(F.sum(c).over(along), F.lit(0)).alias(c) for c in ("__n", *totals)])
    # sums up to the last day that has n or more rows after it
    low = F.max(F.struct("__n", *totals)).over(place.orderBy("__n").rangeBetween(Window.unboundedPreceding, -n))
    run = run.withColumn("__p", F.struct("__n", *totals, low.alias("low"))).select(*keys, "__t", F.lit(0).alias("__kind"), "__p")
    wanted = known(dates.select(*keys, F.col(date).cast("date").alias(date)), date).distinct()
    looks = [F.struct(F.col(date).alias("__t"), F.lit(1).alias("__kind"))]
    if within is not None:
        looks.append(F.struct(F.date_sub(date, within).alias("__t"), F.lit(2).alias("__kind")))
    marks = wanted.select(*keys, date, F.inline(F.array(*looks)))
    both = run.unionByName(marks, allowMissingColumns=True)
    last = F.last("__p", ignorenulls=True).over(place.orderBy("__t", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = both.withColumn("__p", last).filter("__kind > 0").groupBy(*keys, date)
    found = seen.agg(F.max(F.when(F.col("__kind") == 1, F.col("__p"))).alias("__p"), F.max(F.when(F.col("__kind") == 2, F.col("__p"))).alias("__q"))
    before = F.struct(*[F.col(f"__q.{c}").alias(c) for c in ("__n", *totals)])
    found = found.withColumn("__b", F.greatest(F.col("__p.low"), F.when(F.col("__q").isNotNull(), before)))
    part = lambda c: F.col(f"__p.{c}") - F.coalesce(F.col(f"__b.{c}"), F.lit(0))
    return found.select(*keys, date, *[F.try_divide(part(f"__s_{o}").cast("double"), part(f"__c_{o}")).alias(o) for o in means])


def date_window(df: DataFrame, day: str, days: int = 60, out: str = "value") -> DataFrame:
    """One row per day of the window that ends at ``day``."""
    span = F.sequence(F.date_sub(F.col(day), days - 1), F.col(day))
    return df.filter(F.col(day).isNotNull()).withColumn(out, F.explode(span))


def previous_position(
    df: DataFrame, by: list[str], pos: str, ties: list[str], out: str = "lag", bin_width: int = 100_000
) -> DataFrame:
    """Position of the previous row along ``pos`` (ties in ``ties`` order), null for the first row of a group."""
    spots = df.groupBy(*by, pos).agg(F.min(F.struct(*ties)).alias("__first"))
    spots = running(spots, by, position_bins(pos, bin_width), [pos], {"__prev": ("max", pos)}, current=False)
    joined = null_safe_join(df, spots, [*by, pos])
    first = F.struct(*ties) == F.col("__first")
    return joined.withColumn(out, F.when(first, F.col("__prev")).otherwise(F.col(pos))).drop("__first", "__prev")


def runs(
    df: DataFrame, by: list[str], pos: str, gap: int, keep_last: bool = True, bin_width: int = 100_000
) -> DataFrame:
    """Segments of positions whose neighbours are at most ``gap`` apart: start, end and number of positions.

    ``keep_last=False`` leaves out the last segment of each group (the habit of the original analysis).
    """
    spots = df.select(*by, pos).distinct()
    lagged = running(spots, by, position_bins(pos, bin_width), [pos], {"__prev": ("max", pos)}, current=False)
    fresh = F.when(F.col("__prev").isNull() | (F.col(pos) - F.col("__prev") > gap), 1).otherwise(0)
    marked = lagged.withColumn("__new", fresh)
    numbered = running(marked, by, position_bins(pos, bin_width), [pos], {"run": ("sum", "__new")})
    out = numbered.groupBy(*by, "run").agg(
        F.min(pos).alias("start_pos"), F.max(pos).alias("end_pos"), F.count(F.lit(1)).alias("n_pos")
    )
    if keep_last:
        return out
    last = out.groupBy(*by).agg(F.max("run").alias("__last"))
    return attach(out, last, by).filter(F.col("run") < F.col("__last")).drop("__last")


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: str) -> DataFrame:
    """Distinct keys of a repeatable random sample of exactly round(fraction * keys)."""
    keys = row_ids(df.select(key).distinct(), [key], "__rank", seed)
    size = df.select(F.round(F.count_distinct(key) * F.lit(fraction)).cast("bigint"))
    return keys.filter(F.col("__rank") <= size.scalar()).select(key)


def random_one(df: DataFrame, keys: list[str], total_order: list[str], seed: str) -> DataFrame:
    """One repeatable random row per key."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in total_order], F.lit(seed))
    return keep_first(df, keys, [F.md5(text), *[F.asc_nulls_last(c) for c in total_order]])


def impute_age(df: DataFrame, keys: list[str], year: str = "year", age: str = "age") -> DataFrame:
    """Fill a missing age from the same year, else from the earliest year with a known age plus the gap.

    Years in which an animal has two different ages are ignored as a source; only ages above zero are filled in.
    """
    known = (
        df.filter(F.col(age).isNotNull())
        .groupBy(*keys, year)
        .agg(F.min(age).alias("__low"), F.max(age).alias("__high"))
        .filter(F.col("__low") == F.col("__high"))
        .select(*keys, year, F.col("__low").alias("__same"))
    )
    birth = known.groupBy(*keys).agg(F.min_by(F.col(year) - F.col("__same"), F.col(year)).alias("__birth"))
    joined = null_safe_join(null_safe_join(df, known, [*keys, year]), birth, keys)
    guess = F.coalesce(F.col("__same"), F.col(year) - F.col("__birth"))
    filled = F.coalesce(F.col(age), F.when(guess > 0, guess))
    return joined.withColumn(age, filled).drop("__same", "__birth")
