"""Join helpers that keep null keys and hot keys under control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdframe.functions.base import all_of


def shuffled(side: DataFrame) -> DataFrame:
    """A join side that grows with the data: both sides are sorted in the executors. Without the hint the size of compressed files, a small
    part of the rows' size, may have the side gathered in the driver for a broadcast."""
    return side.hint("merge")


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi join on equal column names where null matches null; one copy of the key columns is kept."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = all_of([left[c].eqNullSafe(renamed[f"__r_{c}"]) for c in on])
    out = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti"):
        return out
    if how in ("right", "full", "outer", "right_outer", "full_outer"):
        out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__r_{c}")) for c in on})
    return out.drop(*[f"__r_{c}" for c in on])


def spread_left_join(left: DataFrame, right: DataFrame, left_key: Column, right_key: str, can_match: Column) -> DataFrame:
    """Left join in which rows that cannot match are spread over all partitions.

    A null key would send every unmatched row to one task; here such rows carry a hash of the row as a second key the right
    side never has, so they fall apart, stay unmatched and are all kept. The right side's second key is 0 as well, but made from its rows: a
    constant would be folded into the condition and the rows be dealt by the first key alone, all nulls to one task.
    """
    salt = F.when(can_match, F.lit(0)).otherwise(F.xxhash64(*[F.col(c) for c in left.columns], F.lit("apart")))
    probe = left.withColumns({"__k": F.when(can_match, left_key), "__salt": salt.cast("bigint")})
    build = right.withColumnRenamed(right_key, "__rk").withColumn("__rsalt", F.pmod(F.xxhash64("__rk"), F.lit(1).cast("bigint")))
    cond = (F.col("__salt") == F.col("__rsalt")) & (F.col("__k") == F.col("__rk"))
    return probe.join(build, cond, "left").drop("__k", "__salt", "__rk", "__rsalt")


def left_join_known(left: DataFrame, right: DataFrame, key: str, unknown: tuple = ()) -> DataFrame:
    """Left join on one key column in which null and the ``unknown`` marks match nothing and make no large group."""
    known = F.col(key).isNotNull()
    for mark in unknown:
        known = known & (F.col(key).cast("string") != F.lit(str(mark)))
    return spread_left_join(left, right, F.col(key), key, known)


def attach(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Put per-group values back on the rows: a join instead of a whole-group window, so a group that holds
    a large part of all rows never has to fit into one task."""
    return null_safe_join(df, stats, keys, "left")
