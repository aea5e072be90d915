"""Run-time checks: stop when rows break a rule or a join added rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdframe.functions.base import is_known_true


class CheckFailed(ValueError):
    """A row check did not hold."""


def verify(df: DataFrame, cond: Column, label: str = "condition", mode: str = "inline") -> DataFrame:
    """Every row must satisfy the condition; an unknown result counts as a violation.

    ``inline`` keeps the frame lazy and raises when it is computed; ``action`` counts violations now.
    """
    bad = ~is_known_true(cond)
    if mode == "action":
        n = df.filter(bad).count()
        if n:
            raise CheckFailed(f"{n} rows violate: {label}")
        return df
    return df.filter(F.when(bad, F.raise_error(F.lit(f"row violates: {label}")).cast("boolean")).otherwise(F.lit(True)))


def violations(df: DataFrame, conds: dict[str, Column]) -> DataFrame:
    """Number of violating rows per rule, one pass."""
    counts = df.agg(*[F.count_if(~is_known_true(c)).alias(name) for name, c in conds.items()])
    return counts.unpivot([], list(conds), "rule", "n_violations")


def verify_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """A lookup side must have unique keys, else a join with it would add rows."""
    if df.groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise CheckFailed(f"keys {keys} repeat")
    return df


def fanout(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before and after a left join, from key counts alone."""
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__a"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__b"))
    joined = a.join(b, keys, "left")
    return joined.agg(
        F.sum("__a").alias("n_before"), F.sum(F.col("__a") * F.coalesce(F.col("__b"), F.lit(1))).alias("n_after")
    )
