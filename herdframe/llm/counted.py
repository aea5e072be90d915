"""Joins with tables of counted keys, some of which may stand on a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys on more than one of so many rows are hot. By counting, there are fewer hot keys than this, however large the tables are.
HOT_PART = 10_000


def join_counted(rows: DataFrame, counted: DataFrame, on: list[str], n: str = "n", total: int | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``counted``, which has each key once and, in ``n``, on how many rows it stands (``n`` is not returned).

    Hot keys, fewer than ``HOT_PART`` short rows, are broadcast; their rows stay where they are. The others are joined by a shuffle in which
    no key has more than ``1 / HOT_PART`` of all rows. Both tables are read twice, so they should be stored ones. ``total``: sum of all counts, if known.
    """
    if total is None:
        total = int(counted.agg(F.sum(n)).first()[0] or 0)
    hot = counted.filter(F.col(n) * HOT_PART > F.lit(total)).drop(n)
    cold = counted.filter(F.col(n) * HOT_PART <= F.lit(total)).drop(n)
    apart = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(apart.join(cold, on))
