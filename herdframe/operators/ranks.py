"""Ranks and running minima over all values of a table or of large groups, by ranges of the sorted values.

Distinct values with their counts are dealt by range, sorted once and stored as blocks: one row holds up to ``BLOCK`` values of one group. Sums and minima
of whole blocks are carried over the small table of blocks; inside a block numpy does the rest. No group meets in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdframe.session import cut_lineage

BLOCK = 1 << 16


def value_blocks(df: DataFrame, by: list[str], value: str, block: int = BLOCK) -> DataFrame:
    """(by..., block, v, n): the distinct values of each group in rising order and how often each occurs. Null values are left out. A stored table.

    Blocks of a group rise with their number.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    dealt = counts.repartitionByRange(*by, "v").sortWithinPartitions(*by, "v")
    kinds = {f.name: f.dataType.simpleString() for f in counts.schema}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            new[::block] = True
            for c in by:
                codes = pc.fill_null(batch[c].dictionary_encode().indices, -1).to_numpy()
                new[1:] |= codes[1:] != codes[:-1]
            begins = np.flatnonzero(new)
            at = pa.array(np.append(begins, batch.num_rows).astype(np.int32))
            numbers = pa.array(number + np.arange(len(begins)))
            number += len(begins)
            yield pa.RecordBatch.from_arrays(
                [*[batch[c].take(pa.array(begins)) for c in by], numbers, pa.ListArray.from_arrays(at, batch["v"]), pa.ListArray.from_arrays(at, batch["n"])], names=[*by, "block", "v", "n"]
            )

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in by], "block long", "v array<double>", "n array<long>"])
    return cut_lineage(dealt.mapInArrow(cut, schema))


def carried(blocks: DataFrame, by: list[str], value: Column, kind: Callable, out: str, reverse: bool = False) -> DataFrame:
    """(block, out): sum, minimum or maximum of ``value`` over the blocks of the group before each one, or after it."""
    order = F.desc("block") if reverse else F.asc("block")
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(*by, "block", value.alias("__v")).select("block", kind("__v").over(w).alias(out))


def placed(blocks: DataFrame, by: list[str]) -> DataFrame:
    """(by..., block, before, total): values before each block, and all of its group."""
    sizes = blocks.select(*by, "block", F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x).alias("__n"))
    rising = Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("__n").over(Window.partitionBy(*by))
    return sizes.select(*by, "block", F.coalesce(F.sum("__n").over(rising), F.lit(0).cast("long")).alias("before"), total.alias("total"))


def spread(blocks: DataFrame, by: list[str], schema: str, fn: Callable[[dict], dict[str, np.ndarray]]) -> DataFrame:
    """Rows (by..., and the columns that ``fn`` gives for each value of a block). ``fn`` sees one block: numpy arrays v and n, and the row's other columns."""
    names = [x.strip().split()[0].strip("`") for x in schema.split(",")]
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i].values.to_numpy(zero_copy_only=False) if c in ("v", "n") else batch[c][i].as_py() for c in batch.schema.names}
                made = fn(row)
                size = len(made[names[0]])
                yield pa.RecordBatch.from_arrays([*[batch[c].take(pa.array(np.full(size, i))) for c in by], *[pa.array(made[c]) for c in names]], names=[*by, *names])

    return blocks.mapInArrow(each, ", ".join([*[f"`{c}` {kinds[c]}" for c in by], schema]))


def quantile_ends(df: DataFrame, by: list[str], value: str, shares: list[float]) -> DataFrame:
    """(by..., share, low, high, part): the values at the ranks below and above (n - 1) * share, counted from 0, and how far it lies between them.

    Values are sorted once, by range; of each group only the blocks that hold a wanted rank are looked into. Groups without a known value have no row.
    """
    blocks = value_blocks(df, by, value)
    sizes = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    info = placed(blocks, by).join(blocks.select("block", sizes.alias("own")), "block")
    place = (F.col("total") - 1) * F.col("share")
    wanted = info.withColumn("share", F.explode(F.array(*[F.lit(float(q)) for q in shares])))
    wanted = wanted.select("block", "before", "own", "share", F.inline(F.array(*[F.struct(F.lit(w).alias("which"), f(place).cast("long").alias("rank")) for w, f in ((0, F.floor), (1, F.ceil))])), (place - F.floor(place)).alias("part"))
    wanted = wanted.filter("rank >= before and rank < before + own").drop("own")

    def at(row: dict) -> dict[str, np.ndarray]:
        k = int(np.searchsorted(row["before"] + np.cumsum(row["n"]), row["rank"], side="right"))
        return {"share": np.array([row["share"]]), "which": np.array([row["which"]], np.int32), "x": row["v"][k : k + 1], "part": np.array([row["part"]])}

    found = spread(blocks.join(wanted, "block"), by, "share double, which int, x double, part double", at)
    ends = [F.max(F.when(F.col("which") == w, F.col("x"))).alias(c) for w, c in ((0, "low"), (1, "high"))]
    return found.groupBy(*by, "share").agg(*ends, F.max("part").alias("part"))


def quantiles(df: DataFrame, by: list[str], value: str, shares: list[float], out: str = "quantile") -> DataFrame:
    """Exact quantiles per group, interpolated between the two nearest values: (by..., share, out)."""
    ends = quantile_ends(df, by, value, shares)
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") * (1 - F.col("part")) + F.col("high") * F.col("part"))
    return ends.select(*by, "share", between.alias(out))


def median(df: DataFrame, by: list[str], value: str, out: str = "median") -> DataFrame:
    return quantiles(df, by, value, [0.5], out).drop("share")


def numbered(df: DataFrame, by: list[str], order: list[str], out: str) -> DataFrame:
    """Add the place (1, 2, ...) of each row in its group along ``order``; rows that are equal in ``order`` take places in turn.

    Rows are dealt by range and counted in their task; what a group has in earlier tasks is added. At most one group runs over from a task into the next, so
    what is added is one row per task at most, and that is broadcast.
    """
    dealt = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema], "__task int, __at long"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, had = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for c in by:
                codes = pc.fill_null(batch[c].dictionary_encode().indices, -1).to_numpy()
                new[1:] |= codes[1:] != codes[:-1]
            head = tuple(batch[c][0].as_py() for c in by)
            begins = np.append(0, np.flatnonzero(new))
            at = np.arange(batch.num_rows) - np.repeat(begins, np.diff(np.append(begins, batch.num_rows))) + 1
            if head == last:
                at[: begins[1] if len(begins) > 1 else None] += had
            last, had = tuple(batch[c][-1].as_py() for c in by), int(at[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, task, np.int32)), pa.array(at)], names=[*batch.schema.names, "__task", "__at"])

    rows = cut_lineage(dealt.mapInArrow(count, schema))
    sizes = rows.groupBy(*by, "__task").agg(F.max("__at").alias("__n"))
    w = Window.partitionBy(*by).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    over = sizes.withColumn("__before", F.sum("__n").over(w)).filter("__before > 0")
    over = over.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], F.col("__task").alias("__t"), "__before")
    same = F.col("__task") == F.col("__t")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__k{i}"))
    joined = rows.join(F.broadcast(over), same, "left")
    return joined.select(*df.columns, (F.col("__at") + F.coalesce("__before", F.lit(0))).alias(out))
