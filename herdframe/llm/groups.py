"""Groups of linked rows: connected components as joins, and streams of whole groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the undirected edges (src, dst); the component is its smallest node.

    Alternates large-star and small-star steps until no edge changes. Every step is an aggregation to the smallest
    neighbour and a join back; each round is stored in the shared folder. Nulls and loops are ignored; without
    edges the result is empty.
    """
    edges = cut_lineage(edges.filter("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    mark = None
    while True:
        both = edges.unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
        large = both.filter("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        large = cut_lineage(large.filter("src <> dst").distinct())
        least = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(least, "src").select(
            F.explode(F.array(F.struct(F.col("dst").alias("src"), F.col("m").alias("dst")), F.struct("src", F.col("m").alias("dst")))).alias("e")
        )
        edges = cut_lineage(small.select("e.*").filter("src <> dst").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionAll(
        edges.select("dst", "dst").distinct().toDF("node", "component")
    )


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join the same rows as the pairs (a, b) of rows 0..n-1: each row with the smallest of its group."""
    low = np.arange(n)
    while len(a):
        m = np.minimum(low[a], low[b])
        before = low.copy()
        np.minimum.at(low, a, m)
        np.minimum.at(low, b, m)
        low = low[low]
        if (before == low).all():
            break
    rows = np.flatnonzero(low != np.arange(n))
    return rows, low[rows]


def whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[dict]:
    """Columns of a sorted stream of batches, cut so that no group of equal ``by`` values (integers) is split; ``ends`` are the places where groups begin,
    and the end. At most one batch and one group are held."""
    held: list[pa.RecordBatch] = []

    def given(parts: list[pa.RecordBatch]) -> dict:
        table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        out = {c: table[c] for c in table.schema.names}
        out["ends"] = _begins(table, by)
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(_begins(batch, by)[-2])
        if held:
            same = all(held[-1][c][-1] == batch[c][0] for c in by)
            if not same:
                yield given(held)
                held = []
            elif last == 0:
                held.append(batch)
                continue
        if last:
            yield given([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield given(held)


def _begins(batch: pa.RecordBatch, by: list[str]) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for c in by:
        v = batch[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), batch.num_rows)
