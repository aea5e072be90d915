"""Near-duplicate vectors: random-hyperplane tables, exact cosines inside buckets, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.llm.groups import components, forest, whole_groups
from herdframe.session import cut_lineage

THRESHOLD = 0.98
RECALL = 0.9999
BLOCK_ROWS = 1024
_STRIPE = 256


def tables_for(threshold: float, bits: int, recall: float) -> int:
    """Tables after which a pair at the threshold shares a bucket with at least the given probability."""
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log(1 - same))


def bits_for(rows: int) -> int:
    """Bits of a sign pattern: about one bucket per vector, so that unlike vectors rarely meet however many there are."""
    return min(30, max(8, math.ceil(math.log2(rows + 1))))


def _planes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def _sign_keys(vectors: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """One row per vector with ``keys``: its sign pattern in every table."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            batch = batch.reset_index(drop=True)
            sizes = batch["vec"].map(len)
            keys = pd.Series([None] * len(batch), dtype=object)
            for dim in sizes.unique():
                at = np.flatnonzero(sizes.to_numpy() == dim)
                signs = np.stack(batch["vec"].iloc[at].to_list()) @ _planes(int(dim), bits, tables, seed) > 0
                packed = signs.reshape(len(at), tables, bits) @ weights
                for i, row in zip(at, packed.astype(np.int32), strict=True):
                    keys.iat[i] = row
            yield batch.assign(keys=keys)

    return vectors.mapInPandas(hashed, "cls long, label int, copies long, vec array<double>, keys array<int>")


def _links(dealt: DataFrame, threshold: float) -> DataFrame:
    """Links of the vectors of each bucket's block pair: (edge 0, cls, n) counts of linked vectors and (edge 1, cls, n) pairs that join them.

    A pair counts in the first table in which it shares a bucket, so over all buckets it counts once.
    """

    def verify(vec: np.ndarray, at: np.ndarray, cls: np.ndarray, copies: np.ndarray, keys: np.ndarray, side: np.ndarray, table: int) -> list[tuple]:
        sizes = np.diff(at)
        count, ea, eb = np.zeros(len(cls), np.int64), [], []
        for dim in np.unique(sizes):
            rows = np.flatnonzero(sizes == dim)
            x = vec[at[rows][:, None] + np.arange(dim)]
            norms = np.sqrt((x * x).sum(1))
            for s in range(0, len(rows), _STRIPE):
                mine = rows[s : s + _STRIPE]
                close = x[s : s + _STRIPE] @ x.T / (norms[s : s + _STRIPE, None] * norms[None, :]) >= threshold
                i, j = np.nonzero(close)
                a, b = mine[i], rows[j]
                use = (a < b) & ((side[a] == 2) | (side[a] != side[b]))
                a, b = a[use], b[use]
                new = np.ones(len(a), bool)
                for t in range(table if len(a) else 0):
                    new &= keys[a, t] != keys[b, t]
                a, b = a[new], b[new]
                np.add.at(count, a, copies[b])
                np.add.at(count, b, copies[a])
                ra, rb = forest(len(cls), a, b)
                ea.append(ra)
                eb.append(rb)
        a, b = forest(len(cls), np.concatenate(ea), np.concatenate(eb))
        got = np.flatnonzero(count)
        return [(0, cls[got], count[got]), (1, cls[a], cls[b])]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, ["tbl", "bucket", "lo", "hi"]):
            table, ends, flat = part["tbl"].to_numpy(), part.pop("ends"), part["vec"]
            vec, at = flat.flatten().to_numpy(), flat.offsets.to_numpy().astype(np.int64)
            at = at - at[0]
            keys = part["keys"].flatten().to_numpy().reshape(len(table), -1)
            cls, copies, side = (part[c].to_numpy() for c in ("cls", "copies", "side"))
            out: list[tuple] = []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                if b - a > 1:
                    out += verify(vec, at[a : b + 1], cls[a:b], copies[a:b], keys[a:b], side[a:b], int(table[a]))
            if out:
                kind = np.repeat([k for k, _, _ in out], [len(x) for _, x, _ in out]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([x for _, x, _ in out])), pa.array(np.concatenate([y for _, _, y in out]))], names=["edge", "cls", "n"])

    place = ["tbl", "bucket", "lo", "hi"]
    return dealt.repartition(*place).sortWithinPartitions(*place).mapInArrow(stream, "edge int, cls long, n long")


def _deal(hashed: DataFrame, block_rows: int) -> DataFrame:
    """Vectors by (table, label, key) bucket and, in buckets of more than ``block_rows``, by pair of blocks."""
    entries = hashed.select("cls", "label", F.posexplode("keys").alias("tbl", "key"))
    entries = entries.withColumn("bucket", F.xxhash64("label", "key"))
    counts = entries.groupBy("tbl", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    placed = entries.join(counts, ["tbl", "bucket"])
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    placed = placed.select("cls", "tbl", "bucket", blocks.alias("k"), F.pmod(F.xxhash64("cls", F.lit("block")), blocks).cast("int").alias("b"))
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    placed = placed.select(
        "cls", "tbl", "bucket", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"),
        F.when(F.col("b") == F.col("o"), 2).when(F.col("b") < F.col("o"), 0).otherwise(1).alias("side"),
    )
    return placed.join(hashed.select("cls", "copies", "vec", "keys"), "cls")


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, bits: int | None = None, recall: float = RECALL, seed: int = 7, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Links between vectors of equal label with cosine at or above ``threshold`` (>= in double precision).

    Takes vec_id, embedding, label; returns vec_id, n_links, component_id, kept, one row per input row. Equal vectors of a label are
    one class, whose copies link with each other without being paired. ``bits`` follows the number of classes if not given. A pair of classes at the threshold shares a bucket with
    probability ``recall``; pairs in a bucket are always verified, in blocks of bounded size. Null labels and vectors that are null, empty, zero or
    hold null or non-finite components link with nothing; vectors of different length neither. Repeated vec_ids are
    rows of their own that share a component; an empty table gives an empty result; other columns are ignored, whatever their names.
    """
    vec = F.col("embedding").cast("array<double>")
    norm = F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x)
    usable = F.col("label").isNotNull() & norm.isNotNull() & ~F.isnan(norm) & (norm > 0) & (norm < F.lit(float("inf")))
    # The class of a vector: its bytes and label. -0.0 and 0.0 are one value.
    text = F.concat_ws(",", F.transform(vec, lambda x: (x + F.lit(0.0)).cast("string")))
    rows = vectors.select("vec_id", F.col("label").cast("int").alias("label"), vec.alias("vec"), F.when(usable, F.sha2(F.concat_ws("|", F.col("label").cast("string"), text), 256)).alias("digest"))
    known = rows.filter("digest is not null")
    classes = known.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    classes = cut_lineage(classes.withColumn("cls", F.xxhash64("digest")))
    bits = bits or bits_for(classes.count())
    tables = tables_for(threshold, bits, recall)
    hashed = cut_lineage(_sign_keys(classes.select("cls", "label", "copies", "vec"), bits, tables, seed))
    links = cut_lineage(_links(_deal(hashed, block_rows), threshold))
    counts = links.filter("edge = 0").groupBy("cls").agg(F.sum("n").alias("others"))
    groups = components(links.filter("edge = 1").select(F.col("cls").alias("src"), F.col("n").alias("dst")))
    named = classes.select("digest", "cls", "copies", "rep").join(counts, "cls", "left").join(groups, F.col("cls") == F.col("node"), "left")
    named = named.withColumn("component", F.coalesce("component", "cls")).select("digest", "copies", "rep", "others", "component")
    named = cut_lineage(named)
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "component").select("digest", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = known.select("vec_id", "digest").join(named, "digest", "left").select("vec_id", "n_links", "component_id")
    alone = rows.filter("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
