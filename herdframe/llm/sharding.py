"""Shards by a hierarchical weighted hash tree: region, rack and shard are drawn one after the other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdframe.session import cut_lineage

ROWS_PER_BIN = 50_000


def tree(shards: int, per_rack: int = 4, racks_per_region: int = 2) -> dict[int, dict[int, dict[int, float]]]:
    """Region -> rack -> shard -> weight. Shards fill racks and racks fill regions in the order of their numbers,
    so the tree follows from the shard count alone and a full tree grows by a region of its own."""
    out: dict[int, dict[int, dict[int, float]]] = {}
    for shard in range(shards):
        rack = shard // per_rack
        out.setdefault(rack // racks_per_region, {}).setdefault(rack, {})[shard] = 1.0
    return out


def _draw(key: Column, level: str, weights: dict[int, float]) -> Column:
    """The node with the smallest weighted draw; a node wins in proportion to its weight. A node's draw depends on
    the key and the node alone, so changing one weight moves rows only into or out of that node."""
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    draws = []
    for node, weight in sorted(weights.items()):
        uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(node)), 11).cast("double") + 0.5) / float(1 << 53)
        draws.append(F.struct((-F.log(uniform) / weight).alias("draw"), F.lit(node).alias("node")))
    return F.least(*draws)["node"]


def _case(of: Column, choices: dict[int, Column]) -> Column:
    if len(choices) == 1:
        return next(iter(choices.values()))
    return reduce(lambda c, kv: c.when(of == kv[0], kv[1]), list(choices.items())[1:], F.when(of == next(iter(choices)), next(iter(choices.values()))))


def assign(df: DataFrame, key: str, layout: dict, out: str = "shard") -> DataFrame:
    """Add the shard of each row. A null key is a key like any other; equal keys share a shard.

    The region is drawn among the regions by their total weights, then a rack inside it, then a shard. Changing the weight of
    a shard changes the weights on its path only, so rows move only between subtrees on whose paths a weight changed.
    """
    total = lambda t: sum(total(x) for x in t.values()) if isinstance(t, dict) else t
    k = F.coalesce(F.col(key).cast("string"), F.lit("\0null"))
    region = _draw(k, "region", {r: total(x) for r, x in layout.items()})
    df = df.withColumn("__region", region)
    rack = _case(F.col("__region"), {r: _draw(k, "rack", {c: total(x) for c, x in racks.items()}) for r, racks in layout.items()})
    df = df.withColumn("__rack", rack)
    racks = {c: shards for x in layout.values() for c, shards in x.items()}
    shard = _case(F.col("__rack"), {c: _draw(k, "shard", shards) for c, shards in racks.items()})
    return df.withColumn(out, shard.cast("int")).drop("__region", "__rack")


def number_rows(df: DataFrame, group: str, order: list[str], out: str = "slot", rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in the order of hash bins and of ``order`` inside a bin.

    Bins follow the row count, so no task sorts more than about ``rows_per_bin`` rows, but for equal rows. Counts per bin are
    summed over the small table of bins. ``df`` should be stored: it is read three times. Rows equal in ``order``
    are told apart by no column, so which of them has which number is left open; the set of rows is the same.
    """
    groups = df.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(group).alias("g")).first()
    bins = max(1, round(groups["n"] / max(1, groups["g"]) / rows_per_bin))
    rows = df.withColumn("__bin", F.pmod(F.xxhash64(*order, F.lit("slot")), F.lit(bins)))
    counts = rows.groupBy(group, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "__bin", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__from"))
    place = F.row_number().over(Window.partitionBy(group, "__bin").orderBy(*order))
    placed = rows.withColumn("__place", place).join(starts, [group, "__bin"])
    return placed.withColumn(out, F.col("__from") + F.col("__place") - 1).drop("__bin", "__from", "__place")


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Put documents into shards by doc_id; one row per input row, without the text.

    Returns doc_id, size (UTF-8 bytes of the text plus 16; a null text has none), text_crc32, law ``key``, shard,
    slot (0, 1, ... inside the shard), grown_shard (with one more shard; the full tree opens a region for it,
    so rows move only into the new shard). A null id is one key, repeated rows and ids share a shard and have slots of their own, an
    empty table gives an empty result, further columns are ignored. The text's CRC of null is that of the empty text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law")
    )
    facts = assign(assign(facts, "doc_id", tree(shards)), "doc_id", tree(shards + 1), "grown_shard")
    done = number_rows(cut_lineage(facts), "shard", ["doc_id", "text_crc32", "size"])
    return done.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
