"""Mixing sources to target weights by pivotal dependent rounding of copy counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herdframe.session import cut_lineage

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
ROWS_PER_GROUP = 2_000
PARTS = 256
_WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, docs, target. ``sizes`` has one row per document: source, size.

    Sources take the weights in turn by code point, null last; their place is found from a sorted table and the
    row counts of its partitions. Targets share the total by weight; a target above ``most`` times its source's
    size stops there and the excess is shared again, until none is above. Each round is one aggregate.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ordered = cut_lineage(totals.orderBy(F.asc_nulls_last("source")).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    parts = ordered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("__part", F.coalesce(before, F.lit(0)).alias("__from"))
    place = F.col("__from") + F.col("__at") - F.shiftleft(F.col("__part"), 33)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = ordered.withColumn("__part", part).join(parts, "__part").select("source", "source_size", "docs", weight.alias("weight"))
    ranked = cut_lineage(ranked)
    cap, level = F.col("source_size") * float(most), 0.0
    while True:
        stopped = cap < F.col("weight") * level
        sums = ranked.agg(
            F.sum("source_size").alias("total"), F.sum(F.when(stopped, cap)).alias("held"), F.sum(F.when(~stopped, F.col("weight"))).alias("free")
        ).first()
        if not sums["total"] or not sums["free"]:
            break
        now = (sums["total"] - (sums["held"] or 0.0)) / sums["free"]
        if now <= level:
            break
        level = now
    return ranked.withColumn("target", F.least(cap, F.col("weight") * level).cast("double"))


def _pivot(size: np.ndarray, share: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, int]:
    """Round shares in (0, 1) to 0 or 1 so that the sum of size times share stays, but for one row that may remain fractional.

    Two rows at a time move mass, in opposite directions weighted by size, until one is 0 or 1; the direction is random with
    odds that keep each row's expected share. Returns the shares and the row that remains, or -1.
    """
    size, share, held = size.tolist(), share.tolist(), -1
    coins = draw.random(len(share)).tolist()
    for i, b in enumerate(share):
        if not 0 < b < 1:
            continue
        if held < 0:
            held = i
            continue
        a, wa, wb = share[held], size[held], size[i]
        up, down = min((1 - a) * wa, b * wb), min(a * wa, (1 - b) * wb)  # mass the held row can take or give
        if coins[i] * (up + down) < down:
            share[held], share[i] = (1.0, b - (1 - a) * wa / wb) if (1 - a) * wa <= b * wb else (a + b * wb / wa, 0.0)
        else:
            share[held], share[i] = (0.0, b + a * wa / wb) if a * wa <= (1 - b) * wb else (a - (1 - b) * wb / wa, 1.0)
        for k in (held, i):
            share[k] = round(share[k]) if min(abs(share[k]), abs(1 - share[k])) < 1e-12 else share[k]
        held = held if 0 < share[held] < 1 else i if 0 < share[i] < 1 else -1
    return np.array(share, float), held


def round_shares(rows: DataFrame, seed: int = 11, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Dependent rounding of ``share`` (0..1) inside each source. ``rows``: source_key, key, size (> 0), share and any further columns.

    A tree: groups of about ``rows_per_group`` rows of a source are rounded on their own, each leaves at most one fractional row,
    those are grouped again, until each source has one; that row goes to the nearer of 0 and 1. ``share`` becomes 0 or 1. Groups are dealt and
    ordered by ``key`` (a hash of the row), so reruns agree; the sum of size times share of a source moves by at most
    half of one row's size.
    """
    schema = rows.schema

    def level(deep: int):
        def step(batch: pd.DataFrame) -> pd.DataFrame:
            batch = batch.sort_values(["key", "size", "share"], kind="stable").reset_index(drop=True)
            draw = np.random.default_rng([seed, deep, int(batch["key"].iat[0]) & 0xFFFFFFFF, len(batch)])
            share, _ = _pivot(batch["size"].to_numpy(), batch["share"].to_numpy(), draw)
            return batch.assign(share=share)[schema.names]

        return step

    done, deep = [], 0
    left = rows
    while True:
        counts = left.groupBy("source_key").agg(F.ceil(F.count(F.lit(1)) / rows_per_group).cast("int").alias("__groups"))
        grouped = left.join(counts, "source_key").withColumn("__group", F.pmod(F.xxhash64("key", F.lit(deep)), F.col("__groups")))
        dealt = grouped.repartition("source_key", "__group")  # a large source is spread over its groups
        out = cut_lineage(dealt.groupBy("source_key", "__group").applyInPandas(level(deep), schema))
        done.append(out.filter("share = 0 or share = 1"))
        left = out.filter("share > 0 and share < 1")
        most = left.groupBy("source_key").count().agg(F.max("count")).first()[0]
        if (most or 0) <= 1:
            break
        deep += 1
    last = left.withColumn("share", F.when(F.col("share") >= 0.5, 1.0).otherwise(0.0))
    for part in done:
        last = last.unionByName(part)
    return last


def _identity(df: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return df.withColumns({"__size": F.regexp_count(text, F.lit(_WORDS)).cast("long"), "__hash": F.xxhash64(text, F.lit("text"))})


def decide(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 11) -> DataFrame:
    """How often the mix takes the rows of each (doc_id, source, text): rows (equal ones in the input), size, source_size, target, whole, extra.

    A source with target t and size s has t/s copies of each row on average: the whole part is given, the fraction is
    rounded dependently, so a source misses its target by at most half of its largest row. Of equal rows, each has ``whole``
    copies and ``extra`` of them one more: the whole part of the fraction times rows, and what is left of one row is rounded. Rows without
    words have one copy and count nothing. A row has 0 to ``most`` copies.
    """
    sized = _identity(docs).groupBy("doc_id", "source", F.col("__size").alias("size"), F.col("__hash").alias("text_hash")).agg(F.count(F.lit(1)).alias("rows"))
    sized = cut_lineage(sized)
    targets = cut_lineage(source_targets(sized.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, most))
    keyed = F.struct("source").alias("source_key")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(1.0)
    facts = targets.select(keyed, "source_size", "target", rate.alias("rate"))
    rows = sized.select("doc_id", keyed, F.col("size").alias("each"), "text_hash", "rows").join(facts, "source_key")
    whole = F.floor("rate").cast("int")
    part = (F.col("rate") - whole) * F.col("rows")
    sure = F.floor(part).cast("long")
    rows = rows.select(
        "doc_id", "source_key", "each", "text_hash", "rows", "source_size", "target", whole.alias("whole"), sure.alias("sure"), (part - sure).alias("share"),
        F.col("each").alias("size"), F.xxhash64("doc_id", "text_hash", F.lit(seed)).alias("key"),
    )
    empty = rows.filter("size = 0").withColumns({"whole": F.lit(1), "sure": F.lit(0).cast("long"), "share": F.lit(0.0)})
    mixed = round_shares(rows.filter("size > 0"), seed).unionByName(empty)
    return mixed.select(
        "doc_id", F.col("source_key.source").alias("source"), F.col("each").alias("size"), "text_hash", "rows", "source_size", "target",
        "whole", (F.col("sure") + F.col("share").cast("long")).alias("extra"),
    )


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 11) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target (its source's), copies, taken (words the mix takes).

    The size is the number of runs of characters other than ASCII white space; a null text has none. Null ids and sources are
    values like any other, an empty table gives an empty result, other columns are ignored.
    """
    each = decide(docs, weights, most, seed).withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    each = each.withColumn("copies", F.col("whole") + (F.col("__i") <= F.col("extra")).cast("int"))
    return each.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 11) -> DataFrame:
    """The mixed table: each row as often as the mix takes it, with the columns of ``docs``, further ones as they are.

    Rows of no words have size 0 and are taken once; a null source is a source of its own, after the others; rows with a null id or text take part like others;
    rows equal in id, source and text are dealt their copies one by one; a text of any length is one row, so its source may miss its target by half
    of it; an empty table gives an empty one. Column names that begin with two underscores are reserved.
    """
    taken = decide(docs, weights, most, seed).filter("whole > 0 or extra > 0")
    taken = taken.select(F.struct("doc_id", "source", "text_hash").alias("__key"), F.col("whole").alias("__whole"), F.col("extra").alias("__extra"), F.col("rows").alias("__rows"))
    keyed = _identity(docs).withColumn("__key", F.struct("doc_id", "source", F.col("__hash").alias("text_hash")))
    joined = keyed.join(taken, "__key")
    some = (F.col("__extra") > 0) & (F.col("__extra") < F.col("__rows"))
    alike = joined.filter(~some).withColumn("__copies", F.col("__whole") + (F.col("__extra") > 0).cast("int"))
    # Equal rows of which some have one more are numbered in parts, so that no task sorts all rows of a key.
    dealt = cut_lineage(joined.filter(some).withColumn("__part", F.monotonically_increasing_id() % PARTS))
    counts = dealt.groupBy("__key", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.xxhash64("__key").alias("__of"), F.col("__key").alias("__same"), F.col("__part").alias("__in"), F.coalesce(before, F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__key", "__part").orderBy(F.lit(0)))
    numbered = dealt.withColumn("__place", place).join(counts, (F.xxhash64("__key") == F.col("__of")) & (F.col("__part") == F.col("__in")) & F.col("__key").eqNullSafe(F.col("__same")))
    each = numbered.withColumn("__copies", F.col("__whole") + (F.col("__place") + F.col("__before") <= F.col("__extra")).cast("int"))
    columns = [*[F.col(f"`{c}`") for c in docs.columns], "__copies"]
    mixed = alike.select(*columns).unionByName(each.select(*columns))
    mixed = mixed.withColumn("__copies", F.explode(F.array_repeat(F.lit(0), F.col("__copies"))))
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns])
