"""Importance resampling towards a target: hashed word-run features, counted once per distinct line."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdframe.llm.counted import join_counted
from herdframe.llm.words import list_column, slices, split_words
from herdframe.session import cut_lineage

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = 10
SEED = "2024"
_TREE = 64

#: What each UTF-8 byte becomes: A-Z their lower case, all of ASCII but digits and letters a space; bytes of other characters stay.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[: 0x80] = [ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(0x80)]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of the texts, one after the other, and where each text's words begin."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if data is not None:
        data = pa.py_buffer(_BYTES[np.frombuffer(data, np.uint8)])
        texts = pa.LargeStringArray.from_buffers(len(texts), offsets, data, None, 0, texts.offset)
    return split_words(texts, lower=False)


def _buckets(features: pa.Array, buckets: int) -> np.ndarray:
    coded = features.dictionary_encode()
    kinds = np.fromiter((zlib.crc32(w.encode()) % buckets for w in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
    return kinds[coded.indices.to_numpy(zero_copy_only=False)]


def _runs(flat: pa.Array, owner: np.ndarray, ngrams: int, apart: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """Runs of 1 to ``ngrams`` words of one owner, and whose they are. With ``apart`` (the line of each word), only runs that leave a line."""
    texts, owners = [], []
    for k in range(1, ngrams + 1):
        n = max(len(flat) - k + 1, 0)
        use = owner[:n] == owner[k - 1 :]
        if apart is not None:
            use &= apart[:n] != apart[k - 1 :]
        mask = pa.array(use)
        parts = [flat.slice(j, n).filter(mask) for j in range(k)]
        texts.append(parts[0] if k == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", parts[0].type)))
        owners.append(owner[:n][use])
    return pa.chunked_array(texts).combine_chunks(), np.concatenate(owners)


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(owner, kind="stable")
    return values[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int64)


def _line_key(line: Column) -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64(F.lit(k), line).alias(f"h{k}") for k in (1, 2)]


def _lines(docs: DataFrame) -> Column:
    return F.split(F.coalesce(docs["text"], F.lit("")), "\n")


def line_features(docs: DataFrame, ngrams: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """h1, h2 (the line), n (how often it stands in the texts), words, buckets (of all its word runs, repeats kept): one row per distinct line with words."""

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "line"):
                flat, starts = _words(piece["line"])
                count = np.diff(starts)
                runs, owner = _runs(flat, np.repeat(np.arange(len(count)), count), ngrams)
                values, at = _lists(_buckets(runs, buckets), owner, len(count))
                out = pa.RecordBatch.from_arrays([piece["h1"], piece["h2"], piece["n"], pa.array(count), list_column(values, at, pa.int32())], names=["h1", "h2", "n", "words", "buckets"])
                yield out.filter(pa.array(count > 0))

    lines = docs.select(F.explode(_lines(docs)).alias("line")).filter("line <> ''").groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    keyed = lines.select(*_line_key(F.col("line")), "line", "n")
    return keyed.mapInArrow(featurise, "h1 long, h2 long, n long, words long, buckets array<int>")


def document_lines(docs: DataFrame, ngrams: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """row (a number), doc_id, lines (keys of the text's lines in order), buckets of the runs that leave a line. A stored table."""
    lines = F.transform(F.filter(_lines(docs), lambda x: x != ""), lambda x: F.struct(*_line_key(x))).alias("lines")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", lines, F.coalesce("text", F.lit("")).alias("text"))
    if ngrams == 1:
        return cut_lineage(rows.drop("text").withColumn("crossing", F.array().cast("array<int>")))

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                split = pc.split_pattern(piece["text"], "\n")
                at = split.offsets.to_numpy().astype(np.int64)
                flat, starts = _words(split.flatten())
                line = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                owner = np.repeat(np.arange(piece.num_rows), np.diff(at))[line]
                runs, whose = _runs(flat, owner, ngrams, line)
                values, begins = _lists(_buckets(runs, buckets), whose, piece.num_rows)
                yield pa.RecordBatch.from_arrays([piece["row"], piece["doc_id"], piece["lines"], list_column(values, begins, pa.int32())], names=["row", "doc_id", "lines", "crossing"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return cut_lineage(rows.mapInArrow(cross, f"row long, doc_id {kind}, lines array<struct<h1:long,h2:long>>, crossing array<int>"))


def _histogram(features: DataFrame, listed: str, times: str | None, buckets: int) -> np.ndarray:
    """How often each bucket occurs; ``times`` multiplies a row. ``features`` is a stored table.

    Each task gives one list of sums; lists are added up in groups until few are left for the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            lists = batch[listed]
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy()
            if times is None:
                sums += np.bincount(values, minlength=buckets)
            else:
                np.add.at(sums, values, np.repeat(batch[times].to_numpy(), sizes))
        yield pa.RecordBatch.from_arrays([list_column(sums, np.array([0, buckets]), pa.int64())], names=["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = sum((b["sums"].flatten().to_numpy().reshape(-1, buckets).sum(0) for b in batches), np.zeros(buckets, np.int64))
        yield pa.RecordBatch.from_arrays([list_column(sums, np.array([0, buckets]), pa.int64())], names=["sums"])

    parts = features.select(*([listed] if times is None else [listed, times])).mapInArrow(count, "sums array<long>")
    tasks = parts.rdd.getNumPartitions()
    while tasks > _TREE:
        tasks = -(-tasks // _TREE)
        parts = parts.repartition(tasks).mapInArrow(add, "sums array<long>")
    return np.array([r.sums for r in parts.collect()], np.int64).reshape(-1, buckets).sum(0)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target than in the corpus, one being added to every bucket."""
    more, all_target, all_corpus = len(corpus), float(target.sum()), float(corpus.sum())
    ratio = lambda s, t: (float(t) + 1) * (all_corpus + more) / ((float(s) + 1) * (all_target + more))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(corpus, target, strict=True)], np.int64)


def _summed(features: DataFrame, listed: str, keep: list[str], gain: np.ndarray) -> DataFrame:
    """``keep`` columns, number of features in the list, and the sum of their gains."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch[listed]
            at = lists.offsets.to_numpy().astype(np.int64)
            running = np.concatenate([[0], np.cumsum(gain[lists.flatten().to_numpy()])])
            at = at - at[0]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], pa.array(np.diff(at)), pa.array(running[at[1:]] - running[at[:-1]])], names=[*keep, "features", "gain"])

    kinds = {f.name: f.dataType.simpleString() for f in features.schema}
    return features.select(*keep, listed).mapInArrow(add, ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "features long", "gain long"]))


def resample(
    docs: DataFrame, target: DataFrame, ngrams: int = 1, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, share: int = SHARE, seed: str = SEED
) -> DataFrame:
    """Documents drawn without replacement towards the features of the ``target`` texts: doc_id, n_features, weight, score, rank, one row per input row.

    Words are runs of characters other than ASCII ones that are no digits or letters, A-Z in lower case; features are runs of 1 to ``ngrams`` words,
    hashed by CRC-32 to ``buckets``. The weight is the floored mean gain over a document's features; a Gumbel number from the id is added, and
    of the documents with ``least_words`` words the highest ``share`` per cent are ranked 1, 2, ...; the others have no rank.

    Newlines separate words, so a text's features are those of its lines and, for longer runs, those that leave a line. Each distinct line is
    cut and hashed once; its counts are multiplied by its occurrences, its gain is joined to the documents that hold it. Lines so common
    that they would crowd one task are fewer than 10,000 and broadcast. The driver sees one number per bucket and per score value.

    Null and empty texts have no features and weight 0; a text without a newline is one line, however long; a null id is hashed as an empty one and
    ranks after others of its score; rows that repeat an id and a text have equal scores and take consecutive ranks; an empty table gives an empty result,
    an empty target gains that only show how rare a bucket is; other columns are ignored.
    """
    rows = document_lines(docs, ngrams, buckets)
    lines = cut_lineage(line_features(docs, ngrams, buckets))
    own = cut_lineage(line_features(target, ngrams, buckets))
    s, t = _histogram(lines, "buckets", "n", buckets), _histogram(own, "buckets", "n", buckets)
    if ngrams > 1:
        s += _histogram(rows, "crossing", None, buckets)
        t += _histogram(document_lines(target.withColumn("doc_id", F.lit(0)), ngrams, buckets), "crossing", None, buckets)
    gain = gains(s, t)
    known = cut_lineage(_summed(lines, "buckets", ["h1", "h2", "n", "words"], gain))
    links = rows.select("row", "doc_id", F.explode("lines").alias("l")).select("row", "doc_id", "l.h1", "l.h2")
    parts = join_counted(links, known, ["h1", "h2"]).select("row", "doc_id", "words", "features", "gain")
    bare = rows.select("row", "doc_id", F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("features"), F.lit(0).cast("long").alias("gain"))
    if ngrams > 1:
        bare = _summed(rows, "crossing", ["row", "doc_id"], gain).withColumn("words", F.lit(0).cast("long"))
    sums = parts.unionByName(bare).groupBy("row", "doc_id").agg(*[F.sum(c).alias(c) for c in ("words", "features", "gain")])
    weight = F.when(F.col("features") > 0, F.expr("(gain - pmod(gain, features)) div features")).otherwise(F.lit(0))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    luck = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = sums.select("row", "doc_id", F.col("features").alias("n_features"), weight.cast("long").alias("weight"), (weight + luck).cast("long").alias("score"), (F.col("words") >= least_words).alias("enough"))
    return rank_highest(cut_lineage(scored), share).select("doc_id", "n_features", "weight", "score", "rank")


def rank_highest(scored: DataFrame, share: int) -> DataFrame:
    """Add ``rank`` to the ``share`` per cent highest scores of the rows that have ``enough``, by score and then id; null for the others.

    Scores are whole numbers of a bounded range, so how many rows are above each is a small table; only the drawn rows are sorted, each score on its own.
    """
    counts = scored.filter("enough").groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    above = cut_lineage(counts.withColumn("above", F.coalesce(F.sum("n").over(down), F.lit(0))))
    total = int(above.agg(F.sum("n")).first()[0] or 0)
    drawn = share * total // 100
    reached = above.filter(F.col("above") < drawn).drop("n")
    least = reached.agg(F.min("score")).first()[0]
    if least is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    near = F.col("enough") & (F.col("score") >= least)
    place = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "row")
    ranked = scored.filter(near).withColumn("__at", F.row_number().over(place)).join(reached, "score").withColumn("rank", (F.col("above") + F.col("__at")).cast("long"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).select(*scored.columns, "rank")
    return ranked.unionByName(scored.filter(~near).withColumn("rank", F.lit(None).cast("long")))
