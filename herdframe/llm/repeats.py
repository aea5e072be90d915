"""Substring dedup: Rabin-Karp hashes of word windows, counted in Spark, merged into removal intervals."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdframe.llm.counted import join_counted
from herdframe.llm.words import list_column, mix, slices, split_words
from herdframe.session import cut_lineage, drop_stages

WINDOW = 50
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _inverse(odd: np.uint64) -> np.uint64:
    """Inverse modulo 2 ** 64."""
    return np.uint64(pow(int(odd), -1, 1 << 64))


def rolling(words: np.ndarray, size: int, base: np.uint64 = _BASES[0]) -> np.ndarray:
    """Rabin-Karp hash of the ``size`` values from each place on: sum of value j times base ** j, modulo 2 ** 64, as a difference of prefix sums."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.append(np.uint64(1), np.full(len(words) - 1, base)), dtype=np.uint64)
    sums = np.append(np.uint64(0), np.cumsum(words * powers, dtype=np.uint64))
    back = np.cumprod(np.append(np.uint64(1), np.full(n - 1, _inverse(base))), dtype=np.uint64)
    return mix((sums[size:] - sums[:n]) * back)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` values from each place on."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _hashed(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of the texts, a 64-bit hash of each, and where each text's words begin."""
    flat, starts = split_words(texts, lower=False)
    coded = flat.dictionary_encode()
    kinds = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return flat, kinds[coded.indices.to_numpy(zero_copy_only=False)], starts


def _text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(F.lit(k), text).alias(f"t{k}") for k in (1, 2)]


def _anchored(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, ord, t1, t2, n_words, kept_sha256 (of all words) and ``runs``: (anchor, lo, hi), the least hash of a short run in each of the windows lo to hi.

    Equal windows have equal anchors, so a window whose anchor stands in one text only cannot repeat; there are about three anchors per window length.
    """
    short = max(1, window // 3)

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                flat, hashes, starts = _hashed(piece["text"])
                every = rolling(hashes, short)
                every = _sliding_least(every, window - short + 1) if len(hashes) >= window else every[:0]
                anchors, lows, highs, sizes, digests = [], [], [], [], []
                for a, b in zip(starts[:-1], starts[1:], strict=True):
                    digests.append(hashlib.sha256(_joined(flat.slice(a, b - a))).hexdigest())
                    least = every[a : max(a, b - window + 1)]
                    begins = np.flatnonzero(np.append(True, least[1:] != least[:-1])) if len(least) else np.zeros(0, np.int64)
                    anchors.append(least[begins])
                    lows.append(begins)
                    highs.append(np.append(begins[1:], len(least))[: len(begins)] - 1)
                    sizes.append(len(begins))
                at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                runs = pa.StructArray.from_arrays([pa.array(np.concatenate(anchors).view(np.int64)), pa.array(np.concatenate(lows).astype(np.int32)), pa.array(np.concatenate(highs).astype(np.int32))], names=["anchor", "lo", "hi"])
                runs = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), runs)
                yield pa.RecordBatch.from_arrays(
                    [piece["doc_id"], piece["ord"], piece["t1"], piece["t2"], pa.array(np.diff(starts)), pa.array(digests, pa.string()), runs], names=["doc_id", "ord", "t1", "t2", "n_words", "kept_sha256", "runs"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(anchor, f"doc_id {kind}, ord long, t1 long, t2 long, n_words long, kept_sha256 string, runs array<struct<anchor:long,lo:int,hi:int>>")


def _joined(words: pa.Array) -> bytes:
    if not len(words):
        return b""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), pa.scalar(" ", words.type))[0].as_py().encode()


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """h1, h2 (128 bits of the window), ord, t1, t2, place: one row per window that may repeat. ``texts``: ord, t1, t2, text, spans (lo, hi)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                _, hashes, starts = _hashed(piece["text"])
                every = [rolling(hashes if k == 0 else mix(hashes), window, _BASES[k]).view(np.int64) for k in (0, 1)]
                spans = piece["spans"]
                at = spans.offsets.to_numpy().astype(np.int64)
                at, (lows, highs) = at - at[0], (x.to_numpy() for x in spans.flatten().flatten())
                for i, a in enumerate(starts[:-1]):
                    lo, hi = lows[at[i] : at[i + 1]].astype(np.int64), highs[at[i] : at[i + 1]].astype(np.int64)
                    width = hi - lo + 1
                    places = np.sort(np.repeat(lo - np.cumsum(width) + width, width) + np.arange(width.sum()))
                    same = [pa.array(np.full(len(places), piece[c][i].as_py(), np.int64)) for c in ("ord", "t1", "t2")]
                    yield pa.RecordBatch.from_arrays([*[pa.array(x[a + places]) for x in every], *same, pa.array(places.astype(np.int32))], names=["h1", "h2", "ord", "t1", "t2", "place"])

    return texts.mapInArrow(cut, "h1 long, h2 long, ord long, t1 long, t2 long, place int")


def merged(places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals [begin, end) of words covered by windows at the sorted places."""
    if not len(places):
        return places, places
    new = np.flatnonzero(np.append(True, np.diff(places) > window))
    return places[new], places[np.append(new[1:], len(places)) - 1] + window


def _cut_out(texts: DataFrame, window: int) -> DataFrame:
    """ord, t1, t2, begins, ends, n_removed, cut_sha256 of the texts without the words of the windows at ``places``."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                flat, starts = split_words(piece["text"], lower=False)
                every, at = piece["places"].flatten().to_numpy(), piece["places"].offsets.to_numpy().astype(np.int64)
                at = at - at[0]
                intervals, sizes, removed, digests = [], [0], [], []
                for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                    begin, end = merged(np.sort(every[at[i] : at[i + 1]]).astype(np.int64), window)
                    out = np.zeros(b - a + 1, np.int64)
                    out[begin] += 1
                    out[end] -= 1
                    kept = np.cumsum(out)[:-1] == 0
                    intervals.append((begin, end))
                    sizes.append(sizes[-1] + len(begin))
                    removed.append(int((end - begin).sum()))
                    digests.append(hashlib.sha256(_joined(flat.slice(a, b - a).filter(pa.array(kept)))).hexdigest())
                begins, ends = (list_column(np.concatenate([x[k] for x in intervals]), np.array(sizes), pa.int32()) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([piece["ord"], piece["t1"], piece["t2"], begins, ends, pa.array(removed, pa.int64()), pa.array(digests)], names=["ord", "t1", "t2", "begins", "ends", "n_removed", "cut_sha256"])

    return texts.mapInArrow(remove, "ord long, t1 long, t2 long, begins array<int>, ends array<int>, n_removed long, cut_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words outside of passages that a document with a smaller id has too: doc_id, n_words, n_removed, kept_sha256, begins, ends, one row per input row.

    Words are runs of characters other than ASCII white space. Every word covered by a ``window`` of consecutive words whose sequence also starts in
    a document of smaller id is removed; windows are judged on the texts as given. ``begins`` and ``ends`` are the maximal intervals of
    removed words, counted from 0, ends not included; kept_sha256 is the digest of the kept words joined by one space.

    Windows have 128-bit rolling hashes, which Spark counts. Of equal texts only that of the smallest id is cut into windows: the others are covered whole. A
    window is counted if the least hash of its short runs stands in two texts; others cannot repeat. Runs and windows that stand in a large part of all
    texts are few and broadcast. What is held at once is one text's windows.

    Null and empty texts and texts of fewer words than a window lose nothing; a passage that repeats in one document only stays; rows that repeat an id
    count as one document; a null id is larger than all others, and rows of null ids keep what they share among themselves; an empty table gives an
    empty result; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("ord"), *_text_key(text), text.alias("text"))
    known = cut_lineage(_anchored(rows, window))
    long = known.filter(F.col("n_words") >= window)
    # one row per text: hot copies are combined before the shuffle, and all have the same runs
    classes = cut_lineage(long.groupBy("t1", "t2").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n"), F.first("runs").alias("runs")))
    runs = classes.select("ord", "t1", "t2", F.explode("runs").alias("r")).select("ord", "t1", "t2", "r.anchor", "r.lo", "r.hi")
    shared = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("a"), F.max("ord").alias("b")).filter("a < b")
    shared = cut_lineage(shared.select("anchor", "n"))
    spans = join_counted(runs, shared, ["anchor"]).groupBy("ord", "t1", "t2").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    texts = cut_lineage(rows.drop("doc_id").join(spans, ["ord", "t1", "t2"]))
    windows = cut_lineage(_windows(texts, window))
    counted = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("least"), F.max("ord").alias("b")).filter("least < b")
    counted = cut_lineage(counted.drop("b"))
    places = join_counted(windows, counted, ["h1", "h2"]).filter("ord > least").groupBy("ord", "t1", "t2").agg(F.collect_set("place").alias("places"))
    cut = cut_lineage(_cut_out(texts.drop("spans").dropDuplicates(["ord", "t1", "t2"]).join(places, ["ord", "t1", "t2"]), window))
    drop_stages(shared, texts, windows, counted)
    first = join_counted(long.drop("runs"), classes.select("t1", "t2", F.col("ord").alias("first"), "n"), ["t1", "t2"])
    found = first.join(cut, ["ord", "t1", "t2"], "left")
    copy = F.col("ord") > F.col("first")
    whole = lambda of: F.array(of.cast("int"))
    empty = F.array().cast("array<int>")
    cleaned = found.select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha256", "kept_sha256")).alias("kept_sha256"),
        F.when(copy, whole(F.lit(0))).otherwise(F.coalesce("begins", empty)).alias("begins"), F.when(copy, whole(F.col("n_words"))).otherwise(F.coalesce("ends", empty)).alias("ends"),
    )
    short = known.filter(F.col("n_words") < window).select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", empty.alias("begins"), empty.alias("ends"))
    return cleaned.unionByName(short)
