"""Benchmark decontamination: shared word runs seed candidate passages, Smith-Waterman alignment scores them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.llm.words import bare_words, shingles, slices

SEED_WORDS = 3
SCORE = 0.5
BLOCK_BYTES = 8 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
_CELLS = 1 << 20
_PAIRS = 1 << 18
_WORD_TABLE = 24


@dataclass
class Items:
    """A block of test items: their words one after the other, and seeds (run of words -> item and place), sorted by run."""

    ids: list
    words: np.ndarray
    starts: np.ndarray
    runs: np.ndarray
    owner: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: pa.Array, size: int) -> Items:
        words, starts = bare_words(texts)
        runs, at = shingles(words, starts, size)
        owner = np.repeat(np.arange(len(ids)), np.diff(at))
        order = np.argsort(runs, kind="stable")
        return cls(ids, words, starts, runs[order], owner[order], (np.arange(len(runs)) - at[owner])[order])

    def word_table(self) -> np.ndarray:
        """Which bits of (item, word) are in use: a word that is not in the table is not in the item."""
        table = np.zeros(1 << _WORD_TABLE, bool)
        table[_word_spots(np.repeat(np.arange(len(self.ids)), np.diff(self.starts)), self.words)] = True
        return table


def _word_spots(item: np.ndarray, words: np.ndarray) -> np.ndarray:
    mixed = (words ^ (item.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - _WORD_TABLE)).astype(np.int64)


def _filter_table(runs: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << 20, bool)
    table[(runs >> np.uint64(44)).astype(np.int64)] = True
    return table


def _seen(values: np.ndarray, runs: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places of the values that are among the sorted ``runs``."""
    at = np.flatnonzero(table[(values >> np.uint64(44)).astype(np.int64)])
    if not len(runs):
        return at[:0]
    spot = np.minimum(np.searchsorted(runs, values[at]), len(runs) - 1)
    return at[runs[spot] == values[at]]


def align(a: np.ndarray, b: np.ndarray, a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment (Smith-Waterman, linear gaps) of row i of ``a`` with row i of ``b``: score and the ends in a and b.

    All rows go through the table together, one word of ``a`` at a time; a gap along ``b`` is a running maximum.
    """
    n, w = b.shape
    column = np.arange(w, dtype=np.int32)
    inside = column < b_len[:, None]
    above = np.zeros((n, w + 1), np.int32)
    best, end_a, end_b = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(a.shape[1]):
        same = (a[:, i : i + 1] == b) & inside & (i < a_len)[:, None]
        row = np.maximum(above[:, :-1] + np.where(same, MATCH, MISMATCH), np.maximum(above[:, 1:] + GAP, 0)).astype(np.int32)
        row = np.maximum.accumulate(row - GAP * column, axis=1) + GAP * column
        above[:, 1:] = row
        top = row.max(1)
        better = top > best
        if better.any():
            end_b[better] = row[better].argmax(1)
            best[better], end_a[better] = top[better], i
    return best, end_a, end_b


def _matrix(words: np.ndarray, begin: np.ndarray, length: np.ndarray, reverse: bool = False) -> np.ndarray:
    width = int(length.max())
    at = begin[:, None] + (np.maximum(length - 1, 0)[:, None] - np.arange(width) if reverse else np.arange(width))
    return words[np.clip(at, 0, len(words) - 1)]


def _windows(items: Items, values: np.ndarray, at: np.ndarray, hit: np.ndarray) -> Iterator[np.ndarray]:
    """(text, item, step of the place where the item would begin) of the seeds of ``hit``, as many pairs at once as memory allows."""
    low, high = np.searchsorted(items.runs, values[hit], "left"), np.searchsorted(items.runs, values[hit], "right")
    ends = np.cumsum(high - low)
    first = 0
    while first < len(hit):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _PAIRS, side="right")))
        n = (high - low)[first:last]
        seed = np.repeat(low[first:last] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        place = np.repeat(hit[first:last], n)
        text = np.searchsorted(at, place, side="right") - 1
        item = items.owner[seed]
        length = np.diff(items.starts)[item]
        # Passages are windows around the place where the item would begin; seeds of one step share a window.
        step = np.maximum(1, np.maximum(4, length // 2) // 2)
        yield np.unique(np.stack([text, item, np.floor_divide((place - at[text]) - items.place[seed], step)], 1), axis=0)
        first = last


def _enough_words(items: Items, words: np.ndarray, item: np.ndarray, begin: np.ndarray, span: np.ndarray, need: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of the windows with at least ``need`` words that are in their item. A passage's score is at most that number of matches, so the
    others cannot reach the least score whatever their order."""
    kept, at_once = [np.zeros(0, np.int64)], 0
    ends = np.cumsum(span)
    while at_once < len(span):
        stop = max(at_once + 1, int(np.searchsorted(ends, (ends[at_once - 1] if at_once else 0) + _CELLS, side="right")))
        n = span[at_once:stop]
        from_ = np.cumsum(n) - n
        at = np.repeat(begin[at_once:stop] - from_, n) + np.arange(n.sum())
        shared = np.add.reduceat(known[_word_spots(np.repeat(item[at_once:stop], n), words[np.minimum(at, len(words) - 1)])], from_, dtype=np.int64)
        kept.append(at_once + np.flatnonzero(shared >= need[at_once:stop]))
        at_once = stop
    return np.concatenate(kept)


def matches(items: Items, texts: pa.Array, size: int, least: float, table: np.ndarray, known: np.ndarray | None = None) -> list[tuple[int, int, float, int, int]]:
    """(text, item, score, first word, word after the last) of the best passage of each text and item at or above ``least``."""
    words, starts = bare_words(texts)
    values, at = shingles(words, starts, size)
    hit = _seen(values, items.runs, table)
    known = items.word_table() if known is None and len(hit) else known
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for cells in _windows(items, values, at, hit):
        _align_cells(items, words, starts, cells, least, known, best)
    return [(*k, *v) for k, v in sorted(best.items())]


def _align_cells(items: Items, words: np.ndarray, starts: np.ndarray, cells: np.ndarray, least: float, known: np.ndarray, best: dict) -> None:
    text, item = cells[:, 0], cells[:, 1]
    length = np.diff(items.starts)[item]
    slack = np.maximum(4, length // 2)
    step = np.maximum(1, slack // 2)
    begin = np.maximum(cells[:, 2] * step - slack, 0)
    stop = np.minimum(cells[:, 2] * step + step + length + slack, np.diff(starts)[text])
    span = np.maximum(stop - begin, 1)
    chosen = _enough_words(items, words, item, starts[text] + begin, span, least * length - 1e-9, known)
    text, item, length, begin, span = text[chosen], item[chosen], length[chosen], begin[chosen], span[chosen]
    order = np.argsort(length, kind="stable")
    at_once = 0
    while at_once < len(order):
        n = max(1, min(len(order) - at_once, _CELLS // int(max(1, 3 * length[order[at_once : at_once + 1]].max()))))
        rows = order[at_once : at_once + n]
        n = max(1, min(n, _CELLS // int(span[rows].max())))
        rows, at_once = rows[:n], at_once + n
        a0, b0 = items.starts[item[rows]], starts[text[rows]] + begin[rows]
        score, end_a, end_b = align(_matrix(items.words, a0, length[rows]), _matrix(words, b0, span[rows]), length[rows], span[rows])
        good = np.flatnonzero(score >= least * MATCH * length[rows] - 1e-9)
        if not len(good):
            continue
        g = rows[good]
        # The passage's begin: the same alignment from its ends backwards.
        la, lb = end_a[good] + 1, end_b[good] + 1
        _, _, back = align(_matrix(items.words, a0[good], la, True), _matrix(words, b0[good], lb, True), la, lb)
        for r, s, e, f in zip(g, score[good], lb, lb - 1 - back, strict=True):
            key = int(text[r]), int(item[r])
            value = float(s / (MATCH * length[r])), int(begin[r] + f), int(begin[r] + e)
            if key not in best or (-value[0], *value[1:]) < (-best[key][0], *best[key][1:]):
                best[key] = value


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list, pa.Array]]:
    """The test items in blocks of about ``BLOCK_BYTES`` of text, so the driver and the executors hold one bounded block at a time."""
    items = benchmark.filter("text is not null").select("item_id", "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    for k in range(n):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").toArrow()
        if block.num_rows:
            yield block["item_id"].to_pylist(), block["text"].combine_chunks()


def _prepared(benchmark: DataFrame, size: int) -> Iterator[Items]:
    """Blocks of items with all their seeds."""
    for ids, texts in _blocks(benchmark):
        yield Items.of(ids, texts, size)


def _plain(fn):
    """Spark counts a function's parameters; the bound ones are hidden."""
    return lambda batches: fn(batches)


def find_leaks(docs: DataFrame, benchmark: DataFrame, score: float = SCORE, size: int = SEED_WORDS) -> DataFrame:
    """Passages of ``docs`` that copy a test item, also with edits: doc_id, item_id, score, word_from, word_to (the word after the last).

    The score is that of the best local alignment of words divided by that of an exact copy; one row per document row and item at or above
    ``score``. Words are lower-case without punctuation at their ends. Every passage that shares a run of
    ``size`` words with an item, however common, and enough single words to reach ``score`` is aligned. Items are taken in blocks of bounded size against all texts; texts are not shuffled. An item of fewer
    words than a run matches only a text of the same words. Null and empty texts and items match nothing, null ids are
    returned as they are, repeated rows are each searched, empty tables give an empty result, other columns are ignored.
    """
    rows = docs.select("doc_id", "text")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}, score double, word_from long, word_to long"
    out = rows.sparkSession.createDataFrame([], schema)
    for items in _prepared(benchmark, size):
        table = _filter_table(items.runs)

        def search(batches: Iterator[pa.RecordBatch], items: Items = items, table: np.ndarray = table) -> Iterator[pa.RecordBatch]:
            known = items.word_table()
            for batch in batches:
                for piece in slices(batch):
                    if found := matches(items, piece["text"], size, score, table, known):
                        text, item, share, a, b = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [piece["doc_id"].take(pa.array(text)), pa.array([items.ids[i] for i in item]), pa.array(share, pa.float64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                            names=["doc_id", "item_id", "score", "word_from", "word_to"],
                        )

        out = out.unionByName(rows.mapInArrow(_plain(search), schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, score: float = SCORE, size: int = SEED_WORDS) -> DataFrame:
    """The rows of ``docs`` without a passage that ``find_leaks`` would report.

    All columns stay as they are, whatever their names. Null and empty texts hold no passage and stay; a null id is no reason to go; each of several equal
    rows is judged alike; texts of any length are searched whole; without items, or with null or empty ones only, all rows stay; an empty table gives an empty one.
    """
    for items in _prepared(benchmark, size):
        table = _filter_table(items.runs)

        def clean(batches: Iterator[pa.RecordBatch], items: Items = items, table: np.ndarray = table) -> Iterator[pa.RecordBatch]:
            known = items.word_table()
            for batch in batches:
                for piece in slices(batch):
                    bad = {t for t, *_ in matches(items, piece["text"], size, score, table, known)}
                    yield piece.filter(pa.array([i not in bad for i in range(piece.num_rows)]))

        docs = docs.mapInArrow(_plain(clean), docs.schema)
    return docs
