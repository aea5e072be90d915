"""Language-model scores by a probabilistic suffix tree over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from herdframe.llm.words import list_column, mix, slices, split_words, word_codes
from herdframe.session import RELEASED_SHUFFLES, cut_lineage, drop_stages, set_for

LEAST = 2
_END = np.uint64(0xE17D5A1B9C3F0E27)
_BLOCK_TOKENS = 1 << 18
_SLICE_BYTES = 3 << 19
_FILTER_BITS = 28
_BIN_TOKENS = 3 << 18  # so many of the tokens fall to a bin at most, whatever the corpus
_ASKED_PARTS = 2  # parts of the blocks that look runs up one after the other
#: A row of lists has a whole block or bin: what a task reads, and batches between Spark and Python, are bounded by bytes, and those of the reader hold few rows.
_SMALL_TASKS = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.parquet.columnarReaderBatchSize": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}
_TAIL_ROWS = 4 << 20  # counts that one task takes to test contexts of many lengths
_TAIL_LENGTHS = 32
Filter = np.ndarray | Broadcast


@dataclass
class Level:
    """Contexts of one length and their next words. ``keys``: context << 32 | word, sorted; ``counts``: how often the word follows.

    ``kept`` marks the contexts that pass the divergence test; ``parent`` is the number of a context's suffix among those one shorter;
    ``mass`` over ``total`` is what a context leaves to its suffix.
    """

    parent: np.ndarray
    n: np.ndarray
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    kept: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    mass: np.ndarray = field(default_factory=lambda: np.zeros(0))
    total: np.ndarray = field(default_factory=lambda: np.zeros(0))


@dataclass
class Tree:
    """A gathered tree: all training words (sorted hashes, counts) and the kept contexts of each length."""

    hashes: np.ndarray
    counts: np.ndarray
    tokens: int
    kinds: int
    levels: list[Level] = field(default_factory=list)

    @property
    def spread(self) -> int:
        return self.tokens + self.kinds + 1


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value among the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token codes of the texts (words in ASCII lower case, then one end each), the hash of each code, and where texts begin."""
    flat, starts = split_words(pc.ascii_lower(pc.fill_null(texts, "")), lower=False)
    codes, hashes, _ = word_codes(flat)
    n = len(starts) - 1
    out = np.full(len(codes) + n, len(hashes), np.int64)
    out[np.arange(len(codes)) + np.repeat(np.arange(n), np.diff(starts))] = codes
    return out, np.append(hashes, _END), starts + np.arange(n + 1)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 7, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _join_keys(context: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Key of a run of words, from that of the run without its last word and that of the run without its first word."""
    return mix(context * np.uint64(0x9E3779B97F4A7C15) + mix(below))


def _passes(held: Filter, contexts: np.ndarray) -> np.ndarray:
    """Which contexts may be in the set that a filter was made of; all of the set are."""
    held = held if isinstance(held, np.ndarray) else held.value
    bits = int(len(held) * 64).bit_length() - 1
    at = contexts >> np.uint64(64 - bits)
    return (held[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _bits(n: int) -> int:
    """Bits of the filter's addresses: 8 places a key or more, never more than 2 ** ``_FILTER_BITS``; a fuller filter only lets more pass."""
    return min(_FILTER_BITS, max(10, (8 * n).bit_length()))


def _sent(spark: SparkSession, held: np.ndarray) -> Filter:
    """A large filter is sent to each executor once; a small one travels with the tasks."""
    return held if held.nbytes < 1 << 16 else spark.sparkContext.broadcast(held)


def _filter_of(keys: DataFrame, n: int) -> Filter:
    """Bits in use by the hashes of a table of n rows with the one column ``key``."""
    bits = _bits(n)
    at = F.shiftrightunsigned("key", 64 - bits)
    words = keys.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) & 63 as int))")).alias("bits")).toArrow()
    held = np.zeros(1 << (bits - 6), np.uint64)
    held[words["at"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return _sent(keys.sparkSession, held)


def _filter_from(spark: SparkSession, keys: np.ndarray) -> Filter:
    """The same from an array."""
    bits = _bits(len(keys))
    held = np.zeros(1 << (bits - 6), np.uint64)
    at = keys >> np.uint64(64 - bits)
    np.bitwise_or.at(held, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return _sent(spark, held)


def _blocks(rows: DataFrame) -> DataFrame:
    """The tokens of whole texts in rows of about ``_BLOCK_TOKENS``: word hashes, codes into them, and the texts' ids, sizes and ``held_out``."""
    id_type = rows.schema["doc_id"].dataType

    def merged(block: int, parts: list[tuple]) -> pa.RecordBatch:
        ids, held, sizes, codes, hashes = zip(*parts, strict=True)
        before = np.cumsum([0, *map(len, hashes)])
        distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
        codes = np.concatenate([place[a + c] for a, c in zip(before, codes, strict=False)])
        ids, held = (pa.concat_arrays(x) for x in (ids, held))
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, held, pa.array(np.concatenate(sizes), pa.int32()), pa.array(distinct.view(np.int64)), pa.array(codes, pa.int32()))]
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *lists], names=["block", "doc_ids", "held_out", "sizes", "hashes", "codes"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        parts, size = [], 0
        for batch in batches:
            for piece in slices(batch, limit=_SLICE_BYTES):
                codes, hashes, starts = tokens(piece["text"])
                parts.append((piece["doc_id"], piece["held_out"], np.diff(starts), codes, hashes))
                size += len(codes)
                if size >= _BLOCK_TOKENS:
                    yield merged(block, parts)
                    block, parts, size = block + 1, [], 0
        if size:
            yield merged(block, parts)

    schema = f"block long, doc_ids array<{id_type.simpleString()}>, held_out array<boolean>, sizes array<int>, hashes array<long>, codes array<int>"
    return rows.select("doc_id", "text", "held_out").mapInArrow(pack, schema)


def _unpacked(batch: pa.RecordBatch | pa.Table) -> Iterator[dict[str, np.ndarray]]:
    """The arrays of each block."""
    for i in range(batch.num_rows):
        out = {c: batch[c][i].values.to_numpy(zero_copy_only=False) for c in ("held_out", "sizes", "hashes", "codes") if c in batch.schema.names}
        yield out | {"hashes": out["hashes"].view(np.uint64)}


class _Runs:
    """Keys of all runs of one length, by the token they end in. Runs do not cross texts."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.length, self.key, self.shorter = 1, words, words
        kind = np.int32 if len(words) < 1 << 31 else np.int64
        self.origin = np.arange(len(words), dtype=kind)
        self.text = np.repeat(np.arange(len(sizes), dtype=kind), sizes)
        self.depth = self.origin - np.repeat((np.cumsum(sizes) - sizes).astype(kind), sizes)
        self.alive = np.ones(len(words), bool)

    def longer(self) -> None:
        """Go on to runs of one word more, in the texts that have a token alive."""
        live = np.zeros(self.text[-1] + 1 if len(self.text) else 0, bool)
        live[self.text[self.alive]] = True
        some = live[self.text]
        if 2 * np.count_nonzero(some) < len(some):
            self.key, self.text, self.depth, self.origin, self.alive = (x[some] for x in (self.key, self.text, self.depth, self.origin, self.alive))
        at = np.flatnonzero(self.depth >= self.length)
        key = np.zeros(len(self.key), np.uint64)
        key[at] = _join_keys(self.key[at - 1], self.key[at])
        self.shorter, self.key, self.length = self.key, key, self.length + 1

    def keep(self, places: np.ndarray) -> None:
        self.alive = np.zeros(len(self.alive), bool)
        self.alive[places] = True


def _after_contexts(words: np.ndarray, sizes: np.ndarray, filters: list[Filter], upto: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of context from ``len(filters)`` to ``upto``, the tokens whose context passes, with all its suffixes that have a filter: length, place,
    the context's key and that of the run that is one word shorter."""
    runs = _Runs(words, sizes)
    for k in range(1, upto + 1):
        place = np.flatnonzero(runs.alive & (runs.depth >= k))
        if k <= len(filters):
            place = place[_passes(filters[k - 1], runs.key[place - 1])]
        if not len(place):
            return
        if k >= len(filters):
            yield k, runs.origin[place], runs.key[place - 1], runs.key[place]
        runs.keep(place)
        if k < upto:
            runs.longer()


def _lists(bins: np.ndarray, columns: dict[str, np.ndarray], constant: dict[str, int]) -> pa.RecordBatch:
    """One row for each bin, in whose order the columns are: bin, the constants and the columns' parts as lists."""
    cuts = np.flatnonzero(np.append(True, bins[1:] != bins[:-1])) if len(bins) else np.zeros(0, np.int64)
    starts = np.append(cuts, len(bins))
    out = {"bin": pa.array(bins[cuts], pa.int32())} | {c: pa.array(np.full(len(cuts), x)) for c, x in constant.items()}
    columns = {c: x.view(np.int64) if x.dtype == np.uint64 else x for c, x in columns.items()}
    return pa.RecordBatch.from_pydict(out | {c: list_column(x, starts, pa.from_numpy_dtype(x.dtype)) for c, x in columns.items()})


def _row(bin: int, **columns: np.ndarray) -> pa.Table:
    """One row of lists, or none if they are empty."""
    return pa.Table.from_batches([_lists(np.full(len(next(iter(columns.values()))), bin), columns, {})])


def _by_key(table: pa.Table, *columns: str) -> list[np.ndarray]:
    """The lists ``key`` and ``columns`` of all rows, by rising key."""
    key = _flat(table, "key").view(np.uint64)
    order = np.argsort(key)
    return [key[order], *(_flat(table, c)[order] for c in columns)]


def _bin_of(keys: np.ndarray, bins: int) -> np.ndarray:
    """Bins of equal parts of all hashes; they rise with the hash."""
    return ((keys >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)


def _summed(context: np.ndarray, below: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, by rising key: key, context, below, and their number (or sum of n)."""
    key = _join_keys(context, below)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    summed = np.diff(np.append(first, len(key))) if n is None else np.add.reduceat(n[order].astype(np.int64), first) if len(key) else np.zeros(0, np.int64)
    return key[first], context[order[first]], below[order[first]], summed


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table[column].combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _count_lists(blocks: DataFrame, filters: list[Filter], upto: int, bins: int, only: range | None = None) -> DataFrame:
    """How often each context that passes is followed by a word in the training texts of a block: bin, length, and lists ctx, below, n, of all bins or some. With
    one bin for all if ``bins`` is 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _unpacked(batch):
                train = ~np.repeat(b["held_out"], b["sizes"])
                words, sizes = b["hashes"][b["codes"][train]], b["sizes"][~b["held_out"]]
                for length, _, context, below in _after_contexts(words, sizes, filters, upto):
                    if only is not None:
                        at = _bin_of(_join_keys(context, below), bins)
                        own = (at >= only.start) & (at < only.stop)
                        context, below = context[own], below[own]
                    key, context, below, n = _summed(context, below)
                    at = _bin_of(key, bins)
                    order = np.argsort(at.astype(np.uint64) << np.uint64(46) | context >> np.uint64(18))  # equal contexts side by side take less room
                    yield _lists(at, {"ctx": context[order], "below": below[order], "n": n[order].astype(np.int32)}, {"length": length})

    return blocks.select("held_out", "sizes", "hashes", "codes").mapInArrow(count, "bin int, length long, ctx array<long>, below array<long>, n array<int>")


def _counts(blocks: DataFrame, filters: list[Filter], bins: int, only: range) -> DataFrame:
    """Runs of a context that passes and its next word that occur ``LEAST`` times in training: lists key, ctx, below, n by bins of the key. Single runs travel in
    lists, and go no further."""

    def add(table: pa.Table) -> pa.Table:
        key, context, below, n = _summed(_flat(table, "ctx").view(np.uint64), _flat(table, "below").view(np.uint64), _flat(table, "n"))
        often = n >= LEAST
        return _row(table["bin"][0].as_py(), key=key[often], ctx=context[often], below=below[often], n=n[often])

    return _count_lists(blocks, filters, len(filters), bins, only).groupBy("bin").applyInArrow(add, "bin int, key array<long>, ctx array<long>, below array<long>, n array<long>")


def _with_p(counted: DataFrame, before: DataFrame, bins: int, also: list[str]) -> DataFrame:
    """``counted`` of contexts whose suffix is kept, with the word's probability after that: each bin asks the bins of its suffix runs in ``before``."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                below = np.unique(b["below"][i].values.to_numpy().view(np.uint64))
                yield _lists(_bin_of(below, bins), {"key": below}, {"home": np.int32(b["bin"][i].as_py())})

    def answer(asked: pa.Table, given: pa.Table) -> pa.Table:
        known, p = _by_key(given, "p")
        place, lists = _find(known, _flat(asked, "key").view(np.uint64)), asked["key"].combine_chunks()
        starts = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
        return pa.table({"home": asked["home"], "bin": asked["bin"], "p": list_column(np.append(p, 0.0)[place], starts, pa.float64())})

    def add(counted: pa.Table, answers: pa.Table) -> pa.Table:
        key, ctx, below, n = (_flat(counted, c) for c in ("key", "ctx", "below", "n"))
        p = _flat(answers.sort_by("bin"), "p")[np.unique(below.view(np.uint64), return_inverse=True)[1]]
        kept = p > 0
        more = {c: x[kept] for c, x in (("below", below),) if c in also}
        return _row(counted["bin"][0].as_py() if counted.num_rows else 0, key=key[kept], ctx=ctx[kept], n=n[kept], p=p[kept], **more)

    asked = counted.select("bin", "below").mapInArrow(ask, "bin int, home int, key array<long>")
    answers = asked.groupBy("bin").cogroup(before.select("bin", "key", "p").groupBy("bin")).applyInArrow(answer, "home int, bin int, p array<double>")
    schema = ", ".join(["bin int, key array<long>, ctx array<long>, n array<long>, p array<double>", *(f"{c} array<long>" for c in also if c == "below")])
    return counted.groupBy("bin").cogroup(answers.groupBy("home")).applyInArrow(add, schema)


def _kept(occurs: np.ndarray, known: np.ndarray, entries: np.ndarray, q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which contexts to keep, with total and mass: those whose next words differ from those after their suffix. The bits saved, occurrences times
    divergence, must exceed the bits needed to write the context's entries down. What has no entry is known from the occurrences of the context.

    Smoothing is Witten-Bell's: a context leaves one part for each distinct next word, and all that has no entry, to its suffix."""
    rest = occurs - known
    with np.errstate(divide="ignore", invalid="ignore"):  # of contexts that are none
        saved = x - known * np.log2(occurs) + rest * np.log2(np.maximum(rest, 1) / occurs / np.maximum(1 - q, 1e-12))
        spare = entries + rest + np.maximum(rest, 1)
        return (entries > 0) & (saved > 8 + 0.5 * np.log2(occurs + 1) * entries), occurs + spare, (rest + spare) / (occurs + spare)


def _sums(contexts: np.ndarray, at: np.ndarray, n: np.ndarray, p: np.ndarray) -> list[np.ndarray]:
    """Of the entries of each context: occurrences, number, probability after the suffix, and what they save."""
    return [np.bincount(at, x, len(contexts)) for x in (n, np.ones(len(n)), p, n * np.log2(n / p))]


def _test(entries: DataFrame, before: DataFrame, bins: int) -> DataFrame:
    """Tests the contexts of ``entries``: a bin's sums go to the bins of the contexts, where ``before`` has their occurrences. Rows of kind 0 answer a bin, context by context: total and mass (total 0: not
    kept, -1: no candidate); those of kind 1 have the kept contexts, their occurrences, total and mass."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ctx, n, p = (b[c][i].values.to_numpy() for c in ("ctx", "n", "p"))
                contexts, at = np.unique(ctx.view(np.uint64), return_inverse=True)
                columns = dict(zip(("known", "entries", "q", "x"), _sums(contexts, at, n, p), strict=True))
                yield _lists(_bin_of(contexts, bins), {"key": contexts} | columns, {"home": np.int32(b["bin"][i].as_py())})

    def test(asked: pa.Table, given: pa.Table) -> pa.Table:
        contexts, at = np.unique(_flat(asked, "key").view(np.uint64), return_inverse=True)
        known, n = _by_key(given, "n")
        place = _find(known, contexts)
        occurs = np.append(n, 0)[place]
        kept, total, mass = _kept(occurs, *(np.bincount(at, _flat(asked, c), len(contexts)) for c in ("known", "entries", "q", "x")))
        kept &= place >= 0
        said = np.where(kept, total, np.where(place >= 0, 0.0, -1.0))
        starts = np.append(0, np.cumsum(asked["key"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)))
        none = pa.array([[]] * asked.num_rows, pa.list_(pa.int64()))
        out = {"kind": np.zeros(asked.num_rows, np.int32), "home": asked["home"], "bin": asked["bin"], "key": none, "n": none}
        out = pa.table(out | {"total": list_column(said[at], starts, pa.float64()), "mass": list_column(mass[at].astype(float), starts, pa.float64())})
        own = _row(asked["bin"][0].as_py() if asked.num_rows else 0, key=contexts[kept], n=occurs[kept].astype(np.int64), total=total[kept].astype(float), mass=mass[kept].astype(float))
        return pa.concat_tables([out, own.append_column("kind", pa.array([1] * own.num_rows, pa.int32())).append_column("home", pa.array([-1] * own.num_rows, pa.int32())).select(out.column_names)])

    asked = entries.select("bin", "ctx", "n", "p").mapInArrow(ask, "bin int, home int, key array<long>, known array<double>, entries array<double>, q array<double>, x array<double>")
    return asked.groupBy("bin").cogroup(before.select("bin", "key", "n").groupBy("bin")).applyInArrow(
        test, "kind int, home int, bin int, key array<long>, n array<long>, total array<double>, mass array<double>"
    )


def _after(entries: DataFrame, tested: DataFrame, also: list[str]) -> DataFrame:
    """The entries of candidates, with their probability p after the context (0 if that is not kept) and value v."""

    def add(entries: pa.Table, tested: pa.Table) -> pa.Table:
        key, ctx, n, p = (_flat(entries, c) for c in ("key", "ctx", "n", "p"))
        at, tested = np.unique(ctx.view(np.uint64), return_inverse=True)[1], tested.sort_by("bin")
        total, mass = (_flat(tested, c)[at] for c in ("total", "mass"))
        with np.errstate(divide="ignore", invalid="ignore"):
            after = np.where(total > 0, n / total + mass * p, 0.0)
            v = np.where(total > 0, np.log10(after / (mass * p)), 0.0)
        own = total >= 0
        more = {c: _flat(entries, c)[own] for c in also}
        return _row(entries["bin"][0].as_py() if entries.num_rows else 0, key=key[own], n=n[own], p=after[own], v=v[own], **more)

    schema = ", ".join(["bin int, key array<long>, n array<long>, p array<double>, v array<double>", *(f"{c} array<long>" for c in also)])
    return entries.groupBy("bin").cogroup(tested.filter("kind = 0").groupBy("home")).applyInArrow(add, schema)


def _texts_with(blocks: DataFrame, filters: list[Filter]) -> DataFrame:
    """The training texts that have a context which passes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _unpacked(batch):
                train = ~np.repeat(b["held_out"], b["sizes"])
                codes, sizes = b["codes"][train], b["sizes"][~b["held_out"]]
                text = np.repeat(np.arange(len(sizes)), sizes)
                live = np.zeros(len(sizes), bool)
                for _, place, _, _ in _after_contexts(b["hashes"][codes], sizes, filters, len(filters)):
                    live[text[place]] = True
                used, codes = np.unique(codes[live[text]], return_inverse=True)
                columns = {"held_out": np.zeros(live.sum(), bool), "sizes": sizes[live], "hashes": b["hashes"][used].view(np.int64), "codes": codes.astype(np.int32)}
                if live.any():
                    yield pa.RecordBatch.from_pydict({c: list_column(x, np.array([0, len(x)]), pa.from_numpy_dtype(x.dtype)) for c, x in columns.items()})

    return blocks.select("held_out", "sizes", "hashes", "codes").mapInArrow(cut, "held_out array<boolean>, sizes array<int>, hashes array<long>, codes array<int>")


_TAIL = "kind int, length int, ctx long, below long, key long, n long, p double, total double, mass double, v double"


def _tail(counts: DataFrame, before: DataFrame, length: int, upto: int) -> DataFrame:
    """Tests contexts from ``length`` to ``upto`` words, of which there are few, in one task. ``before``: key and p of the candidates, p 0 after a context that is not kept.

    Rows of kind 0 are entries of kept contexts, of kind 1 kept contexts, of kind 2 all entries of the last length."""

    def test(counts: pa.Table, given: pa.Table) -> pa.Table:
        contexts, p_known = given["key"].to_numpy().view(np.uint64), given["p"].to_numpy()
        order = np.argsort(contexts)
        contexts, p_known = contexts[order], p_known[order]
        known, p_known = contexts[p_known > 0], p_known[p_known > 0]
        lengths = np.repeat(counts["length"].to_numpy(), counts["n"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False))
        flat = [_flat(counts, c) for c in ("ctx", "below", "n")]
        by = np.argsort(lengths, kind="stable")
        ends, out = np.searchsorted(lengths[by], np.arange(length, upto + 2)), []

        def put(kind: int, length: int, **columns: np.ndarray) -> None:
            rows = len(next(iter(columns.values())))
            columns |= {"kind": np.full(rows, kind), "length": np.full(rows, length)}
            types = {"int": np.int32, "long": np.int64, "double": np.float64}
            out.append(pa.table({c: columns.get(c, np.zeros(rows, np.int64)).astype(types[t]) for c, t in map(str.split, _TAIL.split(", "))}))

        for k, a, b in zip(range(length, upto + 1), ends, ends[1:], strict=False):
            context, below, n = (x[by[a:b]] for x in flat)
            key, context, below, n = _summed(context.view(np.uint64), below.view(np.uint64), n)
            at = _find(known, below)
            own = (_find(contexts, context) >= 0) & ((at >= 0) | (n < LEAST))
            key, context, below, n, at = (x[own] for x in (key, context, below, n, at))
            p = np.append(p_known, 1.0)[at]  # single runs are not looked at
            states, of = np.unique(context, return_inverse=True)
            often, occurs = n >= LEAST, np.bincount(of, n, len(states))
            kept, total, mass = _kept(occurs, *_sums(states, of[often], n[often], p[often]))
            after = np.where(kept[of], n / total[of] + mass[of] * p, 0.0)
            entry = often & kept[of]
            put(0, k, ctx=context[entry], below=below[entry], key=key[entry], n=n[entry], v=np.log10(after / (mass[of] * p))[entry])
            states, total, mass, occurs = (x[kept] for x in (states, total, mass, occurs))
            put(1, k, ctx=states, key=states, n=occurs, total=total, mass=mass, v=np.log10(mass))
            if k == upto:
                put(2, k, key=key[often], n=n[often], p=after[often])
            contexts, known, p_known = key[often & (_find(states, below) >= 0)], key[entry], after[entry]
        return pa.concat_tables(out)

    first = counts.filter(F.col("length") == length).select(F.explode(F.concat("ctx", "below")).alias("key")).distinct()
    given = before.join(first, "key", "left_semi").selectExpr("0 as bin", "key", "p")
    return counts.groupBy("bin").cogroup(given.groupBy("bin")).applyInArrow(test, _TAIL)


def _wanted(b: dict[str, np.ndarray], ways: list[tuple], lengths: range) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys to look up for a block, sorted: those of its runs of these lengths that pass; and, for each occurrence, its place among the keys and its token."""
    words = b["hashes"][b["codes"]]
    if lengths == range(1, 2):
        return b["hashes"], b["codes"], np.arange(len(words))
    runs, keys, places = _Runs(words, b["sizes"]), [words[:0]], [b["codes"][:0]]
    for length in range(1, lengths.stop):
        place = np.flatnonzero(runs.alive & (runs.depth >= length - 1))
        if length > 1:
            held, states = ways[length - 2]
            place = place[_passes(held, runs.key[place])]
            if states is not None:  # its context or that of one word less is kept
                place = place[_passes(states, runs.shorter[place - 1]) | _passes(states, runs.shorter[place])]
        if not len(place):
            break
        if length in lengths:
            keys.append(runs.key[place])
            places.append(runs.origin[place])
        runs.keep(place)
        if length + 1 < lengths.stop:
            runs.longer()
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, at, np.concatenate(places)


def _looked_up(blocks: DataFrame, known: DataFrame, ways: list[tuple], lengths: range, part: int, bins: int) -> DataFrame:
    """For each block, by bins of its sorted keys, the sums of the keys' values."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, b in zip(batch["block"].to_pylist(), _unpacked(batch), strict=True):
                keys, _, _ = _wanted(b, ways, lengths)
                yield _lists(_bin_of(keys, bins), {"key": keys}, {"block": block})

    def answer(asked: pa.Table, given: pa.Table) -> pa.Table:
        keys, at = np.unique(_flat(given, "key").view(np.uint64), return_inverse=True)
        v = np.append(np.bincount(at, _flat(given, "v"), len(keys)).astype(float), 0.0)
        starts = np.append(0, np.cumsum(asked["key"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)))
        v = v[_find(keys, _flat(asked, "key").view(np.uint64))]
        return pa.table({"block": asked["block"], "part": np.full(asked.num_rows, part, np.int32), "bin": asked["bin"], "v": list_column(v, starts, pa.float64())})

    asked = blocks.select("block", "sizes", "hashes", "codes").mapInArrow(ask, "bin int, block long, key array<long>")
    return asked.groupBy("bin").cogroup(known.groupBy("bin")).applyInArrow(answer, "block long, part int, bin int, v array<double>")


def _part_of(blocks: DataFrame, part: int) -> DataFrame:
    """One of ``_ASKED_PARTS`` parts of the blocks."""
    return blocks.filter(F.pmod(F.xxhash64("block"), F.lit(_ASKED_PARTS)) == part)


def _added(blocks: DataFrame, answers: DataFrame, ways: list[tuple], parts: dict[int, range]) -> DataFrame:
    """The sums of the answered values over each text, and over its words how many have one."""

    def add(block: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for b in _unpacked(block):
            text = np.repeat(np.arange(len(b["sizes"])), b["sizes"])
            for part, lengths in parts.items():
                _, at, place = _wanted(b, ways, lengths)
                v = _flat(answers.filter(pc.equal(answers["part"], part)).sort_by("bin"), "v")
                v = v[at] if len(at) else np.zeros(0)
                sums, known = (np.bincount(text[place], x, len(b["sizes"])).astype(float) for x in (v, v > 0))
                out.append(_row(0, v=sums, known=known.astype(np.int64)).append_column("block", block["block"]).append_column("part", pa.array([part], pa.int32())))
        return pa.concat_tables(out).select(["block", "part", "v", "known"]) if out else pa.table({c: pa.array([], t) for c, t in kinds.items()})

    kinds = {"block": pa.int64(), "part": pa.int32(), "v": pa.list_(pa.float64()), "known": pa.list_(pa.int64())}
    return blocks.select("block", "sizes", "hashes", "codes").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add, "block long, part int, v array<double>, known array<long>")


@dataclass
class Grown:
    """A tree's words (lists key, n by bins), and the sums of the texts: of part 0 over log10(n + 1) of words, of the others over the values of runs. ``entries`` and ``states``: of kept contexts
    by length, if asked for."""

    tokens: int
    kinds: int
    words: DataFrame
    sums: list[DataFrame] = field(default_factory=list)
    entries: list[DataFrame] = field(default_factory=list)
    states: list[DataFrame] = field(default_factory=list)


def _words(blocks: DataFrame, bins: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _unpacked(batch):
                n = np.bincount(b["codes"][~np.repeat(b["held_out"], b["sizes"])], minlength=len(b["hashes"]))
                key = b["hashes"][n > 0]
                yield _lists(_bin_of(key, bins), {"key": key, "n": n[n > 0]}, {})

    def add(table: pa.Table) -> pa.Table:
        key, at = np.unique(_flat(table, "key").view(np.uint64), return_inverse=True)
        return _row(table["bin"][0].as_py(), key=key, n=np.bincount(at, _flat(table, "n"), len(key)).astype(np.int64))

    schema = "bin int, key array<long>, n array<long>"
    return blocks.select("held_out", "sizes", "hashes", "codes").mapInArrow(count, schema).groupBy("bin").applyInArrow(add, schema)


def _total(column: str) -> Column:
    return F.coalesce(F.sum(F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))


def _shares(blocks: DataFrame) -> dict[str, str]:
    """As many shuffle partitions as keep a partition's two bins small: what a task holds does not grow with the corpus."""
    tokens = blocks.agg(_total("sizes")).first()[0]
    return {"spark.sql.shuffle.partitions": str(max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tokens // (2 * _BIN_TOKENS))))}


def grow(blocks: DataFrame, details: bool = False) -> Grown:
    """Count and keep contexts one word longer at a time, until none is kept; when few candidates are left, many lengths at a time in one task. Runs are looked up as
    soon as their values are known.

    A context and an entry need ``LEAST`` occurrences, whatever the corpus. Counts, states and values are tables of lists by bins of the runs' hashes, so that a key, however frequent, is in a bin once for
    each block or bin that asks; what every task holds is a filter of each length's contexts, of bounded size, that only spares keys that cannot be kept. A table goes as soon as nothing needs it.

    The probability of a word after a context with an entry is that after its suffix, times the context's mass and the entry's factor; without one, times the mass alone. As a
    text goes on after every context it holds, its score is the sum of the values (logarithms of masses and factors) of all its runs.
    """
    spark = blocks.sparkSession
    bins = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    also = ["ctx", "below"] if details else []
    words = cut_lineage(_words(blocks, bins))
    sums = words.agg(_total("n"), F.coalesce(F.sum(F.size("n")), F.lit(0))).first()
    out = Grown(int(sums[0]), int(sums[1]), words)
    spread = float(out.tokens + out.kinds + 1)

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                key, n = (b[c][i].values.to_numpy() for c in ("key", "n"))
                key, n = key[n >= LEAST], n[n >= LEAST]
                yield from _row(b["bin"][i].as_py(), key=key, n=n, p=(n + 1) / spread).to_batches()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, v = b["key"].to_numpy().view(np.uint64), b["v"].to_numpy()
            order = np.argsort(key)
            yield _lists(_bin_of(key[order], bins), {"key": key[order], "v": v[order]}, {})

    ways, asked, answers = [], {}, [[] for _ in range(_ASKED_PARTS)]

    def add_up(k: int) -> None:
        given = answers[k][0]
        for x in answers[k][1:]:
            given = given.unionByName(x)
        out.sums.append(cut_lineage(_added(_part_of(blocks, k), given, ways, asked)))
        drop_stages(*answers[k])
        answers[k].clear()

    def look_up(known: DataFrame, lengths: range) -> None:
        """One part of the blocks after the other, so that only its keys and answers are on disk. The words' answers are added with those of the first length, as the
        blocks move each time."""
        part = len(out.sums) * 10 + len(asked)
        asked[part] = lengths
        wait = lengths.stop == 2 and part == 0
        for k, given in enumerate(answers):
            given.append(cut_lineage(_looked_up(_part_of(blocks, k), known, ways, lengths, part, bins)))
            if not wait:
                add_up(k)
        if not wait:
            asked.clear()

    if not details:
        look_up(words.select("bin", "key", F.transform("n", lambda x: F.log10(x + 1)).alias("v")), range(1, 2))
    before, most = words.mapInArrow(often, "bin int, key array<long>, n array<long>, p array<double>"), out.tokens
    contexts, length, old = [], 1, [words]  # contexts: filters of the kept ones
    while most:
        keys = before.select(F.explode("key").alias("key"))
        n, occurs = before.agg(F.coalesce(F.sum(F.size("key")), F.lit(0)), _total("n")).first()
        most = min(most, occurs)
        tried = _filter_of(keys, n)
        if length > 1:
            ways.append((tried, contexts[-1]))
        if not most or most * 8 <= _TAIL_ROWS:
            break
        # one part of the bins after the other: no more than that of the single runs is on disk at a time
        counted = [cut_lineage(_counts(blocks, [*contexts, tried], bins, only)) for only in (range(bins // 2), range(bins // 2, bins))]
        entries = cut_lineage(_with_p(counted[0].unionByName(counted[1]), before, bins, also))
        drop_stages(*counted)
        tested = cut_lineage(_test(entries, before, bins))
        full = cut_lineage(_after(entries, tested, also))
        drop_stages(entries)
        states = tested.filter("kind = 1")
        n, most = states.agg(F.coalesce(F.sum(F.size("key")), F.lit(0)), _total("n")).first()
        contexts.append(_filter_of(states.select(F.explode("key").alias("key")), n))
        if details:
            out.entries.append(full.select(F.inline(F.arrays_zip("ctx", "below", "key", "n", "p"))).filter("p > 0"))
            out.states.append(states.select(F.inline(F.arrays_zip(F.col("key").alias("ctx"), "total", "mass"))))
        else:
            known = states.select("bin", "key", F.transform("mass", F.log10).alias("v"))
            look_up(known.unionByName(before.select("bin", "key", "v")) if length > 1 else known, range(length, length + 1))
            drop_stages(*old, tested)
        before, length, old = full, length + 1, [full]
    known = [before.select("bin", "key", "v")] if most and length > 1 else []
    first, lengths, runs = length, _TAIL_LENGTHS, {}
    if most:
        live = cut_lineage(_texts_with(blocks, [*contexts, tried]))
        before = before.select(F.inline(F.arrays_zip("key", "p")))
    while most:
        upto = length + max(1, min(_TAIL_ROWS // most, lengths)) - 1
        counts = cut_lineage(_count_lists(live, [*contexts, tried], upto, 1))
        done = cut_lineage(_tail(counts, before, length, upto))
        drop_stages(counts)
        found = done.filter("kind < 2").select("kind", "length", "key", "n").toArrow()
        kind, at, key, n = (found[c].to_numpy() for c in ("kind", "length", "key", "n"))
        key, is_state = key.view(np.uint64), kind == 1
        for k in range(length, upto + 1):
            own = key[is_state & (at == k)]
            contexts.append(_filter_from(spark, own))
            runs.setdefault(k, []).append(own)
            runs.setdefault(k + 1, []).append(key[~is_state & (at == k)])
        known.append(done.filter("kind < 2").select("key", "v").mapInArrow(listed, "bin int, key array<long>, v array<double>"))
        if details:
            out.entries += [done.filter(f"kind = 0 and length = {k}") for k in range(length, upto + 1)]
            out.states += [done.filter(f"kind = 1 and length = {k}") for k in range(length, upto + 1)]
        old.append(done)
        last = done.filter("kind = 2")
        most = min(int(n[is_state & (at == upto)].sum()), last.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        before, length, lengths = last.select("key", "p"), upto + 1, 2 * lengths
        tried = _filter_from(spark, last.select("key").toArrow()["key"].to_numpy().view(np.uint64))
    ways += [(_filter_from(spark, np.concatenate(x)), None) for k, x in sorted(runs.items()) if k > max(first, 1)]
    if known and not details:
        table = known[0]
        for x in known[1:]:
            table = table.unionByName(x)
        look_up(table, range(first, max([first, *runs]) + 1))
    for k, given in enumerate(answers):
        if given:
            add_up(k)
    if not details:
        drop_stages(*old)
    return out


def _step(level: Level, state: np.ndarray, entry: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probability of a word after a state, given its entry there and its probability after the state's suffix; unchanged where there is no
    kept state."""
    out = below.copy()
    ok = np.flatnonzero(state >= 0)
    ok = ok[level.kept[state[ok]]]
    s, e = state[ok], entry[ok]
    seen = np.where(e >= 0, level.counts[e], 0) if len(level.counts) else 0
    out[ok] = seen / level.total[s] + level.mass[s] * below[ok]
    return out


def learn(docs: DataFrame) -> tuple[Tree, DataFrame]:
    """The tree of ``grow`` gathered into memory, to look at small ones, and the counts (key, n) of all training words. Scoring does not use it."""
    blocks = cut_lineage(_blocks(docs))
    grown = grow(blocks, details=True)
    words = grown.words.select(F.inline(F.arrays_zip("key", "n")))
    table = words.toArrow()
    hashes, counts = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(hashes)
    tree = Tree(hashes[order].copy(), counts[order].copy(), grown.tokens, grown.kinds)
    word_of, numbers = {int(h): i for i, h in enumerate(tree.hashes.view(np.int64))}, {}
    runs, suffix = [_Runs(b["hashes"][b["codes"]], b["sizes"]) for b in _unpacked(blocks.toArrow())], {}
    for entries, states in zip(grown.entries, grown.states, strict=True):
        rows, kept = entries.collect(), states.orderBy("ctx").collect()
        if not kept:
            break
        number = {r.ctx: i for i, r in enumerate(kept)}
        word_of = {r.key: word_of[r.below] for r in rows}
        own = sorted(((number[r.ctx] << 32) | word_of[r.key], r.n) for r in rows)
        n = np.zeros(len(kept), np.int64)
        for r in rows:
            n[number[r.ctx]] += r.n
        parent = np.array([numbers[suffix[r.ctx]] if numbers else -1 for r in kept], np.int64)
        keys, seen = (np.array(x, np.int64) for x in zip(*own, strict=True))
        tree.levels.append(Level(parent, n, keys, seen, np.ones(len(kept), bool), np.array([r.mass for r in kept]), np.array([r.total for r in kept])))
        numbers = number
        for run in runs:
            run.longer()
            suffix |= dict(zip(run.key.view(np.int64).tolist(), run.shorter.view(np.int64).tolist(), strict=True))
    return tree, words


def score_texts(docs: DataFrame) -> DataFrame:
    """Log10 probability of each whole text under a suffix tree learned from the rows that are not held out.

    Returns one row per input row: doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens, base_score (add-one unigram) and score. A
    token's probability is that after the longest kept context that precedes it in the text, mixed down the shorter ones to the unigram;
    probabilities after any state sum to one, one unknown word included. A block of texts looks its distinct runs up by their hash.
    Null and empty texts have one token, the end; a null id is not held out; repeated rows are scored
    and learned each; without training rows every probability is 1; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out().alias("held_out"))
    with set_for(docs.sparkSession, RELEASED_SHUFFLES | _SMALL_TASKS):
        blocks = cut_lineage(_blocks(rows), **{"parquet.dictionary.page.size": str(2 << 20)})
        with set_for(docs.sparkSession, _shares(blocks)):
            grown = grow(blocks)
    sums, tokens, spread = grown.sums[0], grown.tokens, float(grown.tokens + grown.kinds + 1)
    for table in grown.sums[1:]:
        sums = sums.unionByName(table)

    def score(block: pa.Table, sums: pa.Table) -> pa.Table:
        out, sums = [], sums.sort_by("part")
        for i in range(block.num_rows):
            n = block["sizes"][i].values.to_numpy().astype(np.int64)
            parts = [x.values.to_numpy() for x in sums["v"]]
            base = parts[0] - n * np.log10(spread)
            facts = {"doc_id": block["doc_ids"][i].values, "held_out": block["held_out"][i].values, "n_tokens": n, "n_known": sums["known"][0].values, "train_tokens": np.full(len(n), tokens)}
            out.append(pa.table(facts | {"base_score": base, "score": base + sum(parts[1:])}))
        return pa.concat_tables(out)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.select("block", "doc_ids", "held_out", "sizes").groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(score, schema)
