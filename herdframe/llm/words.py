"""Words, hashes and shingles of whole texts in Arrow batches, as flat numpy arrays."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE_WORDS = 5
SLICE_BYTES = 4 << 20
_EDGES = string.punctuation + "\u00ab\u00bb\u201c\u201d\u201e\u2018\u2019\u2013\u2014\u2026\u00bf\u00a1"
_MULTIPLIERS = np.random.default_rng(20240).integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each; a longer text is a part of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + limit, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after the other, and where each text's words begin (one more entry at the end).

    Words are runs of characters other than ASCII white space. A null text has no words.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.utf8_lower(texts) if lower else texts)
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    kept = np.concatenate([[0], np.cumsum(full, dtype=np.int64)])
    return flat.filter(pa.array(full)), kept[offsets - offsets[0]]


def word_codes(flat: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Code of each word, the 64-bit hash behind each code, and the distinct words."""
    coded = flat.dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), hashes, coded.dictionary


def word_hashes(flat: pa.Array) -> np.ndarray:
    codes, hashes, _ = word_codes(flat)
    return hashes[codes]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, starts: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside each text and where each text's runs begin.

    A text of 1 to size-1 words has one shingle, the whole text; a text without words has none.
    """
    n = np.diff(starts)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    begins = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(starts[:-1] - begins[:-1], count) + np.arange(begins[-1])
    out = np.zeros(len(at), np.uint64)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    width = np.repeat(np.minimum(n, size), count)
    for k in range(size):
        part = padded[at + k] if size == 1 or (width > k).all() else np.where(width > k, padded[at + k], 0)
        out = out * np.uint64(0x9E3779B97F4A7C15) + part
    return mix(out + width.astype(np.uint64)), begins


def distinct_sorted(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text in rising order, and where each text's values begin."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(starts) - 1))]).astype(np.int64)


def signatures(values: np.ndarray, starts: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash signatures, one row per text; texts without values get all ones."""
    out = np.full((len(starts) - 1, hashes), np.iinfo(np.uint64).max, np.uint64)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        at = starts[:-1][full]
        for k in range(hashes):
            out[full, k] = np.minimum.reduceat(values * _MULTIPLIERS[k], at)
    return out


def list_column(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values."""
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values, kind))


def bare_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words without punctuation at their ends, and where each text's words begin; words of punctuation alone are left out."""
    flat, starts = split_words(texts)
    coded = flat.dictionary_encode()
    bare = [w.strip(_EDGES) for w in coded.dictionary.to_pylist()]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in bare), np.uint64, len(bare))
    full = np.fromiter((len(w) > 0 for w in bare), bool, len(bare))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    if not len(codes):
        return np.zeros(0, np.uint64), starts
    kept = full[codes]
    before = np.concatenate([[0], np.cumsum(kept)])
    return hashes[codes[kept]], before[starts]
