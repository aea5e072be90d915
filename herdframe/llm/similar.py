"""N-gram Jaccard join of whole texts: a MinHash LSH forest proposes, exact set comparison decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.llm.groups import components, forest
from herdframe.llm.words import SHINGLE_WORDS, distinct_sorted, list_column, mix, shingles, signatures, slices, split_words, word_hashes
from herdframe.session import cut_lineage

SIMILARITY = 0.8
RECALL = 0.9995
TREES = 24
LABEL_HASHES = 5
HASH_BITS = 12
BLOCK_ROWS = 256
BLOCK_SHINGLES = 1_500_000
_CELLS = 1 << 22


def expected_recall(similarity: float, depth: int, trees: int = TREES) -> float:
    """Probability that two sets share a label prefix of ``depth`` hashes in at least one tree."""
    return 1 - (1 - similarity**depth) ** trees


def first_depth(similarity: float, recall: float) -> int:
    """The longest prefix that reaches the recall for pairs at the threshold."""
    for depth in range(LABEL_HASHES, 0, -1):
        if expected_recall(similarity, depth) >= recall:
            return depth
    raise ValueError("this similarity and recall need more trees")


def _sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat, starts = split_words(texts)
    return distinct_sorted(*shingles(word_hashes(flat), starts, SHINGLE_WORDS))


def _digests(values: np.ndarray, starts: np.ndarray) -> list[str]:
    data = values.tobytes()
    return [xxhash.xxh128_hexdigest(data[8 * a : 8 * b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]


def _labels(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One label per text and tree: bits of its least hashes side by side in one number, so label order is the order of the prefix trie
    and a shorter prefix is a shift. The least hashes of long texts are all small, so their bits are mixed first."""
    top = (mix(signatures(values, starts, TREES * LABEL_HASHES)) >> np.uint64(64 - HASH_BITS)).reshape(-1, TREES, LABEL_HASHES)
    out = np.zeros(top.shape[:2], np.uint64)
    for k in range(LABEL_HASHES):
        out = (out << np.uint64(HASH_BITS)) | top[:, :, k]
    return out.astype(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _facts(keyed: DataFrame) -> DataFrame:
    """doc_id, text_key, cls (digest of the text's shingle set: equal sets are one class), n (shingles), labels."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                values, starts = _sets(piece["text"])
                labels = _labels(values, starts)
                yield pa.RecordBatch.from_arrays(
                    [piece["doc_id"], piece["text_key"], pa.array(_digests(values, starts), pa.string()), pa.array(np.diff(starts)),
                     list_column(labels.ravel(), np.arange(len(labels) + 1) * TREES, pa.int64())],
                    names=["doc_id", "text_key", "cls", "n", "labels"],
                )

    return keyed.mapInArrow(compute, "doc_id long, text_key long, cls string, n long, labels array<long>")


def _shared_prefixes(classes: DataFrame, depth: int) -> DataFrame:
    """Edges (src, dst) from each class to the smallest class with the same prefix, in every tree."""
    entries = classes.filter("n > 0").select("cls", F.posexplode("labels").alias("tree", "label"))
    entries = entries.select("cls", "tree", F.shiftright("label", HASH_BITS * (LABEL_HASHES - depth)).alias("prefix"))
    entries = entries.repartition("tree", "prefix")
    groups = entries.groupBy("tree", "prefix").agg(F.min("cls").alias("dst"), F.max("cls").alias("top")).filter("dst <> top").drop("top")
    return entries.join(groups, ["tree", "prefix"]).filter("cls <> dst").select(F.col("cls").alias("src"), "dst").distinct()


def _deal(members: DataFrame, block_rows: int) -> DataFrame:
    """Pairs of blocks of each component, with ``pair`` and ``side`` (0: first block, 1: second, 2: a block with itself)."""
    sums = members.groupBy("component").agg(F.count(F.lit(1)).alias("__m"), F.sum("n").alias("__s"))
    blocks = F.ceil(F.greatest(F.col("__m") / block_rows, F.col("__s") / BLOCK_SHINGLES)).cast("int")
    rows = members.join(sums, "component").withColumn("__k", blocks)
    rows = rows.withColumn("__b", F.pmod(F.xxhash64("cls", F.lit("block")), F.col("__k")).cast("int"))
    rows = rows.withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__k") - 1)))
    side = F.when(F.col("__b") == F.col("__o"), 2).when(F.col("__b") < F.col("__o"), 0).otherwise(1)
    pair = F.concat_ws(":", "component", F.least("__b", "__o"), F.greatest("__b", "__o"))
    return rows.withColumns({"pair": pair, "side": side}).drop("__m", "__s", "__k", "__b", "__o", "component", "n")


def shared_counts(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, as products of 0/1 blocks over the values that more than one set has."""
    rows = len(starts) - 1
    owner = np.repeat(np.arange(rows), np.diff(starts))
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    several = count > 1
    number = np.cumsum(several) - 1
    use = several[column]
    owner, column = owner[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((rows, rows), np.float32)
    width = max(1, _CELLS // rows)
    for first in range(0, int(several.sum()), width):
        a, b = np.searchsorted(column, [first, first + width])
        part = np.zeros((rows, width), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        out += part @ part.T
    return out


def _compare(dealt: DataFrame, keyed: DataFrame, similarity: float, depth: int) -> DataFrame:
    """Exact comparison inside block pairs: (kind 0, cls, '', n) linked rows outside the class, (1, cls, other, 0) pairs that join the same
    classes as all links, (2, '', '', n) links, (3, '', '', n) links with a shared prefix.

    The texts of the representatives are fetched by id and text key; sets go to their block pair once.
    """
    shift = HASH_BITS * (LABEL_HASHES - depth)
    cond = keyed["doc_id"].eqNullSafe(dealt["rep_id"]) & (keyed["text_key"] == dealt["rep_key"])
    fetched = keyed.join(dealt, cond).select("pair", "side", "cls", "copies", "labels", "text")

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                sets = list_column(*_sets_signed(piece["text"]), pa.int64())
                yield pa.RecordBatch.from_arrays([*[piece[c] for c in ("pair", "side", "cls", "copies", "labels")], sets], names=["pair", "side", "cls", "copies", "labels", "set"])

    def verify(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("cls").reset_index(drop=True)
        cls, side, copies = part["cls"].to_numpy(), part["side"].to_numpy(), part["copies"].to_numpy()
        size = part["set"].map(len).to_numpy()
        shared = shared_counts(np.concatenate(part["set"].to_list()), np.concatenate([[0], np.cumsum(size)]))
        a, b = np.nonzero(shared >= similarity * (size[:, None] + size[None, :] - shared) - 1e-6)
        use = (a < b) & ((side[a] == 2) | (side[a] != side[b]))
        a, b = a[use], b[use]
        count = np.zeros(len(part), np.int64)
        np.add.at(count, a, copies[b])
        np.add.at(count, b, copies[a])
        labels = np.stack(part["labels"].to_list()) >> shift
        direct = np.zeros(len(a), bool)
        for t in range(labels.shape[1]):
            direct |= labels[a, t] == labels[b, t]
        got, (fa, fb) = np.flatnonzero(count), forest(len(part), a, b)
        return pd.DataFrame(
            {
                "kind": np.repeat([0, 1, 2, 3], [len(got), len(fa), 1, 1]).astype(np.int32), "cls": [*cls[got], *cls[fa], "", ""],
                "other": [*[""] * len(got), *cls[fb], "", ""], "n": np.concatenate([count[got], np.zeros(len(fa), np.int64), [len(a), direct.sum()]]),
            }
        )

    sets = fetched.mapInArrow(tokenised, "pair string, side int, cls string, copies long, labels array<long>, set array<long>")
    return sets.groupBy("pair").applyInPandas(lambda part: _plain_strings(verify(part)), "kind int, cls string, other string, n long")


def _sets_signed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values, starts = _sets(texts)
    return values.view(np.int64), starts


def _plain_strings(df: pd.DataFrame) -> pd.DataFrame:
    return df.astype({c: object for c in ("cls", "other")})


def _classes(docs: DataFrame, similarity: float, recall: float, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(rows, named): rows with doc_id, text_key, cls; and per class n_links and the smallest member of its group."""
    keyed = _keyed(docs)
    facts = cut_lineage(_facts(keyed))
    rep = F.min(F.struct("doc_id", "text_key"))
    classes = facts.groupBy("cls").agg(rep.alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("labels").alias("labels"))
    classes = cut_lineage(classes.select("cls", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"), "copies", "n", "labels"))
    depth = first_depth(similarity, recall)
    while True:
        near = components(_shared_prefixes(classes, depth)).withColumnRenamed("node", "cls")
        dealt = cut_lineage(_deal(classes.join(near, "cls"), block_rows))
        links = cut_lineage(_compare(dealt, keyed, similarity, depth))
        seen = links.groupBy().agg(F.sum(F.when(F.col("kind") == 2, F.col("n"))).alias("all"), F.sum(F.when(F.col("kind") == 3, F.col("n"))).alias("direct")).first()
        if not seen["all"] or seen["direct"] >= recall * seen["all"] or depth == 1:
            break
        depth -= 1
    others = links.filter("kind = 0").groupBy("cls").agg(F.sum("n").alias("others"))
    joined = components(links.filter("kind = 1").select(F.col("cls").alias("src"), F.col("other").alias("dst"))).withColumnRenamed("node", "cls")
    named = classes.select("cls", "rep_id", "rep_key", "copies").join(others, "cls", "left").join(joined, "cls", "left")
    named = cut_lineage(named.withColumn("component", F.coalesce("component", "cls")))
    smallest = named.groupBy("component").agg(F.min(F.struct(F.col("rep_id").alias("id"), F.col("rep_key").alias("key"))).alias("first"))
    links_of = F.coalesce(F.col("others"), F.lit(0)) + F.col("copies") - 1
    named = named.join(smallest, "component").select("cls", links_of.alias("n_links"), F.col("first.id").alias("class_id"), F.col("first.key").alias("class_key"), "rep_id", "rep_key")
    return facts.select("doc_id", "text_key", "cls"), cut_lineage(named)


def jaccard_join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Near-duplicate join of whole texts: doc_id, class_id, n_links, kept, one row per input row.

    Texts are sets of shingles of five lower-case words (fewer words: the whole text); two rows are linked when the Jaccard similarity is at least
    ``similarity``. Each of ``TREES`` prefix tries is read at the longest prefix that reaches ``recall`` for pairs at the threshold;
    rows that share a prefix, and rows joined by such pairs, are compared exactly, block by block. If fewer of the links found than
    ``recall`` share a prefix themselves, all prefixes are shortened by one hash and the join is made again.

    ``n_links`` counts the other rows linked directly, equal texts included; ``class_id`` is the smallest doc_id reachable by links,
    its own included. ``kept`` marks the rows with that doc_id and the first text of the group. Null texts are empty; texts without words are
    equal to each other; a null id comes first among the ids of its group; repeated rows are linked rows; an empty
    table gives an empty result; other columns are ignored.
    """
    rows, named = _classes(docs, similarity, recall, block_rows)
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("class_key"))
    return rows.join(named, "cls").select("doc_id", "class_id", "n_links", kept.alias("kept"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row of each group of near duplicates, with all columns of ``docs``: that with the smallest doc_id and first text; of rows
    equal in both, any one."""
    _, named = _classes(docs, similarity, recall, BLOCK_ROWS)
    first = named.filter(F.col("rep_id").eqNullSafe(F.col("class_id")) & (F.col("rep_key") == F.col("class_key")))
    first = first.select(F.struct("rep_id", "rep_key").alias("__key"))
    key = F.struct(F.col("doc_id").cast("long").alias("rep_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("rep_key"))
    kept = docs.withColumn("__key", key).join(first, "__key", "left_semi")
    return kept.dropDuplicates(["__key"]).select(*[F.col(f"`{c}`") for c in docs.columns])
