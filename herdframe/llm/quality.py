"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdframe.session import cut_lineage

TRAINING_ROWS = 20_000
THRESHOLD = 0.3

_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": bytes(range(48, 58)), "high": bytes(range(128, 256)),
    "blank": b" \t", "line": b"\n", "control": bytes(range(9)) + bytes(range(11, 32)), "stop": b".,;:", "loud": b"!?",
    "symbol": bytes(b for b in _PUNCTUATION if b not in b".,;:!?'\"-"), "bar": b"|", "quote": b"'\"-",
}
_TABLE = np.zeros((256, len(_CLASSES)), np.int64)
for _k, _bytes_ in enumerate(_CLASSES.values()):
    _TABLE[list(_bytes_), _k] = 1
FEATURES = [
    "log_bytes", "log_words", *[f"share_{k}" for k in _CLASSES], "entropy", "word_length", "word_length_sd", "distinct_words", "top_word", "top_pair",
    "repeated_word", "log_lines", "line_length", "distinct_lines", "top_line_bytes", "ended_lines", "capital_words", "upper_words", "marked_words", "once_words",
]


def statistics(text: str) -> list[float]:
    """One value for each of ``FEATURES``, from the whole text; zeros for an empty one."""
    data = text.encode()
    if not data:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = len(data)
    p = counts[counts > 0] / n
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    m = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    kinds, pairs, rows = Counter(words), Counter(zip(words, words[1:], strict=False)), Counter(lines)
    repeated = sum(c for (a, b), c in pairs.items() if a == b)
    firsts = Counter(w[0] for w in words)
    return [
        np.log1p(n), np.log1p(len(words)), *(counts @ _TABLE / n), float(-(p * np.log(p)).sum()), float(lengths.mean()), float(lengths.std()),
        len(kinds) / m, max(kinds.values(), default=0) / m, max(pairs.values(), default=0) / m, repeated / m, np.log1p(len(lines)),
        np.log1p(n / max(len(lines), 1)), len(rows) / max(len(lines), 1), max((len(k) * c for k, c in rows.items() if c > 1), default=0) / n,
        sum(c for k, c in rows.items() if k.rstrip()[-1:] in b".!?:;\"'") / max(len(lines), 1), sum(c for k, c in firsts.items() if 65 <= k <= 90) / m,
        sum(c for k, c in kinds.items() if len(k) > 1 and k.isupper()) / m, sum(c for k, c in kinds.items() if k[-1] in b"!#$%&*@^~|") / m,
        sum(1 for c in kinds.values() if c == 1) / m,
    ]


@dataclass
class Trees:
    """Trees of one depth as arrays: row t of ``feature``/``cut`` holds the inner nodes of tree t level by level, of ``leaf`` its leaves."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row; all rows go down all trees together, one level at a time."""
        if not len(self.leaf):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        inner = self.feature.shape[1]
        rows = np.arange(len(x))[:, None]
        while at[0, 0] < inner if len(x) else False:
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.cut[trees, at])
        raw = self.base + self.leaf[trees, at - inner].sum(1)
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Boost trees on the logistic loss. Features are cut at quantiles into ``bins`` bins; a node's split is the best over the
    histograms of gradients and weights. Without rows, or with one label, the score is the smoothed share of label 1."""
    prior = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(prior / (1 - prior)))
    inner = 2**depth - 1
    none = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    if not len(y) or y.min() == y.max():
        return none
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    coded = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], 1)
    width = coded.shape[1]
    flat = coded + np.arange(width) * bins
    raw = np.full(len(y), base)
    features, places, leaves = [], [], []
    for _ in range(rounds):
        prob = 1 / (1 + np.exp(-raw))
        grad, hess = y - prob, prob * (1 - prob)
        node = np.zeros(len(y), np.int64)
        feature, place = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            nodes = 2**level
            local = node - (nodes - 1)
            keys = (local[:, None] * (width * bins) + flat).ravel()
            g = np.bincount(keys, np.repeat(grad, width), nodes * width * bins).reshape(nodes, width, bins).cumsum(2)
            h = np.bincount(keys, np.repeat(hess, width), nodes * width * bins).reshape(nodes, width, bins).cumsum(2)
            gt, ht = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
            gain[(h < least) | (ht - h < least)] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            for k in range(nodes):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-9 and b < len(cuts[f]):
                    feature[nodes - 1 + k], place[nodes - 1 + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > place[node])
        local = node - inner
        leaf = rate * np.bincount(local, grad, inner + 1) / (np.bincount(local, hess, inner + 1) + ridge)
        raw += leaf[local]
        features.append(feature)
        places.append(place)
        leaves.append(leaf)
    return Trees(np.stack(features), np.stack(places), np.stack(leaves), base)


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``x``, the statistics of the whole text (null: empty)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch["text"], "")
            x = np.array([statistics(t.as_py()) for t in texts]).reshape(-1, len(FEATURES))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], lists], names=[*keep, "x"])

    rows = docs.select(*keep, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(compute, f"{fields}, x array<double>")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned: crc32 of the id as text, modulo 5, is 0. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(rows: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> Trees:
    """Fit on at most ``training_rows`` labelled rows that are not held out, taken in the order of a hash of the id.

    ``rows``: doc_id, held_out, x. Labels that are null, or that differ for one id, are not used. The sample is the only thing that reaches
    the driver; its bound is the parameter.
    """
    known = labels.filter("quality is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    known = known.filter("low = high").select("__id", F.col("low").alias("y"))
    chosen = rows.filter("not held_out").join(known, F.col("doc_id") == F.col("__id"))
    chosen = chosen.orderBy(F.xxhash64("doc_id", F.lit("train")), "doc_id", "x").limit(training_rows).select("x", "y").toArrow()
    y = chosen["y"].to_numpy().astype(np.float64)
    x = np.array(chosen["x"].to_pylist()).reshape(-1, len(FEATURES))
    return fit(x, y)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """One row per input row: doc_id, held_out, score (probability of quality 1), predicted (1 if score >= ``threshold``).

    Only statistics of the whole text are inputs; null and empty texts have all-zero statistics and a score like any other.
    Repeated rows are scored each; without labels, or with one kind of label, all scores are the smoothed share of
    label 1; an empty table gives an empty result; other columns are ignored.
    """
    rows = cut_lineage(with_statistics(docs.select("doc_id", "text", held_out().alias("held_out")), ["doc_id", "held_out"]))
    trees = learn(rows, labels.select("doc_id", "quality"), training_rows)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(trees.score(x))], names=["doc_id", "held_out", "score"])

    done = rows.mapInArrow(scored, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return done.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject. The texts are scored where they are read; only the training sample is moved.

    All columns stay as they are, whatever their names; only text and doc_id are read. Null and empty texts are scored as empty ones; a row with a null id has
    no label and is scored like others; equal rows are kept or rejected alike; texts of any length are read whole; without labels every score is
    the same; an empty table gives an empty one.
    """
    chosen = docs.select("doc_id", "text", held_out().alias("held_out")).filter("not held_out")
    known = labels.filter("quality is not null").select("doc_id").distinct()
    chosen = cut_lineage(with_statistics(chosen.join(known, "doc_id", "left_semi"), ["doc_id", "held_out"]))
    trees = learn(chosen, labels.select("doc_id", "quality"), training_rows)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py() or "") for t in batch["text"]]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(trees.score(x) >= threshold))

    return docs.mapInArrow(good, docs.schema)
