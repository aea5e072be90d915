"""Importance resampling against a direct version that reads whole texts."""

import hashlib
import math
import re
import zlib

import pytest

from herdframe.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def direct(docs, target, ngrams=1, buckets=10_000, least=20, share=10):
    def features(text):
        words = WORD.findall((text or "").translate(LOWER))
        runs = [" ".join(words[i : i + k]) for k in range(1, ngrams + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    own, wanted = [features(t) for _, t, _ in docs], [features(t) for t in target]
    s, t = [0] * buckets, [0] * buckets
    for rows, out in ((own, s), (wanted, t)):
        for _, f in rows:
            for b in f:
                out[b] += 1
    all_s, all_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for (i, _, _), (n, f) in zip(docs, own, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = order[: share * len(order) // 100]
    ranks = {}
    for k, r in enumerate(drawn, 1):
        ranks.setdefault(r, []).append(k)
    return sorted(((*r[:4], (ranks.get(r) or [None]).pop(0) if ranks.get(r) else None) for r in rows), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows(prose):
    shared = prose(12, 1)
    out = [(i, f"{shared}\n{prose(5 + i % 40, i)}\n\n{prose(9, i % 7)} ÉtÉ-99\r\nEnd", "a") for i in range(1, 150)]
    out += [(500, None, "a"), (501, "", "b"), (502, "... --\n!", None), (503, "\n\n\n", "a"), (504, "one", "a"), (None, prose(30, 5), "a"), (505, prose(30_000, 6), "a")]
    out += [(506, prose(25, 7), "x")] * 3 + [(i, f"{prose(24, 8)}", "x") for i in range(600, 640)]
    return out


TARGET = ["ka bar kabar lofil End", "Kabar kaden migos\ntÉ 99", "", None]


@pytest.mark.parametrize("ngrams", [1, 2, 3])
def test_against_whole_texts(spark, docs_of, rows, ngrams):
    target = spark.createDataFrame([(i, t, "z") for i, t in enumerate(TARGET)], "item_id long, text string, h1 string")
    found = importance.resample(docs_of(rows), target, ngrams=ngrams)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got(found) == direct(rows, TARGET, ngrams)


def test_each_distinct_line_is_counted_once(docs_of, rows):
    lines = importance.line_features(docs_of(rows)).collect()
    assert len({(r.h1, r.h2) for r in lines}) == len(lines)
    hot = max(lines, key=lambda r: r.n)
    assert hot.n >= 149 and hot.words == len(hot.buckets)
    assert all(r.words > 0 for r in lines)


def test_shares_and_few_buckets(spark, docs_of, rows):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert got(importance.resample(docs_of(rows), target, buckets=7, least_words=3, share=50)) == direct(rows, TARGET, 1, 7, 3, 50)
    assert got(importance.resample(docs_of(rows), target, share=100)) == direct(rows, TARGET, share=100)
    assert all(r[4] is None for r in got(importance.resample(docs_of(rows), target, least_words=10**9)))


def test_empty_tables(spark, docs_of, rows):
    none = spark.createDataFrame([], "text string")
    assert got(importance.resample(docs_of([]), none)) == []
    assert got(importance.resample(docs_of(rows), none)) == direct(rows, [])


def test_common_lines_are_joined_apart(spark):
    from herdframe.llm.counted import join_counted

    rows = spark.createDataFrame([(1 if i < 5000 else i, i) for i in range(25_000)], "k long, v long")
    counted = rows.groupBy("k").count().withColumnRenamed("count", "n").filter("k % 2 = 1").selectExpr("k", "n", "k * 10 as x")
    out = join_counted(rows, counted, ["k"])
    assert out.columns == ["k", "v", "x"]
    assert out.count() == 5000 + 10_000 and out.filter("x <> k * 10").isEmpty()
