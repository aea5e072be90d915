"""Mixing against targets computed directly."""

from collections import defaultdict

import numpy as np
import pytest

from herdframe.llm import mixing


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """{source: target} by sharing the total again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        free = sum(weight[s] for s in order if s not in stopped)
        target = {s: most * sizes[s] if s in stopped else (weight[s] * left / free if free else 0) for s in order}
        more = {s for s in order if target[s] > most * sizes[s] + 1e-9}
        if not more:
            return target
        stopped |= more


@pytest.fixture(scope="module")
def rows(prose):
    rnd = np.random.default_rng(1)
    made = [(i, prose(int(rnd.integers(1, 60)), i), ["hot", "ß", "Z", "tiny", None, "a"][min(int(rnd.integers(12)), 5) if i % 3 else 0]) for i in range(600)]
    made = [(i, t, "a" if s == "tiny" and i > 40 else s) for i, t, s in made]
    return [*made, (900, "", "hot"), (901, None, None), (None, "one two", "a"), (None, "one two", "a"), (5, made[5][1], made[5][2]), (902, None, "only empty"), (903, prose(20_000, 1), "hot")]


def test_targets_and_copies(docs_of, rows):
    got = mixing.copies(docs_of(rows)).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    target = brute_targets(sizes)
    assert sorted(((r.doc_id, r.size) for r in got), key=str) == sorted(((i, len((t or "").split())) for i, t, _ in rows), key=str)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in sizes:
        largest = max((2 if t == "one two" else 1) * len((t or "").split()) for _, t, x in rows if x == s)
        assert abs(taken[s] - target[s]) <= largest / 2 + 1e-6


def test_reruns_and_trees_agree(docs_of, rows):
    df = docs_of(rows)
    key = lambda r: (str(r.doc_id), r.size, r.copies)
    once, again = (sorted(map(key, mixing.copies(x).collect())) for x in (df, df.repartition(7)))
    assert once == again


def test_rounding_tree(spark):
    rng = np.random.default_rng(2)
    rows = [(("s",), int(rng.integers(1 << 60)), int(rng.integers(1, 50)), float(rng.random())) for _ in range(500)]
    df = spark.createDataFrame(rows, "source_key struct<source:string>, key long, size long, share double")
    done = mixing.round_shares(df, rows_per_group=20).collect()
    assert {r.share for r in done} == {0.0, 1.0}
    assert abs(sum(r.size * r.share for r in done) - sum(r[2] * r[3] for r in rows)) <= 25


def test_rounding_keeps_expectations():
    size, share = np.array([3.0, 5, 2, 8, 4]), np.array([0.2, 0.5, 0.9, 0.4, 0.7])
    total, n = np.zeros(5), 4000
    for k in range(n):
        out, _ = mixing._pivot(size, share, np.random.default_rng(k))
        assert (size * out).sum() == pytest.approx((size * share).sum())
        total += out
    assert np.abs(total / n - share).max() < 0.03


def test_mixed_rows(docs_of, rows):
    df = docs_of(rows)
    out = mixing.mix(df)
    assert out.columns == df.columns
    count = defaultdict(int)
    for r in mixing.copies(df).collect():
        count[r.doc_id] += r.copies
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert {k: v for k, v in count.items() if v} == dict(got)


def test_empty_table(docs_of):
    assert mixing.copies(docs_of([])).count() == 0
    assert mixing.mix(docs_of([])).count() == 0


def test_repeated_rows_are_dealt_one_by_one(docs_of):
    made = [(7, "one two three", "a")] * 700 + [(i, "four five", "b") for i in range(1000, 1900)]
    got = mixing.copies(docs_of(made)).collect()
    taken, target = defaultdict(int), {r.source: r.target for r in got}
    for r in got:
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1.5 + 1e-6 for s in target)
    mixed = mixing.mix(docs_of(made)).groupBy("source").count().collect()
    assert {r["source"]: r["count"] * (3 if r["source"] == "a" else 2) for r in mixed} == dict(taken)
