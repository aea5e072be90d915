"""Trees against direct traversal, and accuracy on held-out labels."""

import zlib

import numpy as np

from herdframe.llm import quality


def walk(trees, row):
    raw = trees.base
    for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf, strict=True):
        at = 0
        while at < len(f):
            at = 2 * at + 1 + int(row[f[at]] > c[at])
        raw += leaf[at - len(f)]
    return 1 / (1 + np.exp(-raw))


def test_traversal_and_fit():
    draw = np.random.default_rng(1)
    x = draw.standard_normal((3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = quality.fit(x[:2000], y[:2000], rounds=30)
    score = trees.score(x)
    assert np.allclose(score[:50], [walk(trees, r) for r in x[:50]])
    assert ((score[2000:] >= 0.5) == y[2000:]).mean() > 0.97


def test_first_split_is_the_best_one():
    draw = np.random.default_rng(2)
    x = draw.integers(0, 8, (200, 3)).astype(float)
    y = ((x[:, 2] > 4) | (draw.random(200) < 0.1)).astype(float)
    trees = quality.fit(x, y, rounds=1, depth=1, ridge=1.0, least=0.1)
    p = (y.sum() + 1) / 202
    g, h = y - p, np.full(200, p * (1 - p))
    gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1) + g[~m].sum() ** 2 / (h[~m].sum() + 1)
    best = max((gain(x[:, f] <= c), f, c) for f in range(3) for c in range(7))
    assert (trees.feature[0, 0], trees.cut[0, 0]) == best[1:]


def test_odd_labels():
    x = np.zeros((4, 2))
    assert np.allclose(quality.fit(x[:0], np.zeros(0)).score(x), 0.5)
    assert np.allclose(quality.fit(x, np.ones(4)).score(x), 5 / 6)
    assert quality.fit(x, np.array([0.0, 1, 0, 1])).score(x[:0]).shape == (0,)


def sample(prose):
    rows = [(i, prose(80, i).capitalize() + ".\n" + prose(40, 1000 + i) + ".", "s") for i in range(150)]
    rows += [(200 + i, " ".join(w + "!!" for w in prose(60, i).upper().split()), "s") for i in range(75)]
    rows += [(300 + i, f"{prose(1, i)} " * 90, "s") for i in range(75)]
    return rows


def test_held_out_accuracy(spark, docs_of, prose):
    rows = [*sample(prose), (None, "text", "s"), (500, None, None), (501, "", "s"), (0, sample(prose)[0][1], "s"), (502, prose(50_000, 4), "s")]
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i, _, _ in rows if i is not None and i < 400] + [(500, None, 0), (3, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs_of(rows), labels).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    judged = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(judged) > 30 and all(r.predicted == int(r.doc_id < 200) for r in judged)
    flipped = spark.createDataFrame([(r.doc_id, int((r.quality or 0) == 0) if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.quality, 0) for r in labels.collect()], labels.schema)
    again = quality.classify(docs_of(rows), flipped).collect()
    assert sorted((str(r.doc_id), r.score) for r in got) == sorted((str(r.doc_id), r.score) for r in again)  # held-out labels are never learned
    df = docs_of(rows)
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.predicted)


def test_empty_tables(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(docs_of([]), labels).count() == 0
    assert [r.score for r in quality.classify(docs_of([(1, "a", "s")]), labels).collect()] == [0.5]
    assert quality.keep_good(docs_of([(1, "a", "s")]), labels).count() == 1
