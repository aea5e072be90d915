"""Links of vectors against all pairs."""

import numpy as np

from herdframe.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, cls string, keys string, tbl int"


def brute(rows):
    good = lambda v: v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    vec = [np.array(v, np.float32).astype(float) if good(v) else None for _, v, _ in rows]

    def near(i, j):
        if i == j or vec[i] is None or vec[j] is None or rows[i][2] is None or rows[i][2] != rows[j][2] or len(vec[i]) != len(vec[j]):
            return False
        return vec[i] @ vec[j] / np.sqrt((vec[i] @ vec[i]) * (vec[j] @ vec[j])) >= 0.98

    links = [[j for j in range(len(rows)) if near(i, j)] for i in range(len(rows))]
    low = [r[0] for r in rows]
    for _ in rows:
        low = [min([low[i], *[low[j] for j in links[i]]]) for i in range(len(rows))]
    return sorted((rows[i][0], len(links[i]), low[i], low[i] == rows[i][0]) for i in range(len(rows)))


def make(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA)


def got(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def test_against_all_pairs(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.standard_normal(16).tolist(), i % 3) for i in range(60)]
    for i in range(60, 160):
        v, noise = np.array(rows[int(draw.integers(20))][1]), draw.standard_normal(16)
        rows.append((i, (v + noise * draw.choice([0.02, 0.1, 0.16])).tolist(), int(draw.integers(3))))
    rows += [(200 + i, rows[0][1], 0) for i in range(6)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0]]
    rows += [(300 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(400, rows[0][1], None), (401, rows[0][1], None), (402, [-0.0, 1.0], 2), (403, [0.0, 1.0], 2)]
    for blocks in (1024, 8):
        assert got(embeddings.near_duplicates(make(spark, rows), block_rows=blocks)) == brute(rows)


def test_empty_table(spark):
    assert got(embeddings.near_duplicates(make(spark, []))) == []


def test_tables_reach_the_recall():
    assert (1 - 0.3) ** embeddings.tables_for(0.98, 16, 0.9999) < 1e-3
    assert embeddings.tables_for(0.98, 20, 0.9999) > embeddings.tables_for(0.98, 10, 0.9999)
