"""Centroid clustering against all distances in Python's whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from herdframe.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, vec string, distance int"


def direct(rows, clusters=8, rounds=10, dim=64):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: "~" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = [[] for _ in centres]
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, centres, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {k: sum(d for _, d, c in found if c == k) for k in range(len(centres))}
    fits = lambda x: x if x < 1 << 63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, k, fits(d), fits(inertia[k]), fits(sum(inertia.values())), sha[k]) for i, d, k in found), key=str)


def run(spark, rows, **more):
    out = centroids.cluster(spark.createDataFrame([(*r, 1, "a", "b", 2) for r in rows], SCHEMA), **more)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(4)
    centre = draw.standard_normal((6, 64))
    out = [(i, (centre[i % 6] + 0.4 * draw.standard_normal(64)).tolist()) for i in range(120)]
    out += [(200 + i, out[0][1]) for i in range(9)] + [(7, out[5][1])] * 3  # copies, and repeated ids
    odd = [None, [], [1.0] * 63, [1.0] * 65, [float("nan")] * 64, [None] * 64, [float("inf")] + [0.0] * 63]
    return out + [(300 + i, v) for i, v in enumerate(odd)] + [(None, [0.0] * 64), (400, [-0.0] * 64), (401, [2000.25] * 64)]


def test_against_all_distances(spark, rows):
    assert run(spark, rows) == direct(rows)
    assert run(spark, rows, clusters=3, rounds=1) == direct(rows, 3, 1)


def test_few_and_equal_vectors(spark, rows):
    assert run(spark, rows[:5]) == direct(rows[:5])
    same = [(i, [0.5] * 64) for i in range(20)]
    assert run(spark, same) == direct(same) and {r[1] for r in run(spark, same)} == {0}
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []


def test_wide_components_stay_exact(spark, rows):
    wide = rows + [(500, [3e30] + [1.0] * 63), (501, [-2e9] * 64), (502, [70_000.5] * 64)]
    assert run(spark, wide) == direct(wide)


def test_threshold_algorithm_gives_the_smallest_of_the_nearest():
    draw = np.random.default_rng(5)
    for k, dim in ((1, 3), (40, 2), (40, 5), (200, 3)):
        c = draw.integers(-50, 50, (k, dim))
        c[-1] = c[0]
        x = np.concatenate([draw.integers(-60, 60, (500, dim)), c])
        number, distance, computed = centroids.Frontier(c).nearest(x)
        every = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()
        if k == 200:
            assert computed < 0.5 * every.size  # it stops before all are met
