"""Operators without SQL, against plain Python on small fixtures, and statistical properties."""

import math
import random
import statistics
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from herdframe.functions import stats as S
from herdframe.functions import tails as T
from herdframe.operators import genotypes as Y
from herdframe.operators import gwas as G
from herdframe.operators import intervals as V
from herdframe.operators import ordered as O
from herdframe.operators import pedigree as D
from herdframe.operators import ranks as R


def test_distribution_functions(spark):
    ps = [1e-300, 1e-50, 1e-10, 0.001, 0.05, 0.3, 0.5, 0.8, 0.9999999]
    d = spark.createDataFrame([(p,) for p in ps], "p double").withColumns({"z": T.norm_ppf("p"), "x": T.chi2_1_isf("p")})
    for r in d.withColumns({"back": T.chi2_1_sf("x"), "nl": T.chi2_1_neglog10_sf("x")}).collect():
        assert r.z == pytest.approx(statistics.NormalDist().inv_cdf(r.p), rel=1e-12, abs=1e-14)
        assert r.back == pytest.approx(r.p, rel=1e-11)
        assert r.nl == pytest.approx(-math.log10(r.p), rel=1e-11)
    xs = [-3.0, -0.2, 0.0, 0.3, 0.46875, 1.0, 4.0, 4.5, 20.0]
    for r in spark.createDataFrame([(x,) for x in xs], "x double").withColumn("e", T.erfc("x")).collect():
        assert r.e == pytest.approx(math.erfc(r.x), rel=1e-13)
    edge = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (None,)], "p double").select(T.chi2_1_isf("p").alias("x")).collect()
    assert [r.x for r in edge] == [math.inf, 0.0, None, None]


def test_tail_stays_finite_where_p_underflows(spark):
    x = spark.createDataFrame([(4000.0,)], "x double").select(T.chi2_1_neglog10_sf("x").alias("v")).first().v
    assert x == pytest.approx(4000 / 2 / math.log(10) + 0.5 * math.log10(math.pi * 2000), rel=1e-6)


def test_hypergeometric(spark):
    cases = [(3, 10, 20, 100), (0, 5, 5, 50), (5, 5, 5, 50), (12, 40, 300, 2000), (18, 20, 90, 100)]
    d = spark.createDataFrame(cases, "k int, n int, m int, t int")
    for r in d.withColumn("p", T.hypergeom_sf("k", "n", "m", "t")).collect():
        want = sum(math.comb(r.m, i) * math.comb(r.t - r.m, r.n - i) for i in range(r.k, min(r.m, r.n) + 1)) / math.comb(r.t, r.n)
        assert r.p == pytest.approx(want, rel=1e-9)


def test_hypergeometric_ends(spark):
    cases = [(0, 0, 0, 10), (6, 5, 5, 50), (1, 9, 10, 10), (3, None, 5, 50), (400, 1000, 40_000, 100_000), (20, 1000, 40_000, 4_000_000)]
    got = [r.p for r in spark.createDataFrame(cases, "k int, n int, m int, t int").withColumn("p", T.hypergeom_sf("k", "n", "m", "t")).collect()]
    exact = lambda k, n, m, t: 1 - sum(math.comb(m, i) * math.comb(t - m, n - i) for i in range(k)) / math.comb(t, n)
    assert got[:4] == [1.0, 0.0, 1.0, None]
    assert got[4] == pytest.approx(exact(*cases[4]), rel=1e-7) and got[5] == pytest.approx(exact(*cases[5]), rel=1e-4)


def test_chi_square_tail_of_any_degrees(spark):
    cases = [(x, v) for x in (0.0, 0.4, 3.0, 30.0, 500.0) for v in (1, 2, 3, 8, 9, 60)] + [(1.0, 0), (None, 2), (2000.0, 1500)]
    for r in spark.createDataFrame(cases, "x double, v int").withColumn("p", T.chi2_sf("x", "v")).collect():
        if r.x is None or r.v < 1:
            assert r.p is None
            continue
        # density integrated by Simpson's rule over the upper tail, in the root of the value
        u = np.linspace(math.sqrt(r.x), math.sqrt(r.x) + 60, 400_001)
        log = (r.v - 1) * np.log(np.maximum(u, 1e-300)) - u * u / 2 - math.lgamma(r.v / 2) - (r.v / 2 - 1) * math.log(2)
        w = np.ones(len(u))
        w[1:-1:2], w[2:-1:2] = 4, 2
        assert r.p == pytest.approx(float((np.exp(log) * w).sum() * (u[1] - u[0]) / 3), rel=1e-6, abs=1e-300)


TAILS = {
    "norm_ppf": lambda: T.norm_ppf("x"), "erfc": lambda: T.erfc("x"), "erfcx": lambda: T.erfcx("x"), "chi2_1_sf": lambda: T.chi2_1_sf("x"), "chi2_1_isf": lambda: T.chi2_1_isf("x"),
    "chi2_1_neglog10_sf": lambda: T.chi2_1_neglog10_sf("x"), "chi2_sf": lambda: T.chi2_sf("x", F.lit(5)), "scaled_tail": lambda: T.scaled_tail("x", F.lit(1.2)),
    "hypergeom_sf": lambda: T.hypergeom_sf("x", F.lit(9), F.lit(9), F.lit(50)), "lrt_neglog10p": lambda: S.lrt_neglog10p("x", F.lit(0.1)),
}


def quick_plan(df):
    start = time.perf_counter()
    text = df._jdf.queryExecution().executedPlan().toString()
    return len(text) < 10_000 and time.perf_counter() - start < 5


@pytest.mark.parametrize("name", list(TAILS))
def test_tails_can_be_filtered_and_sorted(spark, name):
    d = spark.createDataFrame([(0.1,), (0.7,), (None,)], "x double").withColumn("y", TAILS[name]())
    picked = d.filter("y between -9 and 9").withColumn("z", F.col("y") * 2).filter("z < 18").orderBy("y")
    assert quick_plan(picked)
    assert [r.y for r in picked.collect()] == sorted(r.y for r in d.collect() if r.y is not None and -9 <= r.y < 9)


def test_adjusted_results_can_be_filtered(spark):
    rng = random.Random(9)
    d = spark.createDataFrame([(i % 50, i % 3, rng.random(), rng.gauss(0, 1), 0.5 + rng.random()) for i in range(300)], "snp int, study int, p double, beta double, se double")
    adjusted = G.gc_adjust(d, "p", ["study"])
    assert quick_plan(adjusted.filter("adj_p < 0.05"))
    assert adjusted.filter("adj_p < 0.05").count() == sum(r.adj_p < 0.05 for r in adjusted.collect())
    meta = G.meta_analysis(d, ["snp"])
    for c in ("pvalue_fe", "pvalue_re", "pvalue_q"):
        assert meta.filter(F.col(c) < 0.5).count() == sum(r[c] < 0.5 for r in meta.collect())


def test_genomic_control_gives_lambda_one(spark):
    rng = random.Random(1)
    d = spark.createDataFrame([(i, rng.random() ** 2) for i in range(999)], "i int, p double")
    before = G.inflation_factor(d, "p").first()["lambda"]
    after = G.inflation_factor(G.gc_adjust(d, "p"), "adj_p").first()["lambda"]
    assert before > 1.2 and after == pytest.approx(1.0, abs=1e-9)


def test_qvalues_follow_the_definition(spark):
    rng = random.Random(2)
    ps = [round(rng.random() ** 3, 3) for _ in range(400)] + [0.0, 1.0]
    d = spark.createDataFrame(list(enumerate(ps)), "i int, p double")
    got = {r.i: r.q for r in G.qvalue(d, "p", pi0=0.7).collect()}
    m, order = len(ps), sorted(range(len(ps)), key=lambda i: ps[i])
    low, want = 1.0, {}
    for rank in range(m, 0, -1):
        i = order[rank - 1]
        low = min(low, ps[i] * m / rank)
        want[i] = low
    for i, p in enumerate(ps):
        tied = min(want[j] for j in range(m) if ps[j] == p)
        assert got[i] == pytest.approx(0.7 * min(1.0, tied), abs=1e-12)


def test_qvalue_with_missing_p(spark):
    d = spark.createDataFrame([(1, 0.01), (2, None), (3, 0.5)], "i int, p double")
    assert {r.i: r.p_adj for r in G.bh_adjust(d, "p").collect()} == {1: 0.02, 2: None, 3: 0.5}


def test_median_of_even_odd_and_repeated(spark):
    groups = {"a": [3.0, 1.0, 2.0], "b": [1.0, 1.0, 5.0, 9.0], "c": [-2.5], "d": [7.0] * 6 + [-1e9], None: [2.0, 4.0]}
    d = spark.createDataFrame([(k, x) for k, v in groups.items() for x in v], "k string, x double")
    got = {r.k: r["median"] for r in R.median(d, ["k"], "x").collect()}
    assert got == {k: statistics.median(v) for k, v in groups.items()}


def test_quantiles_of_long_groups_and_small_blocks(spark, monkeypatch):
    rng = random.Random(12)
    groups = {"a": [rng.gauss(0, 1) for _ in range(4000)], "b": [float(rng.randrange(4)) for _ in range(1000)], "c": [-1e300, 5e-324, 0.0]}
    d = spark.createDataFrame([(k, x) for k, v in groups.items() for x in v] + [("d", None)], "k string, x double").repartition(6)
    monkeypatch.setattr(R.value_blocks, "__defaults__", (64,))
    shares = [0.0, 0.1, 0.5, 0.99, 1.0]
    got = {(r.k, r.share): r["quantile"] for r in R.quantiles(d, ["k"], "x", shares).collect()}
    assert got == pytest.approx({(k, q): float(np.quantile(v, q)) for k, v in groups.items() for q in shares}, rel=1e-12)
    whole = R.quantiles(d, [], "x", [0.25]).first()["quantile"]
    assert whole == pytest.approx(float(np.quantile(sum(groups.values(), []), 0.25)))


def test_running_values_cross_bins(spark):
    rng = random.Random(3)
    data = sorted({(c, rng.randrange(0, 900_000)) for c in (1, 2, None) for _ in range(200)}, key=str)
    d = spark.createDataFrame(data, "c int, pos int")
    out = O.running(d, ["c"], O.position_bins("pos", 10_000), ["pos"], {"n": ("sum", F.lit(1)), "prev": ("max", "pos")}, current=False)
    for r in out.collect():
        before = [p for c, p in data if c == r.c and p < r.pos]
        assert r.n == len(before) and r.prev == (max(before) if before else None)


def test_qq_points_small_and_large(spark):
    for n, a in ((10, 0.375), (11, 0.5)):
        d = spark.createDataFrame([((i + 1) / 20,) for i in range(n)] + [(0.0,), (1.0,), (None,)], "p double")
        out = {r["rank"]: r.expected for r in G.qq_points(d, "p").collect()}
        assert out == pytest.approx({i: -math.log10((i - a) / (n + 1 - 2 * a)) for i in range(1, n + 1)})


def test_interval_join_equals_nested_loop(spark):
    rng = random.Random(4)
    markers = [(i, rng.randrange(1, 4), rng.randrange(0, 5000)) for i in range(150)] + [(900, 1, 1000), (901, 1, 1100)]
    feats = [(i, rng.randrange(1, 4), s, s + rng.randrange(0, 900)) for i in range(60) for s in [rng.randrange(0, 5000)]] + [(99, 1, 1050, 1100)]
    m = spark.createDataFrame(markers, "m int, chr int, pos int")
    f = spark.createDataFrame(feats, "f int, chr int, start_pos int, end_pos int")
    for window in (0, 50, 700):
        want = {(a, b) for a, c, p in markers for b, k, s, e in feats if c == k and s - window <= p <= e + window}
        got = V.interval_join(m, f, window, bin_width=256)
        rows = [(r.m, r.f) for r in got.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want
        lone = {r.m for r in V.interval_join(m, f, window, bin_width=256, how="left_anti").collect()}
        assert lone == {a for a, _, _ in markers} - {a for a, _ in want}


def test_nearest_feature_equals_nested_loop(spark):
    rng = random.Random(14)
    markers = [(i, rng.randrange(1, 4), rng.randrange(-50, 6000)) for i in range(200)] + [(500, None, 5), (501, 1, None), (502, 9, 10)]
    feats = [(i, rng.randrange(1, 4), s, s + rng.choice([0, 5, 40, 900, 4000])) for i in range(50) for s in [rng.randrange(-20, 5000)]]
    feats += [(70, 1, 100, 300), (71, 1, 100, 300), (72, 1, 300, 300), (73, 2, 400, 200)]
    m = spark.createDataFrame(markers, "m int, chr int, pos int")
    f = spark.createDataFrame(feats, "f int, chr int, start_pos int, end_pos int")
    for reach in (0, 30, 700):
        want = {}
        for a, c, p in markers:
            near = [(min(abs(p - s), abs(p - e)), s, e, b) for b, k, s, e in feats if c == k and p is not None and s <= e and s - reach <= p <= e + reach]
            if near:
                want[a] = min(near)[1:]
        got = V.nearest_feature(m, f, ["m"], reach, "f", bin_width=128).collect()
        assert len(got) == len(want) and {r.m: (r.start_pos, r.end_pos, r.f) for r in got} == want


def test_a_long_feature_is_one_row(spark):
    f = spark.createDataFrame([(1, 1, 0, 250_000_000), (2, 1, 5, 9), (3, 1, -5, 9)], "f int, chr int, start_pos long, end_pos long")
    m = spark.range(0, 250_000_000, 5_000_000).select(F.lit(1).alias("chr"), F.col("id").alias("pos"))
    out = V.interval_join(m, f)
    assert {(r.f, r.n) for r in out.groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()} == {(1, 50), (3, 1)}
    assert "sequence" not in out._jdf.queryExecution().optimizedPlan().toString()


def kinship(ped):
    """Tabular method; parents come before children in ``ped``."""
    ids = list(ped)
    a = {}
    for i, x in enumerate(ids):
        s, d = ped[x]
        for y in ids[:i]:
            a[x, y] = a[y, x] = 0.5 * (a.get((s, y), 0) + a.get((d, y), 0))
        a[x, x] = 1 + 0.5 * a.get((s, d), 0)
    return {x: a[x, x] - 1 for x in ids}


def test_inbreeding_equals_tabular_method(spark):
    rng = random.Random(5)
    ped = {1: (0, 0), 2: (0, 0), 3: (1, 2), 4: (1, 2), 5: (3, 4), 6: (3, 0), 7: (5, 5)}
    for x in range(8, 60):
        ped[x] = (rng.choice([0, *range(1, x)]), rng.choice([0, *range(1, x)]))
    d = spark.createDataFrame([(k, s, m) for k, (s, m) in ped.items()], "full_reg long, sire_reg long, dam_reg long")
    got = {r.full_reg: r.f for r in D.inbreeding(d, 0).collect()}
    assert got == pytest.approx(kinship(ped), abs=1e-12)


def bounded_kinship(ped, a, b, ra, rb):
    """The definition as it stands: the later born is replaced by its parents while its line has generations left. Ids rise with birth."""
    if 0 in (a, b):
        return 0.0
    if a == b:
        left = min(ra, rb)
        return 0.5 * (1 + (bounded_kinship(ped, *ped[a], left - 1, left - 1) if left else 0))
    if a < b:
        a, b, ra, rb = b, a, rb, ra
    return 0.5 * sum(bounded_kinship(ped, p, b, ra - 1, rb) for p in ped[a]) if ra else 0.0


def test_kinship_of_pairs_with_and_without_bound(spark):
    rng = random.Random(6)
    ped = {1: (0, 0), 2: (0, 0), 3: (1, 2)}
    for x in range(4, 30):
        ped[x] = (rng.choice([0, *range(1, max(2, x - 5))]), rng.choice([0, *range(1, max(2, x - 5))]))
    d = spark.createDataFrame([(k, s, m) for k, (s, m) in ped.items()], "full_reg long, sire_reg long, dam_reg long")
    pairs = [(rng.randrange(1, 30), rng.randrange(1, 30)) for _ in range(80)] + [(5, 5), (29, 29), (0, 3), (None, 3), (3, 1), (3, 1), (77, 3)]
    frame = spark.createDataFrame(pairs, "animal_i long, animal_j long")
    for depth in (None, 2):
        got = {(r.animal_i, r.animal_j): r.kinship for r in D.kinship(d, frame, 0, depth).collect()}
        want = {(i, j): bounded_kinship(ped, i, j, *([99 if depth is None else depth] * 2)) for i, j in pairs if i and j and i != 77}
        assert {k: v for k, v in got.items() if 77 not in k} == pytest.approx(want, abs=1e-12) and got.get((77, 3), 0) == 0
    for depth in (0, 3):
        got = {r.full_reg: r.f for r in D.inbreeding(d, 0, depth).collect()}
        assert got == pytest.approx({x: bounded_kinship(ped, s, m, depth - 1, depth - 1) if depth else 0.0 for x, (s, m) in ped.items()}, abs=1e-12)


def test_links_of_many_generations_are_read_once(spark):
    rng = random.Random(7)
    ped = {(g, k): [(g - 1, rng.randrange(5)), (g - 1, rng.randrange(5))] if g else None for g in range(11) for k in range(5)}
    name = lambda x: "0" if x is None else f"g{x[0]:02d}k{x[1]}"
    rows = [(name(x), name(p and p[0]), name(p and p[1])) for x, p in ped.items()]
    d = spark.createDataFrame(rows, "full_reg string, sire_reg string, dam_reg string")
    levelled, top = D.generations(d)
    assert top == 10 and levelled.read(10).count() == 5
    f = kinship({name(x): tuple(name(q) for q in p) if p else ("0", "0") for x, p in ped.items()})
    assert {r.full_reg: r.f for r in D.inbreeding(d).collect()} == pytest.approx(f, abs=1e-12)


def test_half_sib_mating_and_cycle(spark):
    ped = [("c", "x", "y"), ("x", "s", "d1"), ("y", "s", "d2")]
    d = spark.createDataFrame(ped, "full_reg string, sire_reg string, dam_reg string")
    assert {r.full_reg: r.f for r in D.inbreeding(d).collect()} == {"c": 0.125, "x": 0.0, "y": 0.0}
    with pytest.raises(ValueError, match="cycle"):
        D.inbreeding(spark.createDataFrame([("a", "b", "0"), ("b", "a", "0")], d.schema))


@pytest.fixture(scope="module")
def genotypes(spark):
    rng = np.random.default_rng(6)
    freq = rng.uniform(0.1, 0.9, 40)
    group = rng.integers(0, 2, 60)
    freq2 = np.clip(freq + rng.uniform(-0.4, 0.4, 40), 0.05, 0.95)
    g = rng.binomial(2, np.where(group[:, None] == 1, freq2, freq)).astype(float)
    # neighbours in strong linkage, some missing calls
    g[:, 1::4] = np.where(rng.random((60, 10)) < 0.1, g[:, 1::4], g[:, 0::4])
    g[rng.random((60, 40)) < 0.05] = np.nan
    rows = [(a, s, None if np.isnan(g[a, s]) else int(g[a, s])) for a in range(60) for s in range(40)]
    return g, spark.createDataFrame(rows, "animal long, snp long, dosage int")


def standardised(g):
    mu = np.nanmean(g, axis=0)
    v = mu * (1 - mu / 2)
    z = np.where(np.isnan(g), 0, (g - mu) / np.sqrt(v))
    return z[:, v > 0]


def test_relationship_matrix(spark, genotypes):
    g, d = genotypes
    z = standardised(g)
    want = z @ z.T / z.shape[1]
    ids = spark.range(60)
    every = ids.toDF("animal_i").join(ids.toDF("animal_j"), F.col("animal_i") <= F.col("animal_j"))
    got = {(r.animal_i, r.animal_j): r.value for r in Y.grm(d, every).collect()}
    assert len(got) == 60 * 61 // 2
    for (i, j), value in got.items():
        assert value == pytest.approx(want[i, j], abs=1e-10)


def test_principal_components(spark, genotypes):
    g, d = genotypes
    z = standardised(g)
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    out = Y.pca(d, 2).collect()
    for pc in (1, 2):
        score = np.zeros(60)
        for r in out:
            if r.pc == pc:
                score[r.animal] = r.score
                assert r.share == pytest.approx(s[pc - 1] ** 2 / (s**2).sum(), rel=1e-6)
        assert abs(score @ u[:, pc - 1]) == pytest.approx(1.0, abs=1e-3)


def test_clumping_equals_one_by_one(spark, genotypes):
    g, d = genotypes
    rng = random.Random(7)
    results = [(s, 1 + s // 20, (s % 20) * 300 + rng.randrange(100), rng.random() * 1e-3) for s in range(40)]
    window, limit = 1000, 0.2

    def r2(a, b):
        ok = ~np.isnan(g[:, a]) & ~np.isnan(g[:, b])
        return np.corrcoef(g[ok, a], g[ok, b])[0, 1] ** 2

    left, want = sorted(results, key=lambda r: (r[3], r[0])), set()
    while left:
        top = left.pop(0)
        want.add(top[0])
        left = [r for r in left if not (r[1] == top[1] and abs(r[2] - top[2]) <= window and r2(top[0], r[0]) > limit)]
    frame = spark.createDataFrame(results, "snp long, chr int, pos long, p double")
    assert {r.snp for r in Y.ld_clump(frame, d, window, limit, 1.0).collect()} == want
    assert len(want) < 40


def test_marker_regressions(spark, genotypes):
    g, d = genotypes
    rng = np.random.default_rng(8)
    x, e, w = rng.normal(size=60), rng.normal(size=60) + 15, rng.uniform(0.5, 2, 60)
    y = 0.4 * np.nan_to_num(g[:, 3]) + x + rng.normal(size=60)
    pheno = spark.createDataFrame([(i, float(y[i]), float(x[i]), float(e[i]), float(w[i])) for i in range(60)], "animal long, y double, x double, e double, w double")

    def fit(cols, weight):
        m = np.column_stack([np.ones(len(cols[0])), *cols[:-1]])
        sw = np.sqrt(weight)
        b, _, _, _ = np.linalg.lstsq(m * sw[:, None], cols[-1] * sw, rcond=None)
        res = (cols[-1] - m @ b) * sw
        cov = np.linalg.inv((m * weight[:, None]).T @ m) * (res @ res) / (len(res) - m.shape[1])
        return b[-1], math.sqrt(cov[-1, -1])

    got = {r.snp: r for r in Y.snp_regression(d, pheno, "y", ["x"], "w").collect()}
    gxe = {r.snp: r for r in Y.gxe_regression(d, pheno, "y", "e", ["x"]).collect()}
    for s in range(40):
        ok = ~np.isnan(g[:, s])
        gs = g[ok, s]
        b, se = fit([x[ok], gs, y[ok]], w[ok])
        assert (got[s].b, got[s].se) == pytest.approx((b, se), rel=1e-8)
        b, se = fit([x[ok], e[ok], gs, gs * e[ok], y[ok]], np.ones(ok.sum()))
        assert (gxe[s].b, gxe[s].se) == pytest.approx((b, se), rel=1e-6)


def test_splits_are_exact_and_repeatable(spark):
    from herdframe.operators.windows import sample_fraction

    d = spark.range(203).select(F.col("id").alias("k"))
    a = {r.k for r in sample_fraction(d, "k", 0.25, "s").collect()}
    assert len(a) == 51 and a == {r.k for r in sample_fraction(d.repartition(5), "k", 0.25, "s").collect()}
    assert a != {r.k for r in sample_fraction(d, "k", 0.25, "t").collect()}


def test_ids_are_dense(spark):
    d = spark.range(500).select((F.col("id") % 83).alias("v"), "id")
    codes = O.dense_code(d, "v").select("v", "code").distinct().collect()
    assert sorted(r.code for r in codes) == list(range(1, 84))
    assert sorted(r.row_id for r in O.row_ids(d, ["id"]).collect()) == list(range(1, 501))


def test_smoother_weights_against_a_spline_basis():
    """Natural cubic spline in truncated powers, its penalty by numeric integration, trace 3 by bisection."""
    x = np.array(S.LAMBDA_GRID)
    n = len(x)
    cube = lambda t, k: (np.maximum(t - x[k], 0) ** 3 - np.maximum(t - x[-1], 0) ** 3) / (x[-1] - x[k])
    basis = lambda t: np.stack([np.ones_like(t), t, *[cube(t, k) - cube(t, n - 2) for k in range(n - 2)]], 1)
    second = lambda t, k: 6 * (np.maximum(t - x[k], 0) - np.maximum(t - x[-1], 0)) / (x[-1] - x[k])
    t = np.linspace(x[0], x[-1], 200_001)
    bend = np.stack([0 * t, 0 * t, *[second(t, k) - second(t, n - 2) for k in range(n - 2)]], 1)
    penalty = np.trapezoid(bend[:, :, None] * bend[:, None, :], t, axis=0) if n < 5 else np.array([[np.trapezoid(bend[:, i] * bend[:, j], t) for j in range(n)] for i in range(n)])
    b = basis(x)
    low, high = -40.0, 40.0
    for _ in range(120):
        mid = (low + high) / 2
        smoother = b @ np.linalg.solve(b.T @ b + math.exp(mid) * penalty, b.T)
        low, high = (mid, high) if np.trace(smoother) > 3 else (low, mid)
    assert np.allclose(S.smoother_weights(), smoother[-1], atol=1e-5)
