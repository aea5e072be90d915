"""What keeps operators within bounds on large inputs: plans without broadcasts, joins without needless rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from herdframe.functions import records as R
from herdframe.operators import genotypes as Y
from herdframe.operators import intervals as V
from herdframe.operators import ordered as O
from herdframe.operators import pedigree as D
from herdframe.operators import windows as W
from herdframe.operators.keys import left_join_known
from herdframe.plans import cleaning as C
from herdframe.plans import models as M
from herdframe.plans import reports as RP
from herdframe.session import cut_lineage


@pytest.fixture
def written(monkeypatch):
    """Plans of the tables that the pedigree operators store."""
    plans = []
    store, add = D.cut_lineage, D.StagedRows.add

    def stored(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df)

    def added(self, rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        add(self, rows)

    monkeypatch.setattr(D, "cut_lineage", stored)
    monkeypatch.setattr(D.StagedRows, "add", added)
    return plans


@pytest.mark.parametrize("depth", [None, 3])
def test_pedigree_joins_send_nothing_to_the_driver(spark, written, depth):
    ped = spark.createDataFrame([(1, 0, 0), (2, 0, 0), (3, 1, 2), (4, 1, 2), (5, 3, 4), (6, 5, 4)], "full_reg long, sire_reg long, dam_reg long")
    out = D.inbreeding(ped, 0, depth)
    plans = [*written, out._jdf.queryExecution().executedPlan().toString()]
    assert len(plans) > 6 and any("Join" in p for p in plans) and not any("Broadcast" in p for p in plans)
    assert {r.full_reg: r.f for r in out.collect()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0.25, 6: 0.375}


def crowd(spark):
    """Narrow features, many of them in 16,384 places."""
    rng = random.Random(9)
    feats = [(i, 1, s, s + rng.randrange(10, 500), f"t{i % 3}") for i in range(500) for s in [rng.randrange(0, 80_000)]] + [(900, 1, 50, 40, "t0"), (901, None, 1, 9, "t0")]
    marks = [(rng.randrange(3), 1, rng.randrange(-100, 81_000)) for _ in range(400)] + [(1, None, 5), (1, 1, None), (None, 1, 40_000), (2, 2, 10)]
    return spark.createDataFrame(marks, "study int, chr int, pos long"), spark.createDataFrame(feats, "f int, chr int, start_pos long, end_pos long, term string")


@pytest.mark.parametrize("window", [0, 500, 20_000])
def test_markers_meet_few_features_beside_their_own(spark, window):
    m, f = crowd(spark)
    pairs = V.interval_join(m, f, window).count()
    assert 0 < V._candidates(m, f, window, None, "chr", "pos", "start_pos", "end_pos").count() < 4 * pairs


@pytest.mark.parametrize("window", [0, 50, 3000])
def test_features_with_a_marker_of_a_group(spark, window):
    m, f = crowd(spark)
    markers, feats = m.collect(), f.collect()
    want = {(a.study, b.f) for a in markers for b in feats if a.chr == b.chr and None not in (a.chr, a.pos) and b.start_pos <= b.end_pos and b.start_pos - window <= a.pos <= b.end_pos + window}
    got = V.interval_join(m, f, window, how="right_semi", by=["study"])
    rows = [(r.study, r.f) for r in got.collect()]
    assert got.columns == ["study", *f.columns] and len(rows) == len(set(rows)) and set(rows) == want
    alone = [r.f for r in V.interval_join(m, f, window, how="right_semi").collect()]
    assert len(alone) == len(set(alone)) and set(alone) == {b for _, b in want}


def test_points_with_a_marker(spark):
    f = spark.createDataFrame([(i, 1, i, i) for i in range(20)], "f int, chr int, start_pos long, end_pos long")
    m = spark.createDataFrame([(1, 3), (1, 3), (1, 7)], "chr int, pos long")
    assert sorted(r.f for r in V.interval_join(m, f, how="right_semi").collect()) == [3, 7]
    assert sorted(r.f for r in V.interval_join(m, f, 1, how="right_semi").collect()) == [2, 3, 4, 6, 7, 8]


def test_stretches_cover_what_features_cover(spark):
    _, f = crowd(spark)
    covered = {}
    for r in f.filter("start_pos <= end_pos and chr is not null").collect():
        covered.setdefault(r.term, set()).update(range(r.start_pos - 5, r.end_pos + 6))
    rows = V.merged(f, ["term"], 5, bin_width=1_000).collect()
    for term, places in covered.items():
        parts = [set(range(r.start_pos, r.end_pos + 1)) for r in rows if r.term == term]
        assert sum(map(len, parts)) == len(places) and set().union(*parts) == places


def test_clumping_needs_no_round_for_markers_without_links(spark, monkeypatch):
    """Forty markers in one window, of which only the last two are linked."""
    rng = random.Random(2)
    calls = {s: [rng.randrange(3) for _ in range(60)] for s in range(40)}
    calls[39] = calls[38]
    geno = spark.createDataFrame([(a, s, d) for s, c in calls.items() for a, d in enumerate(c)], "animal int, snp int, dosage int")
    results = spark.createDataFrame([(s, 1, 100 + s, (s + 1) / 1000) for s in calls], "snp int, chr int, pos int, p double")
    stored = []
    store = Y.cut_lineage
    monkeypatch.setattr(Y, "cut_lineage", lambda df: stored.append(1) or store(df))
    got = {r.snp for r in Y.ld_clump(results, geno, 1_000, 0.9, 1.0).collect()}
    assert got == set(range(39)) and len(stored) < 10


def test_codes_in_groups_have_bins_of_many_values(spark):
    d = spark.range(300).select((F.col("id") % 3).alias("farm"), (F.col("id") % 90).alias("v"))
    out = O.dense_code(d, "v", ["farm"])
    assert "__fine" not in out._jdf.queryExecution().analyzed().toString()
    assert {(r.farm, r.n, r.top) for r in out.groupBy("farm").agg(F.count_distinct("code").alias("n"), F.max("code").alias("top")).collect()} == {(k, 30, 30) for k in range(3)}


def animals(spark):
    rows = [(i, 1, "F1", i % 4, 2000, f"2000-03-{1 + i % 28:02d}", 1 + i % 5, "SPRING" if i % 3 else None, 1 + i % 9, "F", "YES", "AN", f"R{i % 4}", "A") for i in range(40)]
    d = spark.createDataFrame(rows, "rec_a long, rec_b long, farm_id string, temp_id long, year long, score_date string, score long, season string, age long, sex string, fescue string, breed_code string, registration_number string, animal_id string")
    return d.withColumns({"score_date": F.to_date("score_date"), "full_reg": F.col("temp_id").cast("string"), "mean_apparent_high": F.col("rec_a") / 2.0, "mean_day_length": F.col("rec_b") * 1.0})


def test_filled_records_are_stored_before_they_are_read_again(spark):
    d = animals(spark)
    model = M.model_dataset(d, "fixed13")
    assert model.count() > 0 and "__past_season" not in model._jdf.queryExecution().analyzed().toString()


def test_rows_without_a_key_are_dealt_by_their_hash(spark):
    left = spark.createDataFrame([(None, i) for i in range(400)] + [(1, -1), (2, -2)], "k long, v long")
    right = spark.createDataFrame([(1, "a"), (None, "n")], "k long, w string").filter("k is not null").hint("merge")
    out = left_join_known(left, right, "k")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__rsalt" in plan and "(__salt" in plan and "= 0)" not in plan.split("Join LeftOuter")[1].splitlines()[0]
    assert sorted((r.v, r.w) for r in out.collect() if r.k is not None or r.w is not None) == [(-2, None), (-1, "a")] and out.count() == 402


def test_joined_records_are_stored_before_they_are_read_again(spark, monkeypatch):
    rows = [(i, "F1", i % 3, None if i % 2 else i % 3, 2000, f"2000-04-{1 + i:02d}", "5" if i % 2 else None, "score 3", "COW", "AN", "R", "spring", "Y", None) for i in range(20)]
    joined = spark.createDataFrame(rows, "rec int, farm_id string, temp_id int, lab_id int, year int, score_date string, age string, score string, sex string, breed_code string, color string, season string, fescue string, sold string")
    register = spark.createDataFrame([(0, "1995-03-01")], "lab_id int, dob string")
    stored, store = [], C.cut_lineage
    monkeypatch.setattr(C, "cut_lineage", lambda df: stored.append(1) or store(df))
    out = C.clean_joined(joined, register)
    assert len(stored) == 4 and out.count() == 20 and {r.age for r in out.collect()} == {5}
    assert out._jdf.queryExecution().analyzed().toString().count("LogicalRDD") == 0


def test_hits_are_not_moved_and_counted_without_pairs(spark):
    m, f = crowd(spark)
    m, f = m.drop("study"), f.withColumn("gene", F.when(F.col("f") % 7 > 0, F.col("f") % 50))
    stats = m.filter("pos % 3 > 0").groupBy("chr", "pos").agg(F.count("pos").alias("p"))
    for window in (0, 3000):
        want = {}
        for r in V.interval_join(m, f, window).groupBy("gene").count().collect():
            want[r.gene] = r["count"]
        got = V.markers_inside(m, f, ["gene"], window, bin_width=1_000).collect()
        assert {r.gene: r.n for r in got} == want and len(got) == len(want)
        out = RP.hit_table(m, f, window, stats, ["p"])
        rows = out.collect()
        assert len(rows) == sum(want.values()) and all(r.n == want[r.gene] for r in rows)
        assert {r.distance for r in rows} == {f"{r.d:,}" for r in V.interval_join(m, f, window).select(V.feature_distance().alias("d")).collect()}
    top = out._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Aggregate" not in top and "Window" not in top


def test_polynomials_part_close_eigenvalues():
    """Against the first direction every direction whose value is 2 percent smaller shrinks, however many values are as large as the first."""
    grown = lambda v, half, steps: np.cosh(steps * np.arccosh(np.maximum(v / half - 1, 1))) * np.where(v > 2 * half, 1, np.cos(steps * np.arccos(np.clip(v / half - 1, -1, 1))))
    smaller = np.linspace(0, 0.98, 4000)
    for last in (1.0, 0.99, 0.9, 0.3):
        half, steps = Y._polynomial(np.linspace(1, last, 16), 4, 1e7)
        assert 4 <= steps <= 32
        assert abs(grown(smaller[smaller <= last], half, steps)).max() < 0.1 * grown(np.array([1.0]), half, steps)[0]
    assert Y._polynomial(np.linspace(1, 0.9, 16), 4, 5.0)[1] == 4


def test_multiplication_moves_one_row_per_animal_and_task(spark):
    """Genotypes stay where their markers are: only sums by animal and the vectors are moved."""
    z = Y._dealt(spark.range(4000).selectExpr("id % 50 as animal", "id div 50 as snp", "cast(id % 7 - 3 as double) as z"), 4000)
    vectors = spark.range(50).selectExpr("id as animal", "cast(id as double) as y0")
    out = Y._multiplied(z, vectors.hint("broadcast"), ["y0"], ["w0"])
    got = {r.animal: r.w0 for r in out.collect()}
    dense = np.array([[(s * 50 + a) % 7 - 3.0 for s in range(80)] for a in range(50)])
    assert [got[a] for a in range(50)] == pytest.approx(list(dense @ (dense.T @ np.arange(50.0))))
    plan = out._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert plan.count("hashpartitioning(animal") >= 1 and plan.count("hashpartitioning(snp") == 0
    z.unpersist()


def test_year_files_fill_once_and_number_only_their_rows(spark, monkeypatch):
    """Rows with a known season are not moved to be filled, the others are filled once and stored; rows that no file has are not joined with numbers."""
    records = spark.range(600).selectExpr(
        "id as rec_a", "id % 3 as rec_b", "concat('F', id % 2) as farm_id", "if(id % 50 = 0, null, id % 40) as temp_id", "2000 + id % 3 as year",
        "if(id % 31 = 0, null, date_add(date'2000-01-01', cast(id % 90 as int))) as score_date", "id % 5 as score",
        "case when id % 7 = 0 then null when id % 2 = 0 then 'SPRING' else 'FALL' end as season", "if(id % 11 = 0, null, id % 12) as age", "if(id % 9 = 0, 'M', 'F') as sex",
        "'AN' as breed_code", "'R' as registration_number", "'A' as animal_id",
    )
    stored = []
    monkeypatch.setattr(W, "cut_lineage", lambda df: stored.append(df.count()) or cut_lineage(df))
    rows = M.prepare_females(records, M.GroupRules())
    females = records.filter("sex = 'F'")
    assert stored == [females.filter("season is null").count()]
    want = W.fill_downup(females, ["farm_id", "temp_id"], ["score_date", "rec_a", "rec_b"], ["season"])
    want = want.withColumn("season", R.season_default("farm_id", F.lit(None).cast("date"), "season", M.GroupRules().season_by_herd))
    assert sorted(map(str, rows.select(want.columns).collect())) == sorted(map(str, want.collect()))
    ped = records.selectExpr("farm_id", "temp_id", "concat('P', farm_id, temp_id) as full_reg").filter("temp_id is not null").distinct()
    out = M.year_files(records, ped, ped.filter("temp_id < 9").selectExpr("full_reg", "temp_id as iid"), ["score_date", "rec_a", "rec_b", "farm_id"])
    codes = {r.cg: r.code for r in O.dense_code(M.contemporary_groups(records, M.GroupRules(min_size=1, varying=False)).select("cg").distinct(), "cg").collect()}
    got = out.collect()
    assert got and {r.cg_num for r in got} <= set(codes.values()) and len({(r.full_reg, r.year) for r in got}) == len(got)
    top = out._jdf.queryExecution().optimizedPlan().toString()
    assert top.index("cg_num") < top.index("Window")
