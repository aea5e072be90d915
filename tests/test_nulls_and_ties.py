"""Null, tie and type traps on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from herdframe.functions import records as R
from herdframe.functions import text as X
from herdframe.functions.base import if_else3, n_distinct, text_key
from herdframe.operators import aggregates as A
from herdframe.operators import checks as K
from herdframe.operators import joins as J
from herdframe.operators import windows as W
from herdframe.operators.keys import null_safe_join


def rows(df, *cols):
    return sorted([tuple(r) for r in (df.select(*cols) if cols else df).collect()], key=str)


def test_null_keys_match_null_keys(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("y", 20)], "k string, b int")
    assert rows(null_safe_join(a, b, ["k"]), "k", "a", "b") == sorted([("x", 2, None), (None, 1, 10)], key=str)
    full = null_safe_join(a, b, ["k"], "full")
    assert rows(full, "k", "a", "b") == sorted([(None, 1, 10), ("x", 2, None), ("y", None, 20)], key=str)


def test_text_key_writes_na(spark):
    d = spark.createDataFrame([("a", None), ("b", 1)], "x string, y int")
    assert rows(d.select(text_key("x", "y"))) == [("aNA",), ("b1",)]


def test_three_valued_choice(spark):
    d = spark.createDataFrame([(1,), (9,), (None,)], "x int")
    assert rows(d.select("x", if_else3(F.col("x") > 5, "hi", "lo"))) == sorted([(1, "lo"), (9, "hi"), (None, None)], key=str)


def test_distinct_counts_null_as_value(spark):
    d = spark.createDataFrame([(1, None), (1, "a"), (2, "a"), (3, None)], "k int, v string")
    assert rows(d.groupBy("k").agg(n_distinct("v").alias("n"))) == [(1, 2), (2, 1), (3, 1)]


def test_consistent_groups(spark):
    d = spark.createDataFrame([(1, "F"), (1, "M"), (2, None), (2, None), (3, "F"), (3, None), (4, "M")], "k int, s string")
    assert {r.k for r in A.keep_consistent(d, ["k"], "s").collect()} == {2, 4}


def test_conflicts_become_constants(spark):
    d = spark.createDataFrame([(1, "A"), (1, "B"), (2, "A"), (2, None), (3, None), (4, "C")], "k int, v string")
    out = rows(A.conflict_to(d, ["k"], {"v": "0"}), "k", "v")
    assert out == sorted([(1, "0"), (1, "0"), (2, "0"), (2, "0"), (3, None), (4, "C")], key=str)


def test_multi_match_keeps_largest_or_open(spark):
    d = spark.createDataFrame(
        [("a", 1, False), ("a", 5, False), ("b", 2, False), ("b", 7, True), ("c", None, False), ("c", 3, False), ("d", 4, True)],
        "k string, lab int, bulk boolean",
    )
    out = rows(J.resolve_multi_match(d, ["k"], "lab", "bulk"), "k", "lab")
    assert out == sorted([("a", 5), ("b", 2), ("c", None), ("d", 4)], key=str)


def test_top_with_ties_keeps_all_ties(spark):
    d = spark.createDataFrame([("a", i % 5, i) for i in range(20)], "k string, v int, i int")
    assert W.top_with_ties(d, ["k"], "v", 5).count() == 8  # ranks 1 (x4) and 5 (x4)


def test_fill_uses_before_then_after(spark):
    day = lambda n: dt.date(2020, 1, n)
    d = spark.createDataFrame(
        [("a", day(1), None), ("a", day(2), "x"), ("a", day(3), None), ("a", None, None), ("b", day(1), None), (None, day(1), "q"), (None, day(2), None)],
        "k string, d date, v string",
    )
    out = {(r.k, r.d): r.v for r in W.fill_downup(d, ["k"], ["d"], ["v"]).collect()}
    assert out == {
        ("a", day(1)): "x", ("a", day(2)): "x", ("a", day(3)): "x", ("a", None): "x", ("b", day(1)): None,
        (None, day(1)): "q", (None, day(2)): "q",
    }


def test_fill_is_idempotent(spark):
    d = spark.range(300).select((F.col("id") % 7).alias("k"), (F.col("id") % 31).alias("d"), F.when(F.col("id") % 5 == 0, F.col("id")).alias("v"), "id")
    once = W.fill_downup(d, ["k"], ["d", "id"], ["v"])
    assert rows(once, "id", "v") == rows(W.fill_downup(once, ["k"], ["d", "id"], ["v"]), "id", "v")


def test_cascade_equals_iterated_search(spark):
    reg = spark.createDataFrame(
        [(1, "R1", "B9", None), (2, "R2", "B2", "R7"), (3, "R2", None, "R8"), (4, None, "B3", "R3")], "lab int, reg string, ref2 string, ref3 string"
    )
    src = spark.createDataFrame(
        [(1, "R1", "B2"), (2, "R2", None), (3, None, "B3"), (4, "R8", "B2"), (5, "R9", None), (6, None, None), (7, "R3", "B9")], "i int, rn string, bc string"
    )
    steps = [("rn", reg, "reg"), ("bc", reg, "ref2"), ("rn", reg, "ref3")]
    one = J.id_cascade(src, steps, "lab")
    many = src
    for column, search, search_col in steps:
        many = J.id_search(many, column, search, search_col, "lab")
    assert rows(one, "i", "lab") == rows(many, "i", "lab")
    assert rows(one.filter("i = 2"), "lab") == [(2,), (3,)]


def test_verify_raises_on_unknown(spark):
    d = spark.createDataFrame([(1,), (None,)], "x int")
    with pytest.raises(Exception, match="row violates"):
        K.verify(d, F.col("x") > 0, "positive").collect()
    with pytest.raises(K.CheckFailed):
        K.verify(d, F.col("x") > 0, "positive", mode="action")
    with pytest.raises(K.CheckFailed):
        K.verify_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def test_age_class_edges(spark):
    days = [273, 274, 275, 639, 640, 1004, 1005, 7574, 7575, 7939, 7940]
    d = spark.createDataFrame([(x,) for x in days], "d int").select("d", R.age_class("d").alias("c"))
    assert [r.c for r in d.orderBy("d").collect()] == [None, 1, 1, 1, 2, 2, 3, 20, 21, 21, None]


def test_age_texts(spark):
    d = spark.createDataFrame(
        [("3 YEARS", None), ("5/1/2016", None), ("42491", None), ("x", None), ("9", dt.date(2015, 5, 1))], "raw string, dob date"
    ).withColumns({"on": F.lit("2018-05-01").cast("date"), "y": F.lit(2018)})
    out = {r.raw: r.days for r in d.select("raw", R.age_in_days("on", "dob", "raw", "y").alias("days")).collect()}
    assert out == {"3 YEARS": None, "5/1/2016": 730, "42491": 730, "x": None, "9": 1096}


def test_breed_fractions(spark):
    texts = ["PB AR", "3/4 AR 1/4 SM", "12.5% AR", "100% AR", "1/2 SM", None]
    d = spark.createDataFrame([(t,) for t in texts], "t string").select("t", R.fraction_of("t", "AR").alias("f"))
    assert {r.t: r.f for r in d.collect()} == {"PB AR": 1.0, "3/4 AR 1/4 SM": 0.75, "12.5% AR": 0.125, "100% AR": 1.0, "1/2 SM": None, None: None}


def test_padding_never_cuts(spark):
    d = spark.createDataFrame([("7",), ("12345",), (None,)], "x string").select(X.pad_left("x", 4).alias("p"))
    assert sorted([r.p for r in d.collect()], key=str) == ["0007", "12345", None]


def test_impute_age(spark):
    d = spark.createDataFrame(
        [("a", 2016, None), ("a", 2018, 5), ("a", 2020, None), ("b", 2016, 2), ("b", 2016, 3), ("b", 2017, None), ("c", 2010, None), ("c", 2016, 2)],
        "k string, year int, age int",
    )
    out = {(r.k, r.year, r.age) for r in W.impute_age(d, ["k"]).collect()}
    assert out == {("a", 2016, 3), ("a", 2018, 5), ("a", 2020, 7), ("b", 2016, 2), ("b", 2016, 3), ("b", 2017, None), ("c", 2010, None), ("c", 2016, 2)}


def test_nest_slices_large_groups(spark):
    from herdframe.operators.shape import nest, unnest

    d = spark.range(100).select((F.col("id") % 3).alias("k"), "id", F.lit("x").alias("t"))
    out = nest(d, ["k"], ["id", "t"], rows=7)
    assert out.count() > 3 and out.agg(F.sum(F.size("data"))).first()[0] == 100
    assert rows(unnest(out), "k", "id") == rows(d, "k", "id")
    assert nest(d, ["k"], ["id", "t"]).count() == 3


def test_logs_in_one_file_or_many_and_in_parts(spark, tmp_path):
    from herdframe.sources import logs as L

    body = lambda k: ["", f" Genetic variance(s) for effect   2", f"  {k}   0.5", f" 0.5  {k + 1}", "x" * 50, f" -2logL = {k} : AIC = {k + 2}", " -2logL =  1 : AIC = 9"]
    (tmp_path / "one").mkdir()
    for k in range(3):
        (tmp_path / "one" / f"model{k}.log").write_text("\n".join(body(k)) + "\n")
    (tmp_path / "many").mkdir()
    for f in range(2):
        text = ["before any run"] + [x for k in range(40) for x in [f"run f{f}k{k}", *body(k)]] + [" Genetic variance(s) for effect 2"]
        (tmp_path / "many" / f"all{f}.txt").write_text("\n".join(text))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        for path, marker, runs in (("one", None, {f"model{k}": k for k in range(3)}), ("many", r"^run (\w+)$", {f"f{f}k{k}": k for f in range(2) for k in range(40)})):
            folder = str(tmp_path / path)
            lines = L.log_lines(spark, folder, marker)
            assert lines.groupBy("file").agg((F.max("at") == F.count("at")).alias("x")).filter("not x").isEmpty()
            assert {r.run: (r.aic, r.neg2logl) for r in L.extract_fit_metrics(spark, folder, marker).collect()} == {r: (9.0, 1.0) for r in runs}
            cells = {(r.run, r.val1, r.val2): r.var_cov for r in L.extract_var_blocks(spark, folder, {"2": ["a", "b"]}, marker).collect()}
            assert cells == {(r, x, y): (0.5 if x != y else k + (x == "b")) for r, k in runs.items() for x in "ab" for y in "ab"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_trailing_means_by_lookup(spark):
    import random

    rng = random.Random(3)
    day = lambda k: dt.date(2020, 1, 1) + dt.timedelta(days=k)
    series = [(rng.choice("abc"), day(rng.randrange(0, 90)), rng.choice([None, -1.5, 2.25, 7.125])) for _ in range(300)] + [(None, day(3), 9.0), ("a", None, 9.0)]
    dates = [(k, day(x)) for k in "abd" for x in range(-3, 130, 4)] * 2 + [(None, day(5)), ("a", None)]
    s = spark.createDataFrame(series, "k string, day date, v double")
    d = spark.createDataFrame(dates, "k string, date date")
    for n, within in ((1, None), (6, None), (6, 10), (50, 30)):
        got = {(r.k, r.date): r.m for r in W.trailing_lookup(d, s, ["k"], "date", "day", n, {"m": "v"}, within).collect()}
        want = {}
        for k, at in dates:
            if k is None or at is None:
                continue
            rows = sorted((x[1] for x in series if x[0] == k and x[1] and x[1] <= at and (within is None or x[1] > at - dt.timedelta(days=within))), reverse=True)
            kept = [x[2] for x in series if x[0] == k and x[1] and rows and rows[min(n, len(rows)) - 1] <= x[1] <= at and x[2] is not None]
            want[k, at] = sum(kept) / len(kept) if kept else None
        assert got == pytest.approx(want)


def test_places_in_groups_that_run_over_tasks(spark):
    from herdframe.operators.ranks import numbered

    d = spark.range(3000).select(F.when(F.col("id") < 2000, "a").when(F.col("id") % 2 == 0, "b").alias("k"), (F.col("id") * 37 % 500).alias("v"), "id")
    out = numbered(d, ["k"], ["v"], "place")
    assert out.columns == ["k", "v", "id", "place"] and out.count() == 3000
    for k in ("a", "b", None):
        got = [(r.place, r.v) for r in out.filter(F.col("k").eqNullSafe(F.lit(k))).orderBy("place").collect()]
        assert [p for p, _ in got] == list(range(1, len(got) + 1)) and [v for _, v in got] == sorted(v for _, v in got)
    whole = numbered(d, [], ["v", "id"], "place").collect()
    assert [(r.v, r.id) for r in sorted(whole, key=lambda r: r.place)] == sorted((r.v, r.id) for r in whole)


def test_genotype_lines_are_written_in_chunks(spark, tmp_path):
    from herdframe.operators.shape import dosage_chunks, dosage_to_string
    from herdframe.sources.writers import write_fixed_width

    calls = [(a, s, None if (a + s) % 7 == 0 else (a * s) % 3) for a in range(30) for s in range(500) if (a * s) % 11]
    d = spark.createDataFrame(calls, "animal long, snp long, dosage int")
    want = {a: "".join(str(5 if x is None else x) for _, _, x in sorted(c for c in calls if c[0] == a)) for a in {c[0] for c in calls}}
    chunks = dosage_chunks(d, size=64)
    assert chunks.agg(F.max(F.length("genotype"))).first()[0] <= 64 and chunks.groupBy("animal").count().filter("count < 2").isEmpty()
    assert {r.animal: r.genotype for r in dosage_to_string(d, size=64).collect()} == want
    path = str(tmp_path / "fixed")
    write_fixed_width(d, path, 12)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert sorted(lines) == sorted(f"{a:<12} {g}" for a, g in want.items())
    assert not [f for f in (tmp_path / "fixed").iterdir() if f.name.startswith(".") and f.suffix == ".txt"]
