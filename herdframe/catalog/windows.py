"""Fills, ranks, runs, samples, and set operations."""

from pyspark.sql import functions as F

from herdframe.catalog.base import query
from herdframe.functions.base import r6
from herdframe.operators import gwas as G
from herdframe.operators import ordered as O
from herdframe.operators import windows as W

ROW = ["rec_a", "rec_b", "temp_id", "farm_id", "score_date"]


@query(
    "F1_fill_downup",
    """select rec_a, rec_b, temp_id, farm_id, score_date,
       coalesce(last_value(season ignore nulls) over (w rows between unbounded preceding and current row),
                first_value(season ignore nulls) over (w rows between current row and unbounded following)) as season
       from records window w as (partition by temp_id order by score_date, rec_a, rec_b, farm_id)""",
)
def _(t):
    out = W.fill_downup(t.records, ["temp_id"], ["score_date", "rec_a", "rec_b", "farm_id"], ["season"])
    return out.select(*ROW, "season")


@query(
    "F2_keep_first",
    """select rec_a, rec_b, temp_id, farm_id, score_date, age from records
       qualify row_number() over (partition by temp_id order by age desc nulls last, score_date, rec_a, rec_b, farm_id) = 1""",
)
def _(t):
    order = [F.desc_nulls_last("age"), "score_date", "rec_a", "rec_b", "farm_id"]
    out = W.keep_first(t.records, ["temp_id"], [F.col(c) if isinstance(c, str) else c for c in order])
    return out.select(*ROW, "age")


@query(
    "F3_top_with_ties",
    """select rec_a, rec_b, temp_id, farm_id, score_date from records
       qualify rank() over (partition by farm_id order by score_date desc) <= 30""",
)
def _(t):
    return W.top_with_ties(t.records, ["farm_id"], "score_date", 30).select(*ROW)


@query("F3_lead_snps", "select snp, study, chr, pos, round(p, 9) as p from gwas where p = (select min(p) from gwas)")
def _(t):
    best = t.gwas.agg(F.min("p").alias("p"))
    return t.gwas.filter(F.col("p") == best.scalar()).select("snp", "study", "chr", "pos", r6("p", 9).alias("p"))


@query(
    "F4_nearest_in_time",
    """select rec_a, rec_b, temp_id, farm_id, score_date, year from records
       qualify row_number() over (partition by farm_id, temp_id, year
         order by abs(date_diff('day', make_date(year, 5, 1), score_date)), score_date, rec_a, rec_b) = 1""",
)
def _(t):
    may = F.make_date(F.col("year").cast("int"), F.lit(5), F.lit(1))
    ties = [F.col(c) for c in ("score_date", "rec_a", "rec_b")]
    return W.nearest_in_time(t.records, ["farm_id", "temp_id", "year"], "score_date", may, ties).select(*ROW, "year")


@query(
    "F5_lag_distance",
    """with d as (select distinct study, chr, pos, snp from gwas),
       l as (select study, chr, pos, snp, lag(pos) over (partition by study, chr order by pos, snp) as lag from d)
       select study, chr, pos, snp, lag, pos - lag as dist, pos - lag >= 1000 as far from l""",
)
def _(t):
    spots = t.gwas.select("study", "chr", "pos", "snp").distinct()
    out = W.previous_position(spots, ["study", "chr"], "pos", ["snp"])
    dist = F.col("pos") - F.col("lag")
    return out.select("study", "chr", "pos", "snp", "lag", dist.alias("dist"), (dist >= 1000).alias("far"))


@query(
    "F6_runs",
    """with s as (select distinct chr, pos from gwas), l as (select chr, pos, lag(pos) over (partition by chr order by pos) as q from s),
       n as (select chr, pos, sum(case when q is null or pos - q > 150 then 1 else 0 end) over (partition by chr order by pos) as run from l)
       select chr, cast(run as bigint) as run, min(pos) as start_pos, max(pos) as end_pos, count(*) as n_pos from n group by chr, run""",
)
def _(t):
    return W.runs(t.gwas, ["chr"], "pos", 150)


@query(
    "F6_runs_without_last",
    """with s as (select distinct chr, pos from gwas), l as (select chr, pos, lag(pos) over (partition by chr order by pos) as q from s),
       n as (select chr, pos, sum(case when q is null or pos - q > 150 then 1 else 0 end) over (partition by chr order by pos) as run from l),
       g as (select chr, cast(run as bigint) as run, min(pos) as start_pos, max(pos) as end_pos, count(*) as n_pos from n group by chr, run)
       select * from g qualify start_pos <> lead(start_pos) over (partition by chr order by start_pos)""",
)
def _(t):
    return W.runs(t.gwas, ["chr"], "pos", 150, keep_last=False)


@query(
    "F7_cumulative_position",
    """with c as (select chr, max(pos) as len from gwas group by chr),
       o as (select chr, cast(coalesce(sum(len) over (order by chr rows between unbounded preceding and 1 preceding), 0) as bigint) as off from c)
       select g.chr, g.pos, g.snp, g.study, g.pos + o.off as pos_cum from gwas g join o on g.chr = o.chr""",
)
def _(t):
    return G.cumulative_position(t.gwas).select("chr", "pos", "snp", "study", "pos_cum")


@query(
    "F7_axis_centres",
    """with c as (select chr, min(pos) as lo, max(pos) as len from gwas group by chr)
       select chr, coalesce(sum(len) over (order by chr rows between unbounded preceding and 1 preceding), 0) + (lo + len) / 2.0::double as centre from c""",
)
def _(t):
    return G.axis_centres(t.gwas)


@query(
    "F8_dense_code",
    """with d as (select distinct p_name from part), c as (select p_name, row_number() over (order by md5(p_name), p_name) as code from d)
       select p_partkey, p.p_name, code from part p join c on p.p_name = c.p_name""",
)
def _(t):
    return O.dense_code(t.part.select("p_partkey", "p_name"), "p_name")


@query(
    "F8_dense_code_by_herd",
    """with d as (select distinct farm_id, temp_id from records),
       c as (select farm_id, temp_id, row_number() over (partition by farm_id order by md5(temp_id::varchar), temp_id) as code from d)
       select r.rec_a, r.rec_b, r.temp_id, r.farm_id, r.score_date, code from records r
       join c on r.farm_id = c.farm_id and r.temp_id = c.temp_id""",
)
def _(t):
    return O.dense_code(t.records, "temp_id", ["farm_id"]).select(*ROW, "code")


@query(
    "F9_row_ids",
    """select o_orderkey, row_number() over (order by md5(o_orderkey::varchar || '|'), o_orderkey) as row_id from orders""",
)
def _(t):
    return O.row_ids(t.orders.select("o_orderkey"), ["o_orderkey"])


@query(
    "F10_qq_points",
    """with r as (select study, p, row_number() over (partition by study order by p) as rank, count(*) over (partition by study) as m
                  from gwas where p > 0 and p < 1)
       select study, rank, round(-log10(p), 6) as observed,
       round(-log10((rank - case when m <= 10 then 0.375 else 0.5 end::double)
         / (m + 1 - 2 * case when m <= 10 then 0.375 else 0.5 end::double)), 6) as expected from r""",
)
def _(t):
    out = G.qq_points(t.gwas, "p", ["study"])
    return out.select("study", "rank", r6("observed").alias("observed"), r6("expected").alias("expected"))


@query("F11_sort_nulls_last", "select rec_a, rec_b, temp_id, farm_id, score_date, age, season from records")
def _(t):
    order = [F.asc_nulls_last("season"), F.desc_nulls_last("age"), *[F.col(c) for c in ROW]]
    return t.records.select(*ROW, "age", "season").orderBy(*order)


@query(
    "F12_random_one",
    """select rec_a, rec_b, temp_id, farm_id, score_date from records qualify row_number() over (partition by temp_id
       order by md5(concat_ws('|', rec_a, rec_b, temp_id, farm_id, score_date, 's1')), rec_a, rec_b, temp_id, farm_id, score_date) = 1""",
)
def _(t):
    return W.random_one(t.records, ["temp_id"], ROW, "s1").select(*ROW)


@query(
    "F12_sample_fraction",
    """with k as (select distinct temp_id from records), r as (select temp_id, row_number() over
         (order by md5(concat_ws('|', temp_id, 's1')), temp_id) as n from k)
       select temp_id from r where n <= (select round(count(*) * 0.25) from k)""",
)
def _(t):
    return W.sample_fraction(t.records, "temp_id", 0.25, "s1")


@query(
    "F13_date_window",
    """with r as (select distinct farm_id, score_date from records),
       w as (select farm_id, score_date, cast(unnest(generate_series(score_date - 59, score_date, interval 1 day)) as date) as value from r)
       select farm_id, value, count(*) as n, min(score_date) as first_date from w group by farm_id, value""",
)
def _(t):
    days = W.date_window(t.records.select("farm_id", "score_date").distinct(), "score_date", 60)
    return days.groupBy("farm_id", "value").agg(F.count(F.lit(1)).alias("n"), F.min("score_date").alias("first_date"))


@query(
    "F14_trailing_mean",
    """with r as (select user_id, cast(ts as date) as day, value from events qualify rank() over (partition by user_id order by cast(ts as date) desc) <= 30)
       select user_id, round(avg(value), 9) as mean_value from r group by user_id""",
)
def _(t):
    rows = t.events.withColumn("day", F.col("ts").cast("date"))
    out = W.trailing_mean(rows, ["user_id"], "day", 30, {"mean_value": "value"})
    return out.select("user_id", r6("mean_value", 9).alias("mean_value"))


@query(
    "F14_trailing_lookup",
    """with d as (select distinct c_custkey % 50 as user_id, date '2023-12-25' + (c_custkey % 61)::int as date from customer), s as (select user_id % 50 as user_id, cast(ts as date) as day, value from events),
       j as (select d.user_id, d.date, value from d join s on d.user_id = s.user_id and day <= date and day > date - 12 qualify rank() over (partition by d.user_id, d.date order by day desc) <= 7)
       select user_id, d.date, round(avg(value), 6) as mean_value from d left join j using (user_id, date) group by all""",
)
def _(t):
    dates = t.customer.select((F.col("c_custkey") % 50).alias("user_id"), F.date_add(F.lit("2023-12-25").cast("date"), (F.col("c_custkey") % 61).cast("int")).alias("date"))
    series = t.events.select((F.col("user_id") % 50).alias("user_id"), F.col("ts").cast("date").alias("day"), "value")
    out = W.trailing_lookup(dates, series, ["user_id"], "date", "day", 7, {"mean_value": "value"}, 12)
    return out.select("user_id", "date", r6("mean_value").alias("mean_value"))


@query("F15_chromosome_class", "select chr, case when chr % 2 = 1 then 'odd' else 'even' end as chr_class, count(*) as n from gwas group by all")
def _(t):
    return t.gwas.groupBy("chr", G.chromosome_class().alias("chr_class")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "F16_impute_age",
    """with k as (select temp_id, year, min(age) as age from records where age is not null group by all having min(age) = max(age)),
       b as (select temp_id, arg_min(year - age, year) as birth from k group by temp_id)
       select r.rec_a, r.rec_b, r.temp_id, r.farm_id, r.score_date,
       coalesce(r.age, case when coalesce(k.age, r.year - b.birth) > 0 then coalesce(k.age, r.year - b.birth) end) as age
       from records r left join k on r.temp_id = k.temp_id and r.year = k.year left join b on r.temp_id = b.temp_id""",
)
def _(t):
    return W.impute_age(t.records, ["temp_id"]).select(*ROW, "age")


@query("G1_union_all", "select c_nationkey as k from customer union all select s_nationkey from supplier")
def _(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).unionByName(t.supplier.select(F.col("s_nationkey").alias("k")))


@query("G2_union_distinct", "select o_custkey as k from orders union select c_custkey from customer")
def _(t):
    a, b = t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k"))
    return a.unionByName(b).distinct()


@query("G3_difference", "select c_custkey as k from customer except select o_custkey from orders where o_orderpriority = '1-URGENT' and o_orderstatus <> 'O'")
def _(t):
    some = t.orders.filter("o_orderpriority = '1-URGENT' and o_orderstatus <> 'O'").select(F.col("o_custkey").alias("k"))
    return t.customer.select(F.col("c_custkey").alias("k")).join(some, "k", "left_anti")


@query("G4_intersection", "select l_partkey as k from lineitem intersect select p_partkey from part where p_size > 25")
def _(t):
    parts = t.part.filter("p_size > 25").select(F.col("p_partkey").alias("k"))
    return parts.join(t.lineitem.select(F.col("l_partkey").alias("k")), "k", "left_semi").distinct()
