"""Aggregations, tallies and group filters."""

from pyspark.sql import functions as F

from herdframe.catalog.base import query
from herdframe.functions.base import r6, row_sum
from herdframe.functions.stats import corr_or_null
from herdframe.operators import aggregates as A


@query("E1_tally", "select farm_id, year, count(*) as n from records group by all")
def _(t):
    return A.tally(t.records, ["farm_id", "year"])


@query(
    "E1_add_count",
    "select rec_a, rec_b, farm_id, temp_id, score_date, count(*) over (partition by farm_id, temp_id) as n from records",
)
def _(t):
    out = A.add_count(t.records, ["farm_id", "temp_id"])
    return out.select("rec_a", "rec_b", "farm_id", "temp_id", "score_date", "n")


@query(
    "E2_summarise",
    """select chr, count(p) as n, round(min(p), 6) as min, round(avg(p), 6) as mean, round(median(p), 6) as median,
       round(max(p), 6) as max, round(stddev_samp(p), 6) as sd from gwas group by chr""",
)
def _(t):
    out = A.summarise(t.gwas, ["chr"], "p")
    return out.select("chr", "n", *[r6(c).alias(c) for c in ("min", "mean", "median", "max", "sd")])


@query(
    "E2_global_median",
    "select count(*) as n, round(median(l_extendedprice), 6) as median, round(stddev_samp(l_extendedprice), 4) as sd from lineitem",
)
def _(t):
    out = A.summarise(t.lineitem, [], "l_extendedprice")
    return out.select("n", r6("median").alias("median"), r6("sd", 4).alias("sd"))


@query(
    "E3_n_distinct",
    """select farm_id, count(distinct season) + max(cast(season is null as int)) as seasons,
       count(distinct (temp_id, year)) as animal_years from records group by farm_id""",
)
def _(t):
    out = A.distinct_values(t.records, ["farm_id"], {"seasons": "season"})
    pairs = t.records.groupBy("farm_id").agg(F.count_distinct("temp_id", "year").alias("animal_years"))
    return out.join(pairs, "farm_id")


@query(
    "E4_group_size",
    """select rec_a, rec_b, farm_id, temp_id, score_date, score from records
       qualify count(*) over (partition by farm_id, temp_id, year) between 2 and 4""",
)
def _(t):
    out = A.keep_group_size(t.records, ["farm_id", "temp_id", "year"], 2, 4)
    return out.select("rec_a", "rec_b", "farm_id", "temp_id", "score_date", "score")


@query(
    "E5_varying_groups",
    """select rec_a, rec_b, farm_id, temp_id, score_date, score from records
       qualify var_samp(score) over (partition by farm_id, temp_id) <> 0""",
)
def _(t):
    out = A.keep_varying(t.records, ["farm_id", "temp_id"], "score")
    return out.select("rec_a", "rec_b", "farm_id", "temp_id", "score_date", "score")


@query(
    "E6_find_dup",
    """select * from (select c_custkey, c_nationkey, c_mktsegment from customer) where c_nationkey is not null
       qualify count(*) over (partition by c_nationkey, c_mktsegment) > 1""",
)
def _(t):
    rows = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return A.find_dup(rows, ["c_nationkey", "c_mktsegment"]).orderBy("c_nationkey", "c_mktsegment", "c_custkey")


@query(
    "E7_key_report",
    """with d as (select case when l_orderkey % 9 = 0 then null else l_partkey end as lab_id, l_orderkey as animal_id,
                         case when l_suppkey % 4 = 0 then null else l_suppkey end as barcode from lineitem)
       select 'Missing lab_id' as error, cast(count(*) filter (where lab_id is null) as bigint) as n from d
       union all select 'Duplicate animal', coalesce(cast(sum(c) as bigint), 0) from
         (select count(*) as c from d group by animal_id having count(*) > 1)
       union all select 'Duplicate barcode', coalesce(cast(sum(c) as bigint), 0) from
         (select count(*) as c from d where barcode is not null group by barcode having count(*) > 1)""",
)
def _(t):
    d = t.lineitem.select(
        F.when(F.col("l_orderkey") % 9 != 0, F.col("l_partkey")).alias("lab_id"),
        F.col("l_orderkey").alias("animal_id"),
        F.when(F.col("l_suppkey") % 4 != 0, F.col("l_suppkey")).alias("barcode"),
    )
    return A.key_report(d, "lab_id", {"animal_id": "Duplicate animal", "barcode": "Duplicate barcode"})


@query(
    "E8_consistent",
    """select rec_a, rec_b, farm_id, temp_id, score_date, season from records
       window w as (partition by farm_id, temp_id)
       qualify (min(season) over w = max(season) over w and count(season) over w = count(*) over w)
            or count(season) over w = 0""",
)
def _(t):
    out = A.keep_consistent(t.records, ["farm_id", "temp_id"], "season")
    return out.select("rec_a", "rec_b", "farm_id", "temp_id", "score_date", "season")


@query(
    "E9_any_flag",
    """select rec_a, rec_b, farm_id, temp_id, score_date, bool_or(score = 5) over (partition by farm_id, temp_id) as sold
       from records""",
)
def _(t):
    rows = t.records.withColumn("sold", F.col("score") == 5)
    return A.any_flag(rows, ["farm_id", "temp_id"], "sold").select(
        "rec_a", "rec_b", "farm_id", "temp_id", "score_date", "sold"
    )


@query(
    "E10_conflict_constant",
    """select rec_a, rec_b, farm_id, temp_id, score_date,
       case when (select count(distinct coalesce(r.season, '?')) from records r where r.farm_id = records.farm_id
                  and r.temp_id = records.temp_id) > 1 then 'CROS' else season end as season from records""",
)
def _(t):
    out = A.conflict_to(t.records, ["farm_id", "temp_id"], {"season": "CROS"})
    return out.select("rec_a", "rec_b", "farm_id", "temp_id", "score_date", "season")


@query(
    "E11_share_of_total",
    "select chr, count(*) as n, round(count(*) / (select count(*) from gwas), 6) as share from gwas group by chr",
)
def _(t):
    out = A.share_of_total(t.gwas, ["chr"]).orderBy(F.desc("n"), "chr")
    return out.select("chr", "n", r6("share").alias("share"))


@query(
    "E12_correlation",
    """select farm_id, round(corr(score, age), 6) as r, round(covar_samp(score, age), 6) as cov
       from records where age is not null group by farm_id""",
)
def _(t):
    return (
        t.records.filter("age is not null")
        .groupBy("farm_id")
        .agg(r6(corr_or_null("score", "age")).alias("r"), r6(F.covar_samp("score", "age")).alias("cov"))
    )


@query(
    "E12_correlation_matrix",
    """select 'score' as x, 'age' as y, round(corr(score, age), 6) as r from records where age is not null
       union all select 'score', 'year', round(corr(score, year), 6) from records
       union all select 'age', 'year', round(corr(age, year), 6) from records where age is not null""",
)
def _(t):
    out = A.correlation_matrix(t.records, ["score", "age", "year"])
    return out.select("x", "y", r6("r").alias("r"))


@query(
    "E13_regression",
    """select iter, grp, regr_count(solution_full, solution_reduced) as n,
       case when regr_sxx(solution_full, solution_reduced) > 0 then round(regr_slope(solution_full, solution_reduced), 6) end as slope,
       case when regr_sxx(solution_full, solution_reduced) > 0 then round(regr_intercept(solution_full, solution_reduced), 6) end as intercept,
       round(regr_r2(solution_full, solution_reduced), 6) as r2,
       case when count(*) > 2 then round(sqrt((regr_syy(solution_full, solution_reduced) - regr_sxy(solution_full, solution_reduced)
         * regr_sxy(solution_full, solution_reduced) / regr_sxx(solution_full, solution_reduced))
         / (count(*) - 2) / regr_sxx(solution_full, solution_reduced)), 6) end as se
       from evaluations group by iter, grp""",
)
def _(t):
    out = A.simple_regression(t.evaluations, ["iter", "grp"], "solution_full", "solution_reduced")
    return out.select("iter", "grp", "n", *[r6(c).alias(c) for c in ("slope", "intercept", "r2", "se")])


@query(
    "E14_summary_of_slopes",
    """with s as (select iter, grp, case when regr_sxx(solution_full, solution_reduced) > 0 then regr_slope(solution_full, solution_reduced) end as slope
         from evaluations group by iter, grp)
       select grp, round(min(slope), 6) as min, round(avg(slope), 6) as mean, round(max(slope), 6) as max,
       round(stddev_samp(slope), 6) as sd from s group by grp""",
)
def _(t):
    slopes = A.simple_regression(t.evaluations, ["iter", "grp"], "solution_full", "solution_reduced")
    out = A.summary_of(slopes, ["grp"], "slope")
    return out.select("grp", *[r6(c).alias(c) for c in ("min", "mean", "max", "sd")])


@query(
    "E15_joined_list",
    """with d as (select distinct term, chr, start_pos from genes)
       select term, string_agg(chr || ':' || format('{:,}', start_pos), '; ' order by chr, start_pos) as items
       from d group by term""",
)
def _(t):
    from herdframe.functions.text import marker_label

    return A.joined_list(t.genes, ["term"], ["chr", "start_pos"], marker_label("chr", "start_pos"))


@query(
    "E15_ordered_items",
    """with d as (select distinct term, chr, start_pos, chr || ':' || format('{:,}', start_pos) as item from genes)
       select term, row_number() over (partition by term order by chr, start_pos, item)::int as place, item from d""",
)
def _(t):
    from herdframe.functions.text import marker_label

    return A.ordered_items(t.genes, ["term"], ["chr", "start_pos"], marker_label("chr", "start_pos"))


@query(
    "E16_pass_fail",
    """select snp, count(*) filter (where p < 0.5) as n_pass, count(*) filter (where p >= 0.5) as n_fail,
       round(count(*) filter (where p >= 0.5) / count(*), 6) as share_fail from gwas group by snp""",
)
def _(t):
    out = A.pass_fail(t.gwas, ["snp"], "p", 0.5)
    return out.select("snp", "n_pass", "n_fail", r6("share_fail").alias("share_fail"))


@query(
    "E17_missing_counts",
    """select farm_id, count(*) filter (where season is null) as missing_season, count(season) as has_season,
       count(*) filter (where age is null) as missing_age, count(age) as has_age from records group by farm_id""",
)
def _(t):
    return A.missing_counts(t.records, ["farm_id"], ["season", "age"])


@query("E18_distinct", "select distinct farm_id, temp_id, sex from records")
def _(t):
    return t.records.select("farm_id", "temp_id", "sex").distinct()


@query(
    "E19_binned_counts",
    """select cast(floor((p - 0) / 0.025) as bigint) as p_bin, cast(floor((beta + 0.05) / 0.02) as bigint) as beta_bin,
       count(*) as n from gwas group by all""",
)
def _(t):
    return A.binned_counts(t.gwas, {"p_bin": ("p", 0, 0.025), "beta_bin": ("beta", -0.05, 0.02)})


@query(
    "E20_row_sum",
    "select rec_a, rec_b, temp_id, farm_id, score_date, score + coalesce(age, 0) + 0.0::double as total from records",
)
def _(t):
    return t.records.select("rec_a", "rec_b", "temp_id", "farm_id", "score_date", row_sum("score", "age").alias("total"))


@query(
    "E21_group_tallies",
    """with g as (select count(*) as group_size from records group by farm_id, year, season)
       select group_size, count(*) as n_groups from g group by group_size""",
)
def _(t):
    return A.group_size_distribution(t.records, ["farm_id", "year", "season"])


@query(
    "E22_dataset_counts",
    """select farm_id, count(*) as n_records, count(distinct temp_id) as n_animals,
       count(distinct temp_id) filter (where temp_id in (select p_partkey from part where p_size <= 20)) as n_genotyped
       from records group by farm_id""",
)
def _(t):
    genotyped = t.part.filter("p_size <= 20").select(F.col("p_partkey").alias("temp_id"))
    return A.dataset_counts(t.records, "farm_id", "temp_id", genotyped)
