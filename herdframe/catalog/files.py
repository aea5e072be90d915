"""Sources and sinks: the given tables are written in the outside format, read back, and compared with themselves."""

from pyspark.sql import functions as F

from herdframe.catalog.base import query
from herdframe.functions.base import r6
from herdframe.operators import shape as P
from herdframe.session import fresh_path
from herdframe.sources import logs as L
from herdframe.sources import readers as R
from herdframe.sources import writers as Wr


def put_text(df, spark, label, *cols, sep="  "):
    """Write columns as text lines and give the path."""
    path = fresh_path(spark, label)
    df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in cols]).alias("value")).write.text(path)
    return path


@query("A1_read_ws", "select c_custkey, c_acctbal, c_mktsegment from customer")
def _(t):
    path = put_text(t.customer, t.spark, "ws", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return R.read_ws(t.spark, path, [("c_custkey", "bigint"), None, ("c_acctbal", "double"), ("c_mktsegment", "string")])


@query(
    "A2_read_csv",
    "select p_partkey, case when p_size > 40 then null else p_size end as p_size, p_name from part",
)
def _(t):
    path = fresh_path(t.spark, "csv")
    d = t.part.select("p_partkey", F.when(F.col("p_size") <= 40, F.concat(F.lit(" "), "p_size")).otherwise(".").alias("p_size"), "p_name")
    d.write.option("header", True).csv(path)
    return R.read_delimited(t.spark, path, "p_partkey bigint, p_size int, p_name string", na=".")


@query(
    "A3_scan_record_files",
    """select 'F' || (o_custkey % 3) as farm_id, cast(2016 + o_orderkey % 4 as int) as year, o_custkey::varchar as animal_id, o_orderdate::date as score_date,
       substr(o_orderpriority, 1, 1) as score, case when o_orderstatus = 'O' then 'YES' end as sold, count(*) as n from orders group by all""",
)
def _(t):
    base = fresh_path(t.spark, "records")
    name = F.concat(F.lit("Records_F"), F.col("o_custkey") % 3, F.lit("_"), 2016 + F.col("o_orderkey") % 4)
    t.orders.select(
        F.col("o_custkey").alias("Animal ID"), F.col("o_orderdate").cast("date").alias("Score Date"),
        F.substring("o_orderpriority", 1, 1).alias("Score"), F.when(F.col("o_orderstatus") == "O", "YES").alias("Sold_2017"), name.alias("file"),
    ).write.partitionBy("file").option("header", True).csv(base)
    out = R.scan_record_files(
        t.spark, base, ["Animal ID", "Score Date", "Score", "Sold_2017"], name_pattern=r"(?<=file=)[^/]+"
    )
    return out.groupBy("farm_id", "year", "animal_id", "score_date", "score", "sold").agg(F.count(F.lit(1)).alias("n"))


@query("A4_exclude_sources", "select rec_a, rec_b, temp_id, farm_id, score_date from records where not (farm_id = 'F3' and year = 1995) and not (farm_id = 'F7' and year = 1996)")
def _(t):
    return R.exclude_sources(t.records, ["F3_1995", "F7_1996"]).select("rec_a", "rec_b", "temp_id", "farm_id", "score_date")


@query("A5_add_missing", "select c_custkey, c_name, cast(null as varchar) as barcode from customer")
def _(t):
    return P.add_missing_columns(t.customer.select("c_custkey", "c_name"), {"c_name": "string", "barcode": "string"})


@query(
    "A6_union_drifting",
    "select c_custkey as k, c_name as name, c_mktsegment as seg, null::varchar as brand from customer union all select p_partkey, p_name, null, p_brand from part",
)
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    b = t.part.select(F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), F.col("p_partkey").alias("k"))
    return P.union_drifting([a, b])


@query("A7_clean_names", "select s_suppkey as supplier_key, s_name as sold, s_acctbal as acct_bal_percent from supplier")
def _(t):
    d = t.supplier.select(F.col("s_suppkey").alias("Supplier Key"), F.col("s_name").alias("Sold_2017."), F.col("s_acctbal").alias("AcctBal%"))
    return P.clean_names(d, bare=["sold"])


@query("A8_remove_empty", "select case when c_nationkey > 10 then c_custkey end as k, case when c_nationkey > 10 then c_name end as n from customer where c_nationkey > 10")
def _(t):
    keep = F.col("c_nationkey") > 10
    d = t.customer.select(F.when(keep, F.col("c_custkey")).alias("k"), F.when(keep, F.col("c_name")).alias("n"), F.lit(None).cast("string").alias("gone"))
    return P.remove_empty_cols(P.remove_empty_rows(d))


@query(
    "A9_nested_daily",
    """select event_id, round((cast(json_extract(props, '$.k') as double) - 32) * 5 / 9, 6) as apparent_high, round(8 + (event_id % 8), 6)::double as day_length from events""",
)
def _(t):
    day = F.struct(
        F.get_json_object("props", "$.k").cast("double").alias("apparentTemperatureHigh"),
        F.timestamp_seconds(F.lit(1_600_000_000)).alias("sunriseTime"),
        F.timestamp_seconds(1_600_000_000 + 3600 * (8 + F.col("event_id") % 8)).alias("sunsetTime"),
    )
    out = R.nested_daily(t.events.select("event_id", F.array(day).alias("daily")))
    return out.select("event_id", r6("apparent_high").alias("apparent_high"), r6("day_length").alias("day_length"))


@query("A10_marker_map", "select cast(chr as int) as chr, 'S' || snp as snp, pos from markers")
def _(t):
    d = t.markers.select("chr", F.concat(F.lit("S"), "snp").alias("snp"), F.lit(0).alias("cm"), "pos", F.lit("A").alias("a1"), F.lit("G").alias("a2"))
    path = put_text(d, t.spark, "bim", "chr", "snp", "cm", "pos", "a1", "a2", sep="\t")
    return R.read_marker_map(t.spark, path).select("chr", "snp", "pos")


@query("A10_family", "select 's' || s_suppkey as iid, cast(s_nationkey as int) as sex from supplier")
def _(t):
    d = t.supplier.select(F.lit("f").alias("fid"), F.concat(F.lit("s"), "s_suppkey").alias("iid"), F.lit(0).alias("a"), F.lit(0).alias("b"), "s_nationkey", F.lit(-9).alias("ph"))
    path = put_text(d, t.spark, "fam", "fid", "iid", "a", "b", "s_nationkey", "ph", sep=" ")
    return R.read_family(t.spark, path).select("iid", "sex")


@query("A11_annotation_gtf", "select chr::varchar as chr, start_pos, end_pos, 'G' || gene_id as gene_id, case when gene_id % 2 = 0 then term end as gene_name from genes")
def _(t):
    name = F.when(F.col("gene_id") % 2 == 0, F.concat(F.lit(' gene_name "'), "term", F.lit('";'))).otherwise("")
    attributes = F.concat(F.lit('gene_id "G'), "gene_id", F.lit('";'), name, F.lit(' gene_biotype "protein_coding";'))
    line = F.concat_ws("\t", "chr", F.lit("src"), F.lit("gene"), "start_pos", "end_pos", F.lit("."), F.lit("+"), F.lit("."), attributes)
    path = fresh_path(t.spark, "gtf")
    t.genes.select(line.alias("value")).unionByName(t.spark.createDataFrame([("#!genome-build",)], "value string")).write.text(path)
    return R.read_annotation(t.spark, path, "gtf").select("chr", "start_pos", "end_pos", "gene_id", "gene_name")


@query("A11_annotation_gff", "select chr::varchar as chr, start_pos, 'Q' || gene_id as \"QTL_ID\", term as \"Name\" from genes")
def _(t):
    attributes = F.concat(F.lit("QTL_ID=Q"), "gene_id", F.lit(";Name="), "term", F.lit(";trait_ID=5"))
    line = F.concat_ws("\t", F.concat(F.lit("Chr."), "chr"), F.lit("src"), F.lit("Milk"), "start_pos", "end_pos", F.lit("."), F.lit("."), F.lit("."), attributes)
    path = fresh_path(t.spark, "gff")
    t.genes.select(line.alias("value")).write.text(path)
    return R.read_annotation(t.spark, path, "gff").select("chr", "start_pos", "QTL_ID", "Name")


RUN = r"^run (\S+)$"


def put_logs(t, label, text):
    """Logs of all suppliers, many in each file: a line with the run's name, then the log's lines."""
    path = fresh_path(t.spark, label)
    t.supplier.select(F.concat(F.lit("run m"), "s_suppkey", F.lit("\n"), text).alias("value")).repartition(3).write.text(path)
    return path


@query(
    "A12_fit_metrics",
    "select 'm' || s_suppkey as run, round(s_acctbal + 2, 6) as aic, round(s_acctbal, 6) as neg2logl from supplier",
)
def _(t):
    v = F.col("s_acctbal").cast("decimal(12,2)")
    text = F.concat(F.lit(" start\n   -2logL =    "), F.lit(""), v.cast("string"), F.lit(" : AIC = "), (v + 2).cast("string"), F.lit("\n end"))
    text = F.regexp_replace(text, r"=\s+", "= ")
    path = put_logs(t, "fit", text)
    return L.extract_fit_metrics(t.spark, path, RUN).select("run", r6("aic").alias("aic"), r6("neg2logl").alias("neg2logl"))


@query(
    "A13_var_blocks",
    """with d as (select 'm' || s_suppkey as run, s_acctbal as v, s_nationkey as w from supplier) select run, 'hs_dir' as val1, 'hs_dir' as val2, round(v, 6) as var_cov from d union all
       select run, 'hs_dir', 'hs_mat', w::double from d union all select run, 'hs_mat', 'hs_dir', w::double from d union all select run, 'hs_mat', 'hs_mat', round(v + 1, 6) from d
       union all select run, 'hs_res', 'hs_res', round(v + 2, 6) from d""",
)
def _(t):
    v = F.col("s_acctbal").cast("decimal(12,2)")
    w = F.col("s_nationkey").cast("string")
    text = F.concat(
        F.lit("head\n Genetic variance(s) for effect   2\n   "), v.cast("string"), F.lit("   "), w, F.lit("\n "), w, F.lit("  "), (v + 1).cast("string"),
        F.lit("\n correlations\n Residual variance(s)\n  "), (v + 2).cast("string"), F.lit("\n"),
    )
    path = put_logs(t, "var", text)
    out = L.extract_var_blocks(t.spark, path, {"2": ["hs_dir", "hs_mat"], "residual": ["hs_res"], "5": ["none"]}, RUN)
    return out.select("run", "val1", "val2", r6("var_cov").alias("var_cov"))


@query(
    "A14_level_tables",
    """select 'm' || s_suppkey as run, 1 as effect, 'L' || s_suppkey as id_original, s_nationkey as n, s_suppkey::varchar as id_renamed from supplier
       union all select 'm' || s_suppkey, 1, 'K' || s_suppkey, 7, '2' from supplier""",
)
def _(t):
    k = F.col("s_suppkey").cast("string")
    text = F.concat(
        F.lit(" Effect group 1 of column 1 with 2 levels\n Value  # consecutive number\n L"), k, F.lit("  "), F.col("s_nationkey"), F.lit("  "), k,
        F.lit("\n K"), k, F.lit("  7  2\n Effect group 12 of column 2 with 1 levels\n Value # n\n Z 1 1"),
    )
    return L.extract_level_tables(t.spark, put_logs(t, "lev", text), [1], RUN)


@query("A15_scores", "select 'A' || c_custkey as full_reg, round(c_acctbal / 1000, 6) as pc1, round(c_nationkey / 10, 6) as pc2 from customer")
def _(t):
    pc1, pc2 = (r6(F.col("c_acctbal") / 1000)), r6(F.col("c_nationkey") / 10)
    line = F.concat(F.lit("  grp:A"), "c_custkey", F.lit("  "), pc1, F.lit("   "), pc2, F.lit("   cow"))
    path = fresh_path(t.spark, "evec")
    head = t.customer.agg(F.max("c_acctbal").alias("a"), F.min("c_acctbal").alias("b"))
    head = head.select(F.concat(F.lit("   #eigvals:   "), "a", F.lit("  "), "b").alias("value"))
    t.customer.select(line.alias("value")).unionByName(head).write.text(path)
    out = R.read_scores(t.spark, path, 2)
    return out.select("full_reg", r6("PC1").alias("pc1"), r6("PC2").alias("pc2"))


@query(
    "A15_eigenvalues",
    """with v as (select 1::bigint as pc, max(o_totalprice) as eigenvalue from orders union all select 2, min(o_totalprice) from orders)
       select pc, eigenvalue, round(eigenvalue / sum(eigenvalue) over (), 6) as share from v""",
)
def _(t):
    path = fresh_path(t.spark, "eigen")
    ends = t.orders.agg(F.max("o_totalprice").alias("a"), F.min("o_totalprice").alias("b"))
    ends.select(F.concat(F.lit("#eigvals: "), "a", F.lit("   "), "b").alias("value")).write.text(path)
    out = R.read_eigenvalues(t.spark, path)
    return out.select(F.col("pc").cast("bigint").alias("pc"), "eigenvalue", r6("share").alias("share"))


@query("A16_write_delim", "select c_custkey, case when c_nationkey > 12 then c_mktsegment end as seg from customer")
def _(t):
    path = fresh_path(t.spark, "delim")
    d = t.customer.select("c_custkey", F.when(F.col("c_nationkey") > 12, F.col("c_mktsegment")).alias("seg"))
    Wr.write_delim(d, path)
    return R.read_ws(t.spark, path, [("c_custkey", "bigint"), ("seg", "string")])


@query(
    "A17_fixed_width",
    """select rpad(animal::varchar, 20, ' ') || ' ' || string_agg(coalesce(dosage, 5)::varchar, '' order by snp) as value from genotypes group by animal""",
)
def _(t):
    path = fresh_path(t.spark, "fwf")
    Wr.write_fixed_width(t.genotypes, path)
    return t.spark.read.text(path)


@query("A17_marker_info", "select snp as snp_id, chr, pos, chr || ':' || pos as chrpos from markers")
def _(t):
    return Wr.marker_info(t.markers.withColumnRenamed("snp", "snp_id"))


@query("A18_state", "select o_orderkey, o_totalprice, o_orderstatus from orders")
def _(t):
    path = fresh_path(t.spark, "state")
    Wr.write_state(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), path, ["o_orderstatus"])
    return R.read_state(t.spark, path)


@query("A19_column_subset", "select l_orderkey, l_linenumber, l_suppkey, l_tax from lineitem")
def _(t):
    return R.read_columns(t.spark, f"{t.folder}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_suppkey", "l_tax"])


@query(
    "A20_tagged_files",
    """select case when c_nationkey < 12 then 'low' else 'high' end as dataset, c_custkey, c_acctbal from customer""",
)
def _(t):
    paths = {}
    for name, cond in {"low": "c_nationkey < 12", "high": "c_nationkey >= 12"}.items():
        paths[name] = fresh_path(t.spark, name)
        t.customer.filter(cond).select("c_custkey", "c_acctbal").write.option("sep", " ").option("header", True).csv(paths[name])
    return R.read_tagged(t.spark, paths, [("c_custkey", "bigint"), ("c_acctbal", "double")])
