"""Joins, identity searches, intervals."""

from pyspark.sql import functions as F

from herdframe.catalog.base import query
from herdframe.operators import intervals as V
from herdframe.operators import joins as J
from herdframe.operators import pedigree as D
from herdframe.operators.keys import null_safe_join

_SEASONS = "(select coalesce(season, '?') as s, season, count(*) as n_season from records group by all)"


@query(
    "C1_natural_join",
    f"select rec_a, rec_b, temp_id, farm_id, score_date, r.season, n_season from records r left join {_SEASONS} k on coalesce(r.season, '?') = k.s",
)
def _(t):
    sizes = t.records.groupBy("season").agg(F.count(F.lit(1)).alias("n_season"))
    # one row a season: the records stay where they are, as a season would be one large group of a shuffle
    return J.natural_join(t.records, F.broadcast(sizes)).select("rec_a", "rec_b", "temp_id", "farm_id", "score_date", "season", "n_season")


@query(
    "C1_left_join",
    "select o_orderkey, c_mktsegment from orders left join (select c_custkey, c_mktsegment from customer where c_acctbal > 0) c on o_custkey = c_custkey",
)
def _(t):
    right = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return t.orders.join(right, "o_custkey", "left").select("o_orderkey", "c_mktsegment")


@query("C2_right_join", "select c_custkey, o_orderkey from orders right join customer on o_custkey = c_custkey")
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "right").select("c_custkey", "o_orderkey")


@query(
    "C3_full_join",
    """with a as (select temp_id, count(*) as n_pass from records where score <= 3 group by 1), b as (select temp_id, count(*) as n_fail from records where score = 5 group by 1)
       select coalesce(a.temp_id, b.temp_id) as temp_id, coalesce(n_pass, 0) as n_pass, coalesce(n_fail, 0) as n_fail from a full join b on a.temp_id = b.temp_id""",
)
def _(t):
    a = t.records.filter("score <= 3").groupBy("temp_id").agg(F.count(F.lit(1)).alias("n_pass"))
    b = t.records.filter("score = 5").groupBy("temp_id").agg(F.count(F.lit(1)).alias("n_fail"))
    return null_safe_join(a, b, ["temp_id"], "full").na.fill(0, ["n_pass", "n_fail"])


@query("C4_anti_join", "select p_partkey as full_reg from part where p_partkey not in (select sire_reg from pedigree)")
def _(t):
    return J.anti(t.part.select(F.col("p_partkey").alias("full_reg")), t.pedigree.select(F.col("sire_reg").alias("full_reg")), ["full_reg"])


@query("C5_semi_join", "select full_reg, sire_reg, dam_reg from pedigree where full_reg in (select sire_reg from pedigree union select dam_reg from pedigree)")
def _(t):
    parents = t.pedigree.select(F.explode(F.array("sire_reg", "dam_reg")).alias("full_reg"))
    return J.semi(t.pedigree, parents, ["full_reg"])


@query(
    "C6_coalesce_join",
    """with a as (select c_custkey as k, case when c_custkey % 2 = 0 then c_mktsegment end as seg, c_nationkey as nat from customer where c_acctbal > 0),
       b as (select c_custkey as k, c_name as seg, c_acctbal as bal from customer where c_nationkey > 4)
       select coalesce(a.k, b.k) as k, coalesce(a.seg, b.seg) as seg, nat, bal from a full join b on a.k = b.k""",
)
def _(t):
    k = F.col("c_custkey")
    a = t.customer.filter("c_acctbal > 0").select(k.alias("k"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("seg"), F.col("c_nationkey").alias("nat"))
    b = t.customer.filter("c_nationkey > 4").select(k.alias("k"), F.col("c_name").alias("seg"), F.col("c_acctbal").alias("bal"))
    return J.coalesce_join(a, b, ["k"])


@query(
    "C7_reduce_join",
    """with m as (select temp_id, year, min(score) as s from records group by all)
       select temp_id, arg_min(s, year) as s from m group by temp_id""",
)
def _(t):
    return J.reduce_pieces(t.records.filter("temp_id is not null"), ["temp_id"], "year", ["score"]).withColumnRenamed("score", "s")


@query(
    "C7_reduce_join_tables",
    """with a as (select c_custkey as k, case when c_custkey % 2 = 0 then c_mktsegment end as seg from customer where c_acctbal > 0),
       b as (select o_custkey as k, max(o_orderpriority) as seg, count(*) as n from orders group by 1), c as (select c_custkey as k, c_name as seg, c_acctbal as bal from customer)
       select coalesce(a.k, b.k, c.k) as k, coalesce(a.seg, b.seg, c.seg) as seg, n, bal from a full join b on a.k = b.k full join c on coalesce(a.k, b.k) = c.k""",
)
def _(t):
    k = F.col("c_custkey").alias("k")
    a = t.customer.filter("c_acctbal > 0").select(k, F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("seg"))
    b = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderpriority").alias("seg"), F.count(F.lit(1)).alias("n"))
    c = t.customer.select(k, F.col("c_name").alias("seg"), F.col("c_acctbal").alias("bal"))
    return J.reduce_join([a, b, c], ["k"])


@query(
    "C8_id_search",
    """select s.c_custkey, s.registration_number, s.barcode, r.lab_id, case when r.lab_id is not null then 'registration_number-reg' end as match_source
       from id_source s left join register r on s.registration_number = r.reg""",
)
def _(t):
    return J.id_search(t.id_source, "registration_number", t.register, "reg", "lab_id", "match_source")


@query(
    "C8_match_counts",
    """select (select count(*) from id_source s join register r on s.registration_number = r.reg) as found,
       (select count(*) from id_source s left join register r on s.registration_number = r.reg where r.lab_id is null) as missing""",
)
def _(t):
    return J.match_counts(t.id_source, J.id_search(t.id_source, "registration_number", t.register, "reg", "lab_id"), "lab_id")


@query(
    "C9_id_cascade",
    """with a as (select s.*, r.lab_id from id_source s left join register r on s.registration_number = r.reg),
       b as (select a.c_custkey, a.registration_number, a.barcode, coalesce(a.lab_id, r.lab_id) as lab_id from a left join register r on a.lab_id is null and a.barcode = r.ref_id2)
       select b.c_custkey, b.registration_number, b.barcode, coalesce(b.lab_id, r.lab_id) as lab_id from b left join register r on b.lab_id is null and b.registration_number = r.ref_id3""",
)
def _(t):
    reg = t.register
    steps = [("registration_number", reg, "reg"), ("barcode", reg, "ref_id2"), ("registration_number", reg, "ref_id3")]
    return J.id_cascade(t.id_source, steps, "lab_id")


@query(
    "C10_multi_match",
    """with d as (select l_partkey as animal, l_suppkey as lab_id, l_linenumber = 7 as bulk from lineitem),
       a as (select animal, lab_id, bulk from d qualify not (bulk and min(lab_id) over (partition by animal) <> max(lab_id) over (partition by animal)))
       select animal, lab_id, bulk from a qualify lab_id = max(lab_id) over (partition by animal)""",
)
def _(t):
    d = t.lineitem.select(F.col("l_partkey").alias("animal"), F.col("l_suppkey").alias("lab_id"), (F.col("l_linenumber") == 7).alias("bulk"))
    return J.resolve_multi_match(d, ["animal"], "lab_id", "bulk")


_RENAMED = """select full_reg + 500000 as id_new, case when sire_reg > 0 then sire_reg + 500000 end as sire_id,
    case when dam_reg > 0 then dam_reg + 500000 end as dam_id, 'R' || full_reg as full_reg from pedigree"""


@query(
    "C11_decode_ids",
    f"""with r as ({_RENAMED}) select a.id_new, a.full_reg, coalesce(s.full_reg, '0') as sire_reg, coalesce(d.full_reg, '0') as dam_reg
       from r a left join r s on a.sire_id = s.id_new left join r d on a.dam_id = d.id_new""",
)
def _(t):
    shift = lambda c: F.when(F.col(c) > 0, F.col(c) + 500000)
    renamed = t.pedigree.select(
        shift("full_reg").alias("id_new"), shift("sire_reg").alias("sire_id"), shift("dam_reg").alias("dam_id"),
        F.concat(F.lit("R"), F.col("full_reg")).alias("full_reg"),
    )
    return D.decode_ids(renamed)


@query(
    "C12_parent_values",
    """with v as (select p.full_reg, sire_reg, dam_reg, p_retailprice as ebv from pedigree p join part on full_reg = p_partkey)
       select v.full_reg, v.ebv, s.ebv as sire_ebv, d.ebv as dam_ebv from v left join v s on v.sire_reg = s.full_reg left join v d on v.dam_reg = d.full_reg""",
)
def _(t):
    price = t.part.select(F.col("p_partkey").alias("full_reg"), F.col("p_retailprice").alias("ebv"))
    return D.attach_parent_values(t.pedigree.join(price, "full_reg"), ["ebv"]).select("full_reg", "ebv", "sire_ebv", "dam_ebv")


@query(
    "C13_expand_generations",
    """with base as (select p.* from pedigree p join part on full_reg = p_partkey where p_size > 45),
       g1 as (select * from pedigree where full_reg in (select sire_reg from base union select dam_reg from base)),
       g2 as (select * from pedigree where full_reg in (select sire_reg from g1 union select dam_reg from g1))
       select * from base union select * from g1 union select * from g2""",
)
def _(t):
    big = t.part.filter("p_size > 45").select(F.col("p_partkey").alias("full_reg"))
    return D.expand_generations(t.pedigree.join(big, "full_reg", "left_semi"), t.pedigree, 2)


@query(
    "C14_member_list",
    """select distinct k as full_reg from (select full_reg as k from pedigree union select sire_reg from pedigree union select dam_reg from pedigree)
       where k in (select p_partkey from part where p_size <= 25)""",
)
def _(t):
    return D.member_list(t.pedigree, t.part.filter("p_size <= 25").select(F.col("p_partkey").alias("full_reg")))


@query(
    "C15_override_parents",
    """with f as (select p_partkey as k, p_size as s, case when p_size > 25 then p_size + 1000 end as d from part where p_size > 10)
       select full_reg, coalesce(f.s, sire_reg) as sire_reg, case when f.d is not null then f.d else dam_reg end as dam_reg,
       case when sire_reg = 0 and f.s is not null then f.s else sire_reg end as filled from pedigree left join f on full_reg = k""",
)
def _(t):
    size = F.col("p_size").cast("bigint")
    fixes = t.part.filter("p_size > 10").select(
        F.col("p_partkey").alias("full_reg"), size.alias("fix_sire"), F.when(size > 25, size + 1000).alias("fix_dam")
    )
    replaced = D.override_parents(t.pedigree, fixes, ["full_reg"])
    filled = D.override_parents(t.pedigree, fixes, ["full_reg"], only_unknown=True, unknown=0)
    return replaced.join(filled.select("full_reg", F.col("sire_reg").alias("filled")), "full_reg")


@query(
    "C16_rekey_parents",
    """with l as (select p_partkey as old, cast(900000 + p_partkey // 2 * (p_partkey % 3) as bigint) as new from part), u as (select * from l qualify count(*) over (partition by new) = 1)
       select full_reg, coalesce(s.new, sire_reg) as sire_reg, coalesce(d.new, dam_reg) as dam_reg from pedigree left join u s on sire_reg = s.old left join u d on dam_reg = d.old""",
)
def _(t):
    k = F.col("p_partkey")
    links = t.part.select(k.alias("old"), (900000 + F.floor(k / 2) * (k % 3)).alias("new"))
    return D.rekey_parents(t.pedigree, links, "old", "new")


_HITS = "(select distinct chr, pos, snp from gwas where p < 0.02)"


def hits(t):
    return t.gwas.filter("p < 0.02").select("chr", "pos", "snp").distinct()


@query(
    "C17_interval_join",
    f"""select m.chr, pos, snp, gene_id, start_pos, end_pos from {_HITS} m join genes g on m.chr = g.chr and pos between start_pos - 500 and end_pos + 500""",
)
def _(t):
    return V.interval_join(hits(t), t.genes, 500).select("chr", "pos", "snp", "gene_id", "start_pos", "end_pos")


@query(
    "C17_containment",
    "select m.chr, pos, study, snp, gene_id from gwas m join genes g on m.chr = g.chr and pos between start_pos and end_pos",
)
def _(t):
    return V.interval_join(t.gwas, t.genes, 0).select("chr", "pos", "study", "snp", "gene_id")


@query(
    "C18_nearest_feature",
    f"""select m.chr, pos, snp, gene_id, least(abs(pos - start_pos), abs(pos - end_pos)) as dist from {_HITS} m join genes g
       on m.chr = g.chr and pos between start_pos - 5000 and end_pos + 5000
       qualify row_number() over (partition by m.chr, pos, snp order by least(abs(pos - start_pos), abs(pos - end_pos)), start_pos, end_pos, gene_id) = 1""",
)
def _(t):
    out = V.nearest_feature(hits(t), t.genes, ["chr", "pos", "snp"], 5000, "gene_id")
    return out.select("chr", "pos", "snp", "gene_id", V.feature_distance().alias("dist"))


@query(
    "C18_window_or_nearest",
    f"""with m as (select * from {_HITS}), near as (select m.chr, pos, snp, gene_id from m join genes g on m.chr = g.chr and pos between start_pos - 100 and end_pos + 100),
       lone as (select * from m where (chr, pos) not in (select chr, pos from near)),
       far as (select m.chr, pos, snp, gene_id from lone m join genes g on m.chr = g.chr and pos between start_pos - 5000 and end_pos + 5000
         qualify row_number() over (partition by m.chr, pos, snp order by least(abs(pos - start_pos), abs(pos - end_pos)), start_pos, end_pos, gene_id) = 1)
       select * from near union all select * from far""",
)
def _(t):
    return V.window_or_nearest(hits(t), t.genes, ["chr", "pos", "snp"], 100, 5000, "gene_id").select("chr", "pos", "snp", "gene_id")


@query(
    "C19_year_grid",
    """with y as (select distinct year as y from records) select a.y as year1, b.y as year2, a.y - b.y as dist from y a, y b where a.y <> b.y""",
)
def _(t):
    return J.year_grid(t.records, "year")


@query(
    "C20_lookup_default",
    """with k as (select farm_id, score_date, max(score) as score_group from records where score > 3 group by all)
       select rec_a, rec_b, temp_id, r.farm_id, r.score_date, coalesce(score_group, 1) as score_group from records r left join k on r.farm_id = k.farm_id and r.score_date = k.score_date""",
)
def _(t):
    groups = t.records.filter("score > 3").groupBy("farm_id", "score_date").agg(F.max("score").alias("score_group"))
    out = J.lookup_with_default(t.records, groups, ["farm_id", "score_date"], "score_group", 1)
    return out.select("rec_a", "rec_b", "temp_id", "farm_id", "score_date", "score_group")


@query(
    "C21_choose_sample",
    """with p as (select c_custkey as lab_id from customer), g as (select c_custkey as lab_id, case when c_custkey % 3 = 0 then c_custkey + 1 end as duplicate from customer),
       s as (select c_custkey as lab_id, case when c_custkey % 4 = 0 then 'GGPF250' else 'SNP50' end as assay, 0.8 + (c_custkey % 20) / 100.0 as call_rate from customer where c_acctbal > 0)
       select p.lab_id, case when (o.assay is null and d.assay is not null) or coalesce(d.assay like '%F250%' and d.call_rate > 0.89, false) then g.duplicate else p.lab_id end as final_id
       from p left join g on p.lab_id = g.lab_id left join s o on p.lab_id = o.lab_id left join s d on g.duplicate = d.lab_id""",
)
def _(t):
    k = F.col("c_custkey")
    register = t.customer.select(k.alias("lab_id"), F.when(k % 3 == 0, k + 1).alias("duplicate"))
    samples = t.customer.filter("c_acctbal > 0").select(
        k.alias("lab_id"), F.when(k % 4 == 0, "GGPF250").otherwise("SNP50").alias("assay"), (0.8 + (k % 20) / 100.0).alias("call_rate")
    )
    return J.choose_sample_id(t.customer.select(k.alias("lab_id")), register, samples).select("lab_id", "final_id")


@query(
    "C22_overlap",
    """with s as (select study, chr, snp from gwas where p < 0.05)
       select study, s.chr, s.snp, n from s join (select chr, snp, count(*) as n from s group by all having count(distinct study) > 1) k on s.chr = k.chr and s.snp = k.snp""",
)
def _(t):
    return J.overlap(t.gwas.filter("p < 0.05").select("study", "chr", "snp"), ["chr", "snp"], "study")


@query(
    "C22_passing_and_new",
    """with h as (select distinct chr, pos from gwas where study = 1 and p < 0.01), r as (select distinct chr, pos from gwas where study > 1 and p < 0.5)
       select count(r.chr) as n_passing, count(*) - count(r.chr) as n_new from h left join r on h.chr = r.chr and h.pos = r.pos""",
)
def _(t):
    h = t.gwas.filter("study = 1 and p < 0.01").select("chr", "pos").distinct()
    return J.passing_and_new(h, t.gwas.filter("study > 1"), ["chr", "pos"], F.col("p") < 0.5)
