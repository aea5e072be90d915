"""Reshaping and nesting."""

from pyspark.sql import functions as F

from herdframe.catalog.base import query
from herdframe.functions.base import r6
from herdframe.operators import shape as P


@query(
    "D1_pivot_wider",
    """select registration_number, max(pct) filter (where brd = '1') as pct_1, max(pct) filter (where brd = '2') as pct_2, max(pct) filter (where brd = '3') as pct_3,
       max(pct) filter (where brd = '4') as pct_4, max(pct) filter (where brd = '5') as pct_5 from fractions group by 1""",
)
def _(t):
    return P.pivot_wider(t.fractions, ["registration_number"], "brd", {"pct": "pct_"}, ["1", "2", "3", "4", "5"])


@query(
    "D2_pivot_longer",
    """select p_partkey, 'size' as name, p_size::double as value from part union all select p_partkey, 'price', p_retailprice from part""",
)
def _(t):
    d = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    return P.pivot_longer(d, ["p_partkey"], ["size", "price"])


@query(
    "D3_stack_pairs",
    """select temp_id, min(score_date) as score_date, cast(min(score) as bigint) as score from records group by temp_id
       union all select temp_id, max(score_date), nullif(max(score), 3) from records group by temp_id having nullif(max(score), 3) is not null""",
)
def _(t):
    high = F.max("score")
    wide = t.records.groupBy("temp_id").agg(
        F.min("score_date").alias("d1"), F.min("score").alias("s1"), F.max("score_date").alias("d2"),
        F.when(high != 3, high).alias("s2"),
    )
    return P.stack_pairs(wide, ["temp_id"], [("d1", "s1"), ("d2", "s2")])


@query(
    "D4_wide_pedigree",
    """with w as (select a.full_reg, a.sire_reg as s, a.dam_reg as d, p.sire_reg as ss, p.dam_reg as sd, m.sire_reg as ds, m.dam_reg as dd from pedigree a
         left join pedigree p on a.sire_reg = p.full_reg left join pedigree m on a.dam_reg = m.full_reg)
       select full_reg, s as sire_reg, d as dam_reg from w union select s, ss, sd from w where s is not null union select d, ds, dd from w where d is not null""",
)
def _(t):
    ped = t.pedigree
    sire = ped.select(F.col("full_reg").alias("s"), F.col("sire_reg").alias("ss"), F.col("dam_reg").alias("sd"))
    dam = ped.select(F.col("full_reg").alias("d"), F.col("sire_reg").alias("ds"), F.col("dam_reg").alias("dd"))
    wide = ped.withColumnsRenamed({"sire_reg": "s", "dam_reg": "d"}).join(sire, "s", "left").join(dam, "d", "left")
    return P.wide_pedigree_to_long(wide, [("full_reg", "s", "d"), ("s", "ss", "sd"), ("d", "ds", "dd")])


_MATRIX = """select 'a' as val1, round(var_samp(score), 6) as a, round(covar_samp(score, year), 6) as b from records
    union all select 'b', round(covar_samp(score, year), 6), round(var_samp(year), 6) from records"""


@query(
    "D5_melt_matrix",
    f"""with m as ({_MATRIX}) select val1, 'a' as val2, a as var_cov from m union all select val1, 'b', b from m""",
)
def _(t):
    cell = lambda name, a, b: F.struct(F.lit(name).alias("val1"), r6(a).alias("a"), r6(b).alias("b"))
    cov = F.covar_samp("score", "year")
    rows = t.records.agg(F.var_samp("score").alias("v"), cov.alias("c"), F.var_samp("year").alias("w"))
    matrix = rows.select(F.inline(F.array(cell("a", "v", "c"), cell("b", "c", "w"))))
    return P.melt_matrix(matrix, "val1", ["a", "b"])


@query(
    "D6_nest_unnest",
    "select o_custkey, o_orderkey, o_orderpriority from orders",
)
def _(t):
    return P.unnest(P.nest(t.orders, ["o_custkey"], ["o_orderkey", "o_orderpriority"]))


@query(
    "D7_split_columns",
    "select p_partkey, split_part(p_name, ' ', 1) as a, case when contains(p_name, ' ') then split_part(p_name, ' ', 2) end as b from part",
)
def _(t):
    return P.split_columns(t.part.select("p_partkey", "p_name"), "p_name", ["a", "b"])


@query("D7_split_rows", "select p_partkey, unnest(string_split(p_name, ' ')) as word from part")
def _(t):
    return P.split_rows(t.part.select("p_partkey", "p_name"), "p_name", "word", " ").select("p_partkey", "word")


@query(
    "D8_triplet_stack",
    """with w as (select o_custkey, min(o_orderpriority) as b1, min(o_totalprice) as f1, max(o_orderpriority) as b2, max(o_totalprice) as f2 from orders group by 1)
       select o_custkey, b1 as brd, f1 as frac from w union all select o_custkey, b2, f2 from w""",
)
def _(t):
    wide = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderpriority").alias("b1"), F.min("o_totalprice").alias("f1"), F.max("o_orderpriority").alias("b2"), F.max("o_totalprice").alias("f2")
    )
    return P.stack_groups(wide, ["o_custkey"], [{"brd": "b1", "frac": "f1"}, {"brd": "b2", "frac": "f2"}])


@query(
    "D9_dosage_string",
    "select animal, string_agg(coalesce(dosage, 5)::varchar, '' order by snp) as genotype from genotypes group by animal",
)
def _(t):
    return P.dosage_to_string(t.genotypes)


@query(
    "D9_string_to_dosage",
    """select animal, row_number() over (partition by animal order by snp) as snp, cast(dosage as int) as dosage from genotypes""",
)
def _(t):
    rows = P.string_to_dosage(P.dosage_to_string(t.genotypes))
    return rows.select("animal", F.col("snp").cast("bigint").alias("snp"), "dosage")
