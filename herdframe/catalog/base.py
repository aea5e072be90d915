"""Registry of queries and the domain tables that are derived from the given tables in portable SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[["Tables"], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}

# Domain tables over whole given tables; braces mark given tables.
DERIVED: dict[str, str] = {
    "records": """
        select l_orderkey as rec_a, cast(l_linenumber as bigint) as rec_b,
               concat('F', cast(l_suppkey % 20 as string)) as farm_id, l_partkey as temp_id,
               cast(year(l_shipdate) as bigint) as year, cast(l_shipdate as date) as score_date,
               cast(cast(l_quantity as int) % 5 + 1 as bigint) as score,
               case when (l_orderkey + l_linenumber) % 7 = 0 then null when l_partkey % 2 = 0 then 'SPRING'
                    else 'FALL' end as season,
               case when (l_orderkey * 3 + l_linenumber) % 11 = 0 then null
                    else cast(year(l_shipdate) as bigint) - (1994 - l_partkey % 8) end as age,
               case when l_partkey % 13 = 0 then null when l_partkey % 5 = 0 then 'M' else 'F' end as sex
        from {lineitem}""",
    "pedigree": """
        select p_partkey as full_reg,
               case when p_partkey % 10 = 0 then 0 else cast(floor(p_partkey / 2) as bigint) end as sire_reg,
               case when p_partkey % 9 = 0 then 0 else cast(floor(p_partkey / 3) as bigint) end as dam_reg
        from {part} where p_partkey > 0""",
    "genotypes": """
        select l_suppkey as animal, l_partkey as snp,
               case when (l_suppkey + l_partkey) % 17 = 0 then null
                    else (l_suppkey * 7 + l_partkey * 13 + (l_suppkey * l_partkey) % 11) % 3 end as dosage
        from {lineitem} group by l_suppkey, l_partkey""",
    "geno_ped": """
        select s_suppkey as full_reg, cast(floor(s_suppkey / 2) as bigint) as sire_reg,
               cast(floor(s_suppkey / 3) as bigint) as dam_reg
        from {supplier} where s_suppkey > 0""",
    "pheno": """
        select s_suppkey as animal, s_acctbal / 1000 as y, cast(s_nationkey as double) as env,
               cast(s_suppkey % 7 + 1 as double) as wt from {supplier}""",
    "markers": """
        select p_partkey as snp, cast(p_partkey % 29 + 1 as bigint) as chr,
               (p_partkey * 7919) % 1500000 as pos from {part}""",
    "gwas": """
        select cast(l_linenumber as bigint) as study, l_partkey % 29 + 1 as chr,
               (l_orderkey * 10 + l_linenumber) % 150000 as pos, l_partkey as snp,
               l_discount - cast(0.05 as double) as beta, cast(0.01 as double) + l_tax as se,
               (cast((l_orderkey * 7919 + l_linenumber * 104729) % 99991 as double) + cast(0.5 as double))
                 / cast(99991 as double) as p
        from {lineitem}""",
    "genes": """
        select p_partkey as gene_id, p_partkey % 29 + 1 as chr, (p_partkey * 37) % 150000 as start_pos,
               (p_partkey * 37) % 150000 + p_size * 10 as end_pos, p_brand as term from {part}""",
    "weather": """
        select user_id % 10 as site, cast(ts as date) as day, round(avg(value), 6) as apparent_high
        from {events} group by 1, 2""",
    "evaluations": """
        select c_custkey as full_reg, cast(c_nationkey % 10 as bigint) as iter,
               c_acctbal / cast(1000 as double) as solution_full,
               c_acctbal / cast(1000 as double) * cast(0.9 as double) + (c_custkey % 7) * cast(0.01 as double)
                 as solution_reduced,
               case when c_custkey % 4 = 0 then 'dropped' else 'kept' end as grp from {customer}""",
    "id_source": """
        select c_custkey, case when c_custkey % 3 = 0 then null else concat('R', cast(c_custkey as string)) end
                 as registration_number,
               case when c_custkey % 5 = 0 then null else concat('B', cast(c_custkey as string)) end as barcode
        from {customer}""",
    "register": """
        select c_custkey + 100000 as lab_id,
               case when c_custkey % 2 = 0 then concat('R', cast(c_custkey as string)) end as reg,
               case when c_custkey % 7 = 0 then concat('B', cast(c_custkey as string)) end as ref_id2,
               case when c_custkey % 11 = 0 then concat('R', cast(c_custkey as string)) end as ref_id3,
               case when c_custkey % 3 = 0 then 'bulk ASA' else 'direct' end as note from {customer}""",
    "herd_files": """
        select o_orderkey as rec, concat('F', cast(o_custkey % 20 as string)) as farm_id,
               cast(year(o_orderdate) as bigint) as year, cast(o_orderdate as date) as score_date,
               case when o_custkey % 3 = 0 then null else concat('r ', cast(o_custkey as string)) end
                 as registration_number,
               concat(' a', cast(o_custkey as string), '. ') as animal_id,
               case when o_custkey % 5 = 0 then null else concat('b-', cast(o_custkey as string)) end as barcode
        from {orders}""",
    "joined_records": """
        select o_orderkey as rec, concat('F', cast(o_custkey % 20 as string)) as farm_id, o_custkey as temp_id,
               case when o_custkey % 2 = 1 then o_custkey end as lab_id, cast(year(o_orderdate) as bigint) as year,
               cast(o_orderdate as date) as score_date,
               case o_orderkey % 3 when 0 then '3 YEARS' when 1 then null else '5' end as age,
               case when o_orderstatus = 'P' then null
                    else concat('score ', cast(o_orderkey % 5 + 1 as string)) end as score,
               case when o_orderkey % 4 = 0 then 'U' when o_custkey % 17 = 0 and o_orderkey % 5 = 0 then 'M'
                    when o_custkey % 6 = 0 then 'B' else 'COW' end as sex,
               case when o_custkey % 2 = 0 then 'ANGUS' else 'SIMAN' end as breed_code,
               case when o_orderkey % 3 = 0 then 'blk' when o_orderkey % 3 = 1 then 'R' end as color,
               case when o_orderkey % 2 = 0 then 'spring' else 'FALL' end as season,
               case when o_orderkey % 5 = 0 then 'Y' when o_orderkey % 5 = 1 then 'FALSE' else 'NO' end as fescue,
               case when o_orderkey % 29 = 0 then 'YES' end as sold
        from {orders}""",
    "fractions": """
        select o_custkey as registration_number, substr(o_orderpriority, 1, 1) as brd,
               round(sum(o_totalprice) / max(t.tot), 6) as pct
        from {orders} join (select o_custkey as k, sum(o_totalprice) as tot from {orders} group by o_custkey) t
             on o_custkey = t.k group by 1, 2""",
}


class Tables:
    """Given and derived tables of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in DERIVED:
            text = DERIVED[name]
            used = set(re.findall(r"\{(\w+)\}", text))
            return self.spark.sql(text, **{t: getattr(self, t) for t in used})
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query under a name with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = (fn, sql)
        return fn

    return register


def oracle_text(sql: str) -> str:
    """Put the derived tables a statement names in front of it."""
    text = sql.strip()
    used = [name for name in DERIVED if re.search(rf"\b{name}\b", text)]
    if not used:
        return text
    ctes = ", ".join(f"{name} as ({re.sub(r'[{}]', '', DERIVED[name])})" for name in used)
    if text.lower().startswith("with recursive"):
        return f"with recursive {ctes}, {text[len('with recursive') :]}"
    if text.lower().startswith("with"):
        return f"with {ctes}, {text[len('with') :]}"
    return f"with {ctes} {text}"


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return REGISTRY[name][0](Tables(spark, folder))
