"""Composite jobs on the given tables."""

from pyspark.sql import functions as F

from herdframe.catalog.base import query
from herdframe.catalog.columns import ERFC
from herdframe.functions.base import r6
from herdframe.operators import gwas as G
from herdframe.operators import pedigree as D
from herdframe.plans import breeds as B
from herdframe.plans import cleaning as C
from herdframe.plans import models as M
from herdframe.plans import pedigree_build as PB
from herdframe.plans import release as Z
from herdframe.plans import reports as RP

ROW = ["rec_a", "rec_b", "temp_id", "farm_id", "score_date"]


def sql_fill(src, keys, moment, column, order=None):
    """Filled values per key and moment: last known before or at the moment, else first known after."""
    same = " and ".join(f"d.{k} = k.{k}" for k in keys)
    ks = ", ".join(keys)
    dk = ", ".join(f"d.{k}" for k in keys)
    by = f"(k.{moment}, {order or f'k.{column}'})"
    return f"""(select {dk}, d.{moment}, coalesce(arg_max(k.{column}, {by}) filter (where k.{moment} <= d.{moment}),
        arg_min(k.{column}, {by}) filter (where k.{moment} >= d.{moment})) as fill
        from (select distinct {ks}, {moment} from {src}) d left join (select * from {src} where {column} is not null) k on {same} group by {dk}, d.{moment})"""


@query(
    "H1_clean_farm_records",
    """with k as (select distinct farm_id, 'R' || (o_custkey) as r0, o_custkey from (select concat('F', cast(o_custkey % 20 as string)) as farm_id, o_custkey from orders)),
       i as (select farm_id, case when o_custkey % 3 <> 0 then r0 end as registration_number, 'A' || o_custkey as animal_id, case when o_custkey % 5 <> 0 then 'B' || o_custkey end as barcode from k),
       a as (select i.*, r.lab_id from i left join register r on i.registration_number = r.reg),
       b as (select a.* exclude (lab_id), coalesce(a.lab_id, r.lab_id) as lab_id from a left join register r on a.lab_id is null and a.barcode = r.ref_id2),
       c as (select b.* exclude (lab_id), coalesce(b.lab_id, r.lab_id) as lab_id from b left join register r on b.lab_id is null and b.registration_number = r.ref_id3),
       t as (select *, row_number() over (partition by farm_id order by md5(coalesce(registration_number, '') || '|' || animal_id || '|' || coalesce(barcode, '') || '|' || coalesce(lab_id::varchar, '') || '|')) as temp_id from c)
       select h.rec, h.farm_id, t.temp_id, t.animal_id, t.registration_number, t.barcode, t.lab_id from herd_files h join t on t.farm_id = h.farm_id and t.animal_id = upper(replace(trim(h.animal_id), '.', ''))""",
)
def _(t):
    register = t.register.withColumnRenamed("note", "comment")
    out = C.clean_farm_records(t.herd_files, register)
    return out.select("rec", "farm_id", "temp_id", "animal_id", "registration_number", "barcode", "lab_id")


_H2 = f"""with a as (select *, case when lab_id is not null then make_date(1985 + lab_id % 10, 3, 1) end as dob, bool_or(coalesce(sold = 'YES', false)) over (partition by farm_id, temp_id) as s from joined_records),
    b as (select * exclude (age), date_diff('day', dob, score_date) as dd, try_cast(regexp_replace(age, 'YEARS|[ ]', '', 'g') as int) as raw from a),
    c as (select *, case when dd between 274 and 7939 then greatest(1, (dd + 90) // 365) else raw end as age from b where dd is null or dd >= 274),
    d as (select c.* exclude (age), coalesce(c.age, f.fill) as age from c join {sql_fill("c", ["farm_id", "temp_id", "year"], "score_date", "age")} f
          on c.farm_id = f.farm_id and c.temp_id = f.temp_id and c.year = f.year and c.score_date = f.score_date where c.score is not null),
    e as (select * exclude (sex), case when sex = 'COW' then 'F' when sex in ('B', 'M') then 'M' end as sex from d),
    g as (select e.* exclude (sex), coalesce(e.sex, f.fill) as sex from e join {sql_fill("e", ["farm_id", "temp_id"], "year", "sex", "k.score_date, k.sex")} f on e.farm_id = f.farm_id and e.temp_id = f.temp_id and e.year = f.year),
    h as (select * from g where (farm_id, temp_id) in (select (farm_id, temp_id) from g group by farm_id, temp_id having count(distinct coalesce(sex, '?')) = 1)),
    i as (select * exclude (color), case when color = 'blk' then 'BLACK' when color = 'R' then 'RED' end as color from h),
    j as (select i.* exclude (color), coalesce(i.color, f.fill) as color from i join (select d.farm_id, d.temp_id, d.year, d.score_date,
            coalesce(arg_max(k.color, (k.year, k.score_date, k.color)) filter (where (k.year, k.score_date) <= (d.year, d.score_date)), arg_min(k.color, (k.year, k.score_date, k.color)) filter (where (k.year, k.score_date) >= (d.year, d.score_date))) as fill
            from (select distinct farm_id, temp_id, year, score_date from i) d left join (select * from i where color is not null) k on d.farm_id = k.farm_id and d.temp_id = k.temp_id group by all) f
          on i.farm_id = f.farm_id and i.temp_id = f.temp_id and i.year = f.year and i.score_date = f.score_date),
    kn as (select farm_id, temp_id, year, min(age) as age from j where age is not null group by all having min(age) = max(age)),
    bi as (select farm_id, temp_id, arg_min(year - age, year) as birth from kn group by all)
    select rec, j.farm_id, j.temp_id, j.year, score_date, s as sold, coalesce(j.age, case when coalesce(kn.age, j.year - birth) > 0 then coalesce(kn.age, j.year - birth) end)::bigint as age,
      cast(replace(score, 'score ', '') as double) as score, sex, case when breed_code = 'ANGUS' then 'AN' else 'SIM' end as breed_code, color,
      case when sex = 'M' then null else upper(season) end as season, case when fescue = 'Y' then 'YES' else 'NO' end as fescue
    from j left join kn on j.farm_id = kn.farm_id and j.temp_id = kn.temp_id and j.year = kn.year left join bi on j.farm_id = bi.farm_id and j.temp_id = bi.temp_id"""


@query("H2_clean_joined", _H2)
def _(t):
    lab = t.joined_records.select("lab_id").distinct()
    born = F.when(F.col("lab_id").isNotNull(), F.make_date((1985 + F.col("lab_id") % 10).cast("int"), F.lit(3), F.lit(1)))
    out = C.clean_joined(t.joined_records, lab.withColumn("dob", born))
    return out.select(
        "rec", "farm_id", "temp_id", "year", "score_date", "sold", F.col("age").cast("bigint").alias("age"), "score", "sex", "breed_code", "color", "season", "fescue"
    )


_H3ROWS = """select o_orderkey as rec, o_custkey as k, case when o_custkey % 2 = 0 then 'SAV' else 'BAT' end as farm_id, cast(year(o_orderdate) as bigint) as year, o_orderdate::date as score_date,
    (o_orderkey % 5 + 1) as score from orders"""


@query(
    "H3_herd_sheets",
    f"""with r as ({_H3ROWS}), s as (select * from r where month(score_date) between 3 and 8),
       reg as (select c_custkey, 'F00UA-' || case when c_custkey % 2 = 0 then 'SAV' else 'BAT' end || lpad(c_custkey::varchar, greatest(4, length(c_custkey::varchar))::int, '0') as rn from customer)
       select rec, farm_id, rn as registration_number, lpad(k::varchar, greatest(4, length(k::varchar))::int, '0') as animal_id, year, score_date, cast(score as int) as score,
       case when k % 3 = 0 then k + 100000 end as lab_id, case when farm_id = 'SAV' then 'FALL' end as season, case when farm_id = 'SAV' then 'YES' end as fescue, 'CROS' as breed_code
       from s join reg on k = c_custkey""",
)
def _(t):
    k = F.col("o_custkey")
    farm = F.when(k % 2 == 0, "SAV").otherwise("BAT")
    text = lambda v: F.lit(v).cast("string")
    rows = t.orders.select(
        F.col("o_orderkey").alias("rec"), farm.alias("farm_id"), F.year("o_orderdate").cast("bigint").alias("year"), F.col("o_orderdate").cast("date").alias("score_date"),
        (F.col("o_orderkey") % 5 + 1).cast("string").alias("score"), k.cast("string").alias("animal_id"), text(None).alias("registration_number"), F.lit("F").alias("sex"),
        text(None).alias("breed_code"), text(None).alias("color"), text(None).alias("age"), text(None).alias("season"), text(None).alias("fescue"), text(None).alias("comment"), text(None).alias("dna_id"),
    )
    number = F.col("c_custkey").cast("string")
    herd = F.when(F.col("c_custkey") % 2 == 0, "SAV").otherwise("BAT")
    made = F.concat(F.lit("F00UA-"), herd, F.when(F.length(number) >= 4, number).otherwise(F.lpad(number, 4, "0")))
    register = t.customer.select(
        (F.col("c_custkey") + 100000).alias("lab_id"), F.when(F.col("c_custkey") % 3 == 0, made).alias("reg"), text(None).alias("ref_id2")
    )
    out = C.clean_herd_sheets(rows, register, ["SAV"])
    return out.select("rec", "farm_id", "registration_number", "animal_id", "year", "score_date", "score", "lab_id", "season", "fescue", "breed_code")


_CODES = {"an": ["1"], "ar": ["2"], "hfd": ["3", "4"], "sim": ["5"]}
_SH = """select registration_number, least(coalesce(max(pct) filter (where brd = '1'), 0), 1) as an, least(coalesce(max(pct) filter (where brd = '2'), 0), 1) as ar0,
    least(coalesce(max(pct) filter (where brd = '3'), 0) + coalesce(max(pct) filter (where brd = '4'), 0), 1) as hfd, least(coalesce(max(pct) filter (where brd = '5'), 0), 1) as sim from fractions group by 1"""


@query(
    "H4_registry_shares",
    f"""with s as ({_SH}), r as (select *, least(case when ar0 <> 0 and an <> 0 and hfd = 0 and sim = 0 then ar0 + an else ar0 end, 1) as ar from s)
       select registration_number, round(an, 6) as an, round(ar, 6) as ar, round(hfd, 6) as hfd, round(sim, 6) as sim,
       case when round(ar, 9) = 1 then 'AR' when round(sim, 9) = 1 then 'SIM' when round(an, 9) = 1 then 'AN' else 'CROS' end as cross,
       'ASA' || row_number() over (order by md5(registration_number || '|'), registration_number) as brd_source from r""",
)
def _(t):
    out = B.registry_shares(t.fractions, 1.0, "ASA", _CODES)
    return out.select("registration_number", *[r6(c).alias(c) for c in ("an", "ar", "hfd", "sim")], "cross", "brd_source")


@query(
    "H4_breed_key",
    f"""with s as ({_SH}), r as (select *, least(case when ar0 <> 0 and an <> 0 and hfd = 0 and sim = 0 then ar0 + an else ar0 end, 1) as ar from s),
       l as (select *, case when round(ar, 9) = 1 then 'AR' when round(sim, 9) = 1 then 'SIM' when round(an, 9) = 1 then 'AN' else 'CROS' end as label from r)
       select c_custkey as temp_id, round(case when c_nationkey = 3 then 1 else coalesce(l.an, 0) end, 6) as an, round(coalesce(l.ar, 0), 6) as ar,
       case when c_nationkey = 3 then 'AN' when l.label is null then 'CROS' when l.label = 'AR' then 'RAN' else l.label end as cross
       from customer left join l on c_nationkey <> 3 and l.registration_number = c_custkey""",
)
def _(t):
    animals = t.customer.select(
        F.concat(F.lit("N"), "c_nationkey").alias("farm_id"), F.col("c_custkey").alias("temp_id"), F.concat(F.lit("A"), "c_custkey").alias("animal_id"),
        F.col("c_custkey").cast("string").alias("registration_number"), F.lit("SIM").alias("breed_code"),
    )
    ped = animals.select("farm_id", "temp_id", F.lit(None).cast("string").alias("full_reg"), F.lit(None).cast("string").alias("source"))
    shares = B.registry_shares(t.fractions, 1.0, "ASA", _CODES).withColumn("registration_number", F.col("registration_number").cast("string"))
    out = B.breed_key(animals, ped, {"SIM": shares}, {"N3": "an"})
    # herds known to be pure keep their own source and take no registry shares
    return out.select("temp_id", r6("an").alias("an"), r6("ar").alias("ar"), "cross")


_REG = PB.Registry("Registry A", "SIM", "SIMUSA", keep=("AAA",), swap={"AN": "AAA"})


def wide_rows(t):
    """Wide registry rows: animal, parents and grandparents as text with stray marks."""
    ped = t.pedigree
    dirty = lambda c: F.when(F.col(c) > 0, F.when(F.col(c) % 7 == 0, F.concat(F.lit("an-"), F.col(c))).otherwise(F.concat(F.lit("x"), F.col(c))))
    sire = ped.select(F.col("full_reg").alias("sire_reg"), F.col("sire_reg").alias("ss"), F.col("dam_reg").alias("sd"))
    wide = ped.join(sire, "sire_reg", "left")
    return wide.select(*[dirty(c).alias(c) for c in ("full_reg", "sire_reg", "dam_reg", "ss", "sd")])


@query(
    "H5_registry_rows",
    """with c as (select full_reg, sire_reg, dam_reg, full_reg::varchar as n from pedigree),
       s as (select distinct sire_reg as k from pedigree where sire_reg > 0), d as (select distinct dam_reg as k from pedigree where dam_reg > 0)
       select case when full_reg % 7 = 0 then 'AAA' else 'SIM' end || full_reg as full_reg,
         case when sire_reg = 0 then '0' when sire_reg % 7 = 0 then 'AAA' || sire_reg else 'SIM' || sire_reg end as sire_reg,
         case when dam_reg = 0 then '0' when dam_reg % 7 = 0 then 'AAA' || dam_reg else 'SIM' || dam_reg end as dam_reg,
         case when full_reg in (select k from s) then 'M' when full_reg in (select k from d) then 'F' end as sex,
         case when full_reg % 7 <> 0 and full_reg % 2 = 0 then full_reg + 100000 end as lab_id from c""",
)
def _(t):
    register = t.part.select(
        (F.col("p_partkey") + 100000).alias("lab_id"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey").cast("string")).alias("breed_assoc_reg"),
        F.lit(None).cast("string").alias("international_id"),
    )
    triples = [("full_reg", "sire_reg", "dam_reg"), ("sire_reg", "ss", "sd")]
    out = PB.registry_rows(wide_rows(t), triples, _REG, register, None)
    return out.select("full_reg", "sire_reg", "dam_reg", "sex", "lab_id")


@query(
    "H5_combine",
    """with u as (select 'S' || full_reg as full_reg, 'S' || sire_reg as sire_reg, 'S' || dam_reg as dam_reg, full_reg + 100000 as lab_id from pedigree
         union select 'S' || full_reg, case when full_reg % 6 = 0 then 'S99' else 'S' || sire_reg end, 'S' || dam_reg, null from pedigree where dam_reg > 0)
       select full_reg, case when count(distinct sire_reg) > 1 then '0' else min(sire_reg) end as sire_reg, case when min(dam_reg) = full_reg then '0' else min(dam_reg) end as dam_reg, max(lab_id) as lab_id
       from u group by full_reg""",
)
def _(t):
    s = lambda c: F.concat(F.lit("S"), F.col(c))
    a = t.pedigree.select(s("full_reg").alias("full_reg"), s("sire_reg").alias("sire_reg"), s("dam_reg").alias("dam_reg"), (F.col("full_reg") + 100000).alias("lab_id"))
    other = F.when(F.col("full_reg") % 6 == 0, F.lit("S99")).otherwise(s("sire_reg"))
    b = t.pedigree.filter("dam_reg > 0").select(s("full_reg").alias("full_reg"), other.alias("sire_reg"), s("dam_reg").alias("dam_reg"), F.lit(None).cast("bigint").alias("lab_id"))
    return PB.combine([a, b]).select("full_reg", "sire_reg", "dam_reg", "lab_id")


@query(
    "H5_orphans",
    """select c_custkey as temp_id, case c_custkey % 3 when 0 then 'HER' || c_custkey else c_custkey::varchar end as full_reg,
       case when c_custkey % 3 = 0 then 'HER' || (c_custkey + 1) when c_custkey % 3 = 1 then 'AAA' || (c_custkey + 1) end as sire_reg
       from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')""",
)
def _(t):
    k = F.col("c_custkey")
    ids = [k.alias("lab_id"), F.lit("F1").alias("farm_id"), F.concat(F.lit("A"), k).alias("animal_id"), k.alias("temp_id")]
    animals = t.customer.select(*ids, k.cast("string").alias("registration_number"))
    known = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct().select(*ids)
    none = F.lit(None).cast("string")
    register = t.customer.select(
        k.alias("lab_id"), F.when(k % 3 == 0, "HER").alias("assoc"), (k + 1).cast("string").alias("sire_reg"),
        F.when(k % 3 == 0, "HER").when(k % 3 == 1, "AAN").alias("sire_assoc"), none.alias("dam_reg"), none.alias("dam_assoc"),
    )
    out = PB.orphan_rows(animals, known, register)
    return out.select("temp_id", "full_reg", "sire_reg")


@query(
    "H6_sex_from_role",
    """select full_reg, sire_reg, dam_reg, case when full_reg in (select sire_reg from pedigree) then 'M' else 'F' end as sex from pedigree""",
)
def _(t):
    return D.sex_from_role(t.pedigree).select("full_reg", "sire_reg", "dam_reg", "sex")


_GROUPS = f"""with f as (select * from records where sex = 'F'),
    s as (select * exclude (season), coalesce(last_value(season ignore nulls) over (w rows between unbounded preceding and current row), first_value(season ignore nulls) over (w rows between current row and unbounded following)) as season
          from f window w as (partition by farm_id, temp_id order by score_date, rec_a, rec_b)),
    g as (select *, case when age = 1 then 'yearling' when age in (2, 3) then 'growing' when age between 4 and 9 then 'mature' when age >= 10 then 'old' end as age_group from s),
    c as (select *, farm_id || year || coalesce(season, 'NA') || coalesce(age_group, 'NA') || '1' as cg from g),
    k as (select * from c qualify count(*) over (partition by cg) >= 5 and var_samp(score) over (partition by cg) <> 0)"""


@query("H7_contemporary_groups", f"{_GROUPS} select cg, count(*) as n, round(avg(score), 6) as mean_score, round(stddev_samp(score), 6) as sd_score from k group by cg")
def _(t):
    groups = M.contemporary_groups(t.records)
    return groups.groupBy("cg").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("score")).alias("mean_score"), r6(F.stddev_samp("score")).alias("sd_score")
    )


@query("H8_model_groups", f"{_GROUPS} select temp_id as full_reg, cg, score, count(*) as n from k group by all")
def _(t):
    rows = M.model_dataset(t.records.withColumn("full_reg", F.col("temp_id")), "fixed9")
    return rows.groupBy("full_reg", "cg", "score").agg(F.count(F.lit(1)).alias("n"))


_ENV = """e as (select r.*, (rec_a % 40) / 2.0::double as temp, 10 + (rec_b % 7)::double as len, case when rec_a % 6 = 0 then null when rec_a % 2 = 0 then 'YES' else 'NO' end as fescue from records r where sex = 'F')"""


@query(
    "H8_model_interaction",
    f"""with {_ENV}, s as (select * exclude (season), coalesce(last_value(season ignore nulls) over (w rows between unbounded preceding and current row), first_value(season ignore nulls) over (w rows between current row and unbounded following)) as season
          from e window w as (partition by farm_id, temp_id order by score_date, rec_a, rec_b)),
       g as (select *, case when age = 1 then 'yearling' when age in (2, 3) then 'twothree' when age between 4 and 7 then 'mature' when age >= 8 then 'old' end as age_group from s),
       k as (select * from g where season is not null and fescue is not null and age_group is not null qualify count(*) over (partition by age_group) >= 5)
       select year, season, fescue, age_group, count(*) as n, round(sum((temp - (select avg(temp) from k)) * (len - (select avg(len) from k))), 3) as centred, sum(score)::bigint as score from k group by all""",
)
def _(t):
    rows = t.records.withColumns(
        {
            "mean_apparent_high": (F.col("rec_a") % 40) / 2.0, "mean_day_length": (10 + F.col("rec_b") % 7).cast("double"),
            "fescue": F.when(F.col("rec_a") % 6 == 0, F.lit(None)).when(F.col("rec_a") % 2 == 0, "YES").otherwise("NO"), "full_reg": F.col("temp_id"),
        }
    )
    out = M.model_dataset(rows, "fixed13")
    return out.groupBy("year", "season", "fescue", "age_group").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("centred_product"), 3).alias("centred"), F.sum("score").alias("score")
    )


_VALUES = {"mean_apparent_high": "((rec_a % 40) / 2.0::double)", "mean_day_length": "(10 + (rec_b % 7)::double)", "lat": "((rec_b % 5) * 1.5::double)"}
_NO_GROUPS = _ENV + """, s as (select * exclude (season), coalesce(last_value(season ignore nulls) over (w rows between unbounded preceding and current row),
          first_value(season ignore nulls) over (w rows between current row and unbounded following)) as season from e window w as (partition by farm_id, temp_id order by score_date, rec_a, rec_b)),
       g as (select *, case when age = 1 then 'yearling' when age in (2, 3) then 'twothree' when age between 4 and 7 then 'mature' when age >= 8 then 'old' end as age_group from s),
       k as (select * from g where season is not null and fescue is not null and age_group is not null qualify count(*) over (partition by age_group) >= 5)"""


def model_query(model, spec):
    """One environment model: counts and sums of its columns per level of its effects."""
    effects = ["cg"] if spec.get("groups") else ["year", "season", "fescue", "age_group"]
    values = {**{c: _VALUES[c] for c in spec.get("env", [])}, **({"PC1": "(p_size / 4.0::double)", "PC2": "p_size::double"} if "scores" in spec else {})}
    source = "k join part on temp_id = p_partkey and p_size <= 30" if spec.get("genotyped") else "k"
    sums = "".join(f", round(sum({text}), 3) as {c.lower()}" for c, text in values.items())
    start = _GROUPS if spec.get("groups") else "with " + _NO_GROUPS
    sql = f"{start} select {', '.join(effects)}, count(*) as n, sum(score)::bigint as score{sums} from {source} group by all"

    def run(t):
        fescue = {} if spec.get("groups") else {"fescue": F.when(F.col("rec_a") % 6 == 0, F.lit(None)).when(F.col("rec_a") % 2 == 0, "YES").otherwise("NO")}
        rows = t.records.withColumns(
            {
                "mean_apparent_high": (F.col("rec_a") % 40) / 2.0, "mean_day_length": (10 + F.col("rec_b") % 7).cast("double"),
                "lat": (F.col("rec_b") % 5) * 1.5, "full_reg": F.col("temp_id"), **fescue,
            }
        )
        known = t.part.filter("p_size <= 30").select(F.col("p_partkey").alias("full_reg"), (F.col("p_size") / 4.0).alias("PC1"), F.col("p_size").cast("double").alias("PC2"))
        out = M.model_dataset(rows, model, genotyped=known, scores=known)
        return out.groupBy(*effects).agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"), *[r6(F.sum(c), 3).alias(c.lower()) for c in values])

    query(f"H8_model_{model}", sql)(run)


for _model, _spec in M.MODELS.items():
    if _model not in ("fixed9", "fixed13"):
        model_query(_model, _spec)


@query(
    "H14_removal_ids",
    """select c_custkey as full_reg, 'I' || c_custkey as international_id from customer where c_custkey % 4 = 0 and c_nationkey = 3""",
)
def _(t):
    k = F.col("c_custkey")
    remove = t.customer.filter("c_nationkey = 3").select(k.alias("full_reg"))
    key = t.customer.filter(k % 4 == 0).select(k.alias("full_reg"), F.concat(F.lit("I"), k).alias("international_id"))
    return Z.removal_ids(remove, key)


@query("H14_population_file", """select c_custkey as family, c_nationkey as sire, 'cow' as pop from customer""")
def _(t):
    family = t.customer.select(F.col("c_custkey").alias("family"), F.col("c_nationkey").alias("sire"), F.col("c_acctbal").alias("phenotype"))
    return Z.population_file(family)


@query(
    "H15_submission_samples",
    """select distinct l_orderkey as iid, 'A' || temp_id as id from (select l_orderkey, l_partkey from lineitem where l_returnflag in ('A', 'R')) join (select distinct temp_id from records where score = 5) on l_partkey = temp_id""",
)
def _(t):
    samples = t.lineitem.select(F.col("l_orderkey").alias("iid"), F.col("l_partkey").alias("lab_id"), F.col("l_returnflag").alias("assay"))
    released = t.records.filter("score = 5").select(F.col("temp_id").alias("lab_id"), F.concat(F.lit("A"), "temp_id").alias("id"))
    return Z.submission_samples(samples, released, ["A", "R"])


@query(
    "H1_key_duplicates",
    """with k as (select concat('F', cast(o_custkey % 20 as string)) as farm_id, 'R' || (o_custkey % 40) as registration_number, 'A' || o_custkey as animal_id, case when o_custkey % 5 > 0 then 'B' || (o_custkey % 300) end as barcode, o_custkey as lab_id from orders group by o_custkey)
       select 'registration_number' as id, k.* from k qualify count(*) over (partition by farm_id, registration_number) > 1
       union all select 'animal_id', k.* from k qualify count(*) over (partition by farm_id, animal_id) > 1
       union all select 'barcode', k.* from k where barcode is not null qualify count(*) over (partition by farm_id, barcode) > 1""",
)
def _(t):
    o = F.col("o_custkey")
    keys = t.orders.select(
        F.concat(F.lit("F"), o % 20).alias("farm_id"), F.concat(F.lit("R"), o % 40).alias("registration_number"), F.concat(F.lit("A"), o).alias("animal_id"),
        F.when(o % 5 > 0, F.concat(F.lit("B"), o % 300)).alias("barcode"), o.alias("lab_id"),
    ).distinct()
    found = C.key_duplicates(keys)
    parts = [found[c].select(F.lit(c).alias("id"), "farm_id", "registration_number", "animal_id", "barcode", "lab_id") for c in ("registration_number", "animal_id", "barcode")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "H3_stacked_sheets",
    """select o_custkey as animal_id, o_orderkey as k, o_orderdate::date as score_date, (o_orderkey % 5)::bigint as score from orders where o_orderkey % 5 <> 0
       union all select o_custkey, o_orderkey, (o_orderdate + interval 1 day)::date, (o_orderkey % 3)::bigint from orders where o_orderkey % 3 <> 0
       union all select l_partkey, l_orderkey, l_shipdate::date, l_linenumber::bigint from lineitem""",
)
def _(t):
    k = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    first = t.orders.select(
        F.col("o_custkey").alias("animal_id"), k.alias("k"), day.alias("date_1"), F.when(k % 5 != 0, k % 5).alias("score_1"),
        F.date_add(day, 1).alias("date_2"), F.when(k % 3 != 0, k % 3).alias("score_2"),
    )
    second = t.lineitem.select(
        F.col("l_partkey").alias("animal_id"), F.col("l_orderkey").alias("k"), F.col("l_shipdate").cast("date").alias("d"), F.col("l_linenumber").cast("bigint").alias("s")
    )
    out = C.herd_sheets([first, second], [[("date_1", "score_1"), ("date_2", "score_2")], [("d", "s")]], ["animal_id", "k"])
    return out.filter("score is not null").select("animal_id", "k", "score_date", "score")


@query(
    "H4_best_shares",
    """with a as (select p_partkey as r, p_brand as c, p_type as s from part where p_size > 20 union select p_partkey, case when p_size > 30 then 'A' end, 'z' from part where p_size > 10)
       select r as registration_number, c as cross_label, s as brd_source from a qualify row_number() over (partition by r order by c nulls last, s) = 1""",
)
def _(t):
    r = F.col("p_partkey").alias("registration_number")
    one = t.part.filter("p_size > 20").select(r, F.col("p_brand").alias("cross"), F.col("p_type").alias("brd_source"))
    two = t.part.filter("p_size > 10").select(r, F.when(F.col("p_size") > 30, "A").alias("cross"), F.lit("z").alias("brd_source"))
    return B.best_shares([one, two]).withColumnRenamed("cross", "cross_label")


@query(
    "H8_environment",
    """with w as (select user_id % 20 as site, ts::date - 10227 as day, avg(value) as hi from events group by all), d as (select distinct farm_id, score_date from records),
       j as (select d.farm_id, d.score_date, hi from d join w on farm_id = 'F' || site and day <= score_date qualify rank() over (partition by d.farm_id, d.score_date order by day desc) <= 5),
       p as (select farm_id, score_date, round(avg(hi), 9) as hi from j group by all)
       select rec_a, rec_b, temp_id, r.farm_id, r.score_date, hi from records r left join p on r.farm_id = p.farm_id and r.score_date = p.score_date""",
)
def _(t):
    day = F.date_sub(F.col("ts").cast("date"), 10227)  # the days of the events, moved into the years of the records
    weather = t.events.groupBy((F.col("user_id") % 20).cast("double").alias("lat"), day.alias("value")).agg(F.avg("value").alias("apparent_high"))
    weather = weather.withColumns({"long": F.lit(1.0), "day_length": F.lit(12.0)})
    places = t.records.select("farm_id").distinct().withColumns({"lat": F.substr("farm_id", F.lit(2)).cast("double"), "long": F.lit(1.0)})
    out = M.environment(t.records, weather, places, 5, within=None)
    return out.select(*ROW, r6("mean_apparent_high", 9).alias("hi"))


@query(
    "H9_breed_subset",
    """select rec_a, rec_b, temp_id, farm_id, score_date from records join part on temp_id = p_partkey where p_brand in ('Brand#1', 'Brand#2') or p_size >= 40""",
)
def _(t):
    herds = t.records.select("farm_id", "temp_id").distinct()
    key = herds.join(t.part.select(F.col("p_partkey").alias("temp_id"), "p_brand", "p_size"), "temp_id")
    cond = F.col("p_brand").isin("Brand#1", "Brand#2") | (F.col("p_size") >= 40)
    return M.breed_subset(t.records, key, cond).select(*ROW)


@query(
    "H10_year_files",
    f"""{_GROUPS.replace("k as (select * from c qualify count(*) over (partition by cg) >= 5 and var_samp(score) over (partition by cg) <> 0)", "k as (select * from c)")},
       n as (select cg, row_number() over (order by md5(cg), cg) as cg_num from (select distinct cg from k)),
       p as (select k.*, cg_num from k join n on k.cg = n.cg qualify row_number() over (partition by farm_id, temp_id, year order by abs(date_diff('day', make_date(year, 5, 1), score_date)), score_date, rec_a, rec_b) = 1),
       o as (select p.*, case when temp_id % 2 = 0 then 'P' || temp_id else 'AAAR' || temp_id end as full_reg from p qualify row_number() over (partition by case when temp_id % 2 = 0 then 'P' || temp_id else 'AAAR' || temp_id end, year order by score_date, score_date, rec_a, rec_b, farm_id) = 1)
       select year, full_reg, o.temp_id as iid, score, cg_num from o join part on temp_id = p_partkey where p_size <= 30""",
)
def _(t):
    rows = t.records.withColumns(
        {"breed_code": F.lit("AN"), "registration_number": F.concat(F.lit("R"), "temp_id"), "animal_id": F.lit("A")}
    )
    ped = t.records.select("farm_id", "temp_id").distinct().filter(F.col("temp_id").isNotNull())
    ped = ped.withColumn("full_reg", F.when(F.col("temp_id") % 2 == 0, F.concat(F.lit("P"), "temp_id")))
    k = F.col("p_partkey")
    full = F.when(k % 2 == 0, F.concat(F.lit("P"), k)).otherwise(F.concat(F.lit("AAAR"), k))
    genotyped = t.part.filter("p_size <= 30").select(full.alias("full_reg"), k.alias("iid"))
    return M.year_files(rows, ped, genotyped, ["score_date", "rec_a", "rec_b", "farm_id"])


@query(
    "H11_adjusted_phenotype",
    """with b as (select s_suppkey as cg, s_acctbal / 1000 as sol from supplier) select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity - sol, 6) as adj from lineitem join b on l_suppkey = cg""",
)
def _(t):
    levels = t.supplier.select(F.lit(1).alias("effect"), F.col("s_suppkey").cast("string").alias("id_original"), (F.col("s_suppkey") + 7).alias("id_renamed"))
    sol = t.supplier.select(F.lit(1).alias("effect"), (F.col("s_suppkey") + 7).alias("id_renamed"), (F.col("s_acctbal") / 1000).alias("solution"))
    rows = t.lineitem.withColumnsRenamed({"l_suppkey": "cg_num", "l_quantity": "score"})
    out = M.adjusted_phenotype(rows, levels, sol)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("cg_num").alias("l_suppkey"), r6("adj_score").alias("adj"))


@query(
    "H12_environment_tables",
    """with o as (select * from records qualify row_number() over (partition by temp_id order by md5(concat_ws('|', rec_a, rec_b, temp_id, farm_id, score_date, 'h12')), rec_a, rec_b, temp_id, farm_id, score_date) = 1)
       select p_partkey as ord, p_partkey as full_reg, score as adj_score, year as env from part left join o on p_partkey = temp_id""",
)
def _(t):
    family = t.part.select(F.col("p_partkey").alias("ord"), F.col("p_partkey").alias("full_reg"))
    rows = t.records.withColumns({"full_reg": F.col("temp_id"), "adj_score": F.col("score"), "env": F.col("year")})
    out = M.environment_tables(family, rows, "env", ROW, "h12")
    return out.select("ord", "full_reg", "adj_score", "env")


@query(
    "H13_validation_split",
    """with k as (select distinct temp_id from records), i as (select unnest([1, 2, 3]) as iter),
       r as (select iter, temp_id, row_number() over (partition by iter order by md5(concat_ws('|', temp_id, 'split' || iter)), temp_id) as n from k, i)
       select iter, count(*) as n_rows, count(*) filter (where n <= m) as n_masked, count(distinct temp_id) filter (where n <= m) as n_animals, sum(case when n <= m then -999 else score end)::bigint as total
       from records join r using (temp_id), (select round(count(*) * 0.25) as m from k) group by iter""",
)
def _(t):
    out = M.validation_split(t.records, "temp_id", "score", 0.25, 3)
    masked = F.col("score") == -999
    return out.groupBy("iter").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(masked).alias("n_masked"),
        F.count_distinct(F.when(masked, F.col("temp_id"))).alias("n_animals"), F.sum("score").cast("bigint").alias("total"),
    )


@query(
    "H14_rename_key",
    """with f as (select c_custkey, 'AANUSA' || case when c_custkey % 2 = 0 then 'M' else 'F' end || lpad(c_custkey::varchar, 12, '0') as international_id from customer)
       select international_id, case when c_acctbal > 0 then 'P' || c_custkey when c_custkey = 0 then 'AAA000000000000' else 'AAA' || c_custkey end as full_reg from f join customer using (c_custkey)""",
)
def _(t):
    k = F.col("c_custkey")
    iid = F.concat(F.lit("AANUSA"), F.when(k % 2 == 0, "M").otherwise("F"), F.lpad(k.cast("string"), 12, "0"))
    family = t.customer.select(iid.alias("international_id"))
    samples = t.customer.select(k.alias("lab_id"), iid.alias("international_id"))
    ped = t.customer.filter("c_acctbal > 0").select(k.alias("lab_id"), F.concat(F.lit("P"), k).alias("full_reg"))
    return Z.rename_key(family, samples, ped)


@query(
    "H15_anonymise",
    """select 'A0' || sha256(case when temp_id % 2 = 0 then temp_id::varchar else farm_id || '|A|' || temp_id end || 'k1') as id, year, score, count(*) as n from records group by all""",
)
def _(t):
    rows = t.records.withColumns({"animal_id": F.lit("A"), "lab_id": F.when(F.col("temp_id") % 2 == 0, F.col("temp_id"))})
    out = Z.anonymise(rows, ["year", "score"], "k1")
    return out.groupBy("id", "year", "score").agg(F.count(F.lit(1)).alias("n"))


_STUDIES = [1, 2, 3, 4, 5, 6, 7]


@query(
    "H16_meta_input",
    "select snp, "
    + ", ".join(f"round(arg_min(beta, (p, beta, se)) filter (where study = {i}), 7) as b_{i}, round(arg_min(se, (p, beta, se)) filter (where study = {i}), 7) as se_{i}" for i in _STUDIES)
    + " from gwas group by snp",
)
def _(t):
    return G.meta_input(t.gwas, ["snp"], "study", _STUDIES, ["p"])


@query(
    "H17_conditional_input",
    f"""with g as (select snp, beta as b, se * se as v from gwas),
       h as (select snp, count(*) as k, sum(1 / v) as w, greatest(sum(b * b / v) - sum(b / v) * sum(b / v) / sum(1 / v), 0) as q, sum(1 / v / v) as ww from g group by snp),
       t as (select snp, case when w - ww / w > 0 then greatest((q - (k - 1)) / (w - ww / w), 0) else 0 end as tau2 from h),
       m as (select g.snp, sum(b / (v + tau2)) / sum(1 / (v + tau2)) as b, sqrt(1 / sum(1 / (v + tau2))) as se from g join t on g.snp = t.snp group by g.snp),
       f as (select snp, sum(dosage) / (2.0 * count(dosage)) as freq, count(dosage) as n from genotypes group by snp)
       select m.snp, 'A' as a1, 'G' || (m.snp % 3) as a2, round(freq, 6)::double as freq, round(b, 6) as b, round(se, 6) as se,
         round(case when abs(b / se) < 7 then {ERFC.format(x="(abs(b / se) / sqrt(2))")} else 0 end, 6) as p, round(n, 6)::double as n from m join f on m.snp = f.snp where freq <> 0""",
)
def _(t):
    from herdframe.operators.genotypes import allele_stats

    meta = G.meta_analysis(t.gwas, ["snp"]).withColumn("adj_p", F.col("pvalue_re"))
    alleles = [F.lit("A").alias("a1"), F.concat(F.lit("G"), F.col("snp") % 3).alias("a2")]
    freq = allele_stats(t.genotypes).select("snp", *alleles, "freq", "nchrobs")
    out = G.conditional_input(meta, freq, ["snp"])
    return out.select("snp", "a1", "a2", *[r6(c).alias(c) for c in ("freq", "b", "se", "p", "n")])


@query(
    "H18_solution_table",
    """select case when p_size % 3 = 1 then 'season' else 'fescue' end as effect, case when p_partkey % 4 <> 0 then p_name end as id_original, p_partkey as id_renamed, round(p_retailprice / 1000, 6) as solution
       from part where p_size % 3 in (1, 2)""",
)
def _(t):
    effect = (F.col("p_size") % 3).cast("int")
    sol = t.part.select(effect.alias("effect"), F.col("p_partkey").alias("id_renamed"), (F.col("p_retailprice") / 1000).alias("solution"), F.lit(0.1).alias("se"))
    levels = t.part.select(effect.alias("effect"), F.col("p_partkey").alias("id_renamed"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_name")).alias("id_original"))
    out = RP.solution_table(sol, levels, {1: "season", 2: "fescue"})
    return out.select("effect", "id_original", "id_renamed", r6("solution").alias("solution"))


@query(
    "H19_relative_effects",
    """select p_partkey, case when p_type = 'ECONOMY' then '14' else p_type end as id_original, round(p_retailprice - 950.5, 6) as rel_solution, p_retailprice - 950.5 > 0 as positive from part""",
)
def _(t):
    sol = t.part.select("p_partkey", F.col("p_type").alias("id_original"), F.col("p_retailprice").alias("solution"))
    out = RP.relative_effects(sol, 950.5, {"ECONOMY": "14"})
    return out.select("p_partkey", "id_original", r6("rel_solution").alias("rel_solution"), "positive")


@query(
    "H20_region_table",
    """with m as (select distinct chr, pos from gwas where p < 0.005), near as (select m.chr, pos, gene_id, start_pos, end_pos from m join genes g on m.chr = g.chr and pos between start_pos - 300 and end_pos + 300),
       far as (select m.chr, pos, gene_id, start_pos, end_pos from m join genes g on m.chr = g.chr and pos between start_pos - 4000 and end_pos + 4000 where (m.chr, pos) not in (select chr, pos from near)
         qualify row_number() over (partition by m.chr, pos order by least(abs(pos - start_pos), abs(pos - end_pos)), start_pos, end_pos, gene_id) = 1),
       a as (select *, case when chr = 5 and pos between 0 and 50000 then 1 when chr = 5 and pos between 50001 and 100000 then 2 end as peak from (select * from near union all select * from far))
       select chr, pos, gene_id, peak, least(abs(pos - start_pos), abs(pos - end_pos)) as distance, count(*) over (partition by peak, gene_id) as n from a""",
)
def _(t):
    m = t.gwas.filter("p < 0.005").select("chr", "pos").distinct()
    out = RP.region_table(m, t.genes, [(1, 5, 0, 50000), (2, 5, 50001, 100000)], 300, 4000)
    return out.select("chr", "pos", "gene_id", "peak", "distance", "n")


@query(
    "H21_cnv_table",
    """select gene_id as cnvr, round(p_size / 154.0, 6)::double as freq, start_pos + 1000 as mapped_start from genes join part on gene_id = p_partkey where start_pos + 1000 between 20001 and 89999 and p_size > 5""",
)
def _(t):
    size = t.part.select(F.col("p_partkey").alias("gene_id"), F.col("p_size").alias("number_samples"))
    regions = t.genes.join(size, "gene_id").select(F.col("gene_id").alias("cnvr"), "chr", "start_pos", "end_pos", "number_samples")
    q = F.concat(F.lit("chr"), F.col("chr"), F.lit(":"), F.col("start_pos"), F.lit("-"), F.col("end_pos"))
    lifted = regions.filter("number_samples > 5").select(q.alias("query"), (F.col("start_pos") + 1000).alias("mapped_start"), (F.col("end_pos") + 1000).alias("mapped_end"))
    out = RP.cnv_table(regions, lifted.distinct(), 154, 20000, 90000)
    return out.select("cnvr", r6("freq").alias("freq"), "mapped_start").distinct()


@query(
    "H22_missing_registrations",
    """select distinct c_custkey::varchar as registration_number from customer where c_mktsegment = 'MACHINERY' and c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')""",
)
def _(t):
    rows = t.customer.select(F.col("c_custkey").cast("string").alias("registration_number"), "c_mktsegment")
    ped = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").cast("string").alias("full_reg")).distinct()
    return Z.missing_registrations(rows, ped, F.col("c_mktsegment") == "MACHINERY")
