"""Column operators."""

from pyspark.sql import functions as F

from herdframe.catalog.base import query
from herdframe.functions import records as R
from herdframe.functions import stats as S
from herdframe.functions import text as X
from herdframe.functions.base import if_else3, r6, recode, text_key
from herdframe.operators import checks as K
from herdframe.operators import shape as P


@query("B1_select_rename", "select o_orderkey as key, o_orderdate::date as o_orderdate, o_orderpriority, o_orderstatus from orders")
def _(t):
    out = P.select_columns(t.orders, "o_orderkey", "*date", "o_orderpriority", "o_order*", drop=("o_totalprice",))
    return out.withColumnRenamed("o_orderkey", "key").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query(
    "B2_across",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_discount * 100, 6) as l_discount, round(l_tax * 100, 6) as l_tax
       from lineitem where l_discount > 0 and l_tax > 0""",
)
def _(t):
    rows = P.filter_all(t.lineitem, ["l_discount", "l_tax"], lambda c: c > 0)
    out = P.across(rows, ["l_discount", "l_tax"], lambda c: r6(c * 100))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax")


@query(
    "B3_filter",
    """select p_partkey, p_size from part where p_size between 10 and 20 and p_type in ('ECONOMY', 'STANDARD') and p_brand <> 'Brand#1'""",
)
def _(t):
    keep = F.col("p_size").between(10, 20) & F.col("p_type").isin("ECONOMY", "STANDARD") & (F.col("p_brand") != "Brand#1")
    return t.part.filter(keep).select("p_partkey", "p_size")


@query(
    "B4_recode",
    """with d as (select o_orderkey, substr(o_orderpriority, 1, 1) as c, o_orderstatus from orders)
       select o_orderkey, case when c in ('1', '2') then 'F' when c = '3' then 'M' when c = '4' then null else c end as kept,
       case when c in ('1', '2') then 'F' when c = '3' then 'M' end as dropped,
       case when o_orderstatus = 'O' then 'SPRING' when o_orderstatus = 'F' then 'FALL' end as season from d""",
)
def _(t):
    code = F.substring("o_orderpriority", 1, 1)
    groups = {"F": ["1", "2"], "M": ["3"], None: ["4"]}
    text = recode("o_orderstatus", {"spring": ["O"], "fall": ["F"]})
    return t.orders.select(
        "o_orderkey", recode(code, groups).alias("kept"), recode(code, {"F": ["1", "2"], "M": ["3"]}, False).alias("dropped"),
        R.season_code(text).alias("season"),
    )


_AGED = """select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date) as scored, year(l_shipdate) as year,
    case l_partkey % 5 when 0 then null when 1 then '3 YEARS' when 2 then month(l_shipdate) || '/' || day(l_shipdate) || '/' || (year(l_shipdate) - l_partkey % 9)
      when 3 then cast(32000 + l_partkey % 4000 as varchar) else 'x' end as raw,
    case when l_partkey % 5 = 0 then make_date(1980 + l_partkey % 15, 6, 15) end as dob from lineitem"""


def _aged(t):
    m = F.col("l_partkey") % 5
    ship = F.col("l_shipdate")
    typed = F.concat_ws("/", F.month(ship), F.dayofmonth(ship), F.year(ship) - F.col("l_partkey") % 9)
    raw = (
        F.when(m == 1, "3 YEARS").when(m == 2, typed).when(m == 3, (32000 + F.col("l_partkey") % 4000).cast("string")).when(m == 4, "x")
    )
    dob = F.when(m == 0, F.make_date((1980 + F.col("l_partkey") % 15).cast("int"), F.lit(6), F.lit(15)))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ship.cast("date").alias("scored"), F.year(ship).alias("year"),
        raw.alias("raw"), dob.alias("dob"),
    )


@query(
    "B5_age_in_days",
    f"""with d as ({_AGED}) select l_orderkey, l_linenumber, l_partkey, l_suppkey, date_diff('day', coalesce(dob,
       case when raw like '%/%' then cast(try_strptime(raw, '%m/%d/%Y') as date) end,
       case when try_cast(raw as double) > 1000 then date '1899-12-30' + cast(raw as int) end), scored) as days from d""",
)
def _(t):
    return _aged(t).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", R.age_in_days("scored", "dob", "raw", "year").cast("bigint").alias("days")
    )


@query(
    "B6_age_class",
    """with d as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_orderkey * 31 + l_partkey * 17) % 9000 as days from lineitem)
       select d.*, case when days = 274 then 1 else (select cast(n as int) from range(1, 22) r(n)
         where days between 365 * n - 90 and 365 * n + 274) end as age_class from d""",
)
def _(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ((F.col("l_orderkey") * 31 + F.col("l_partkey") * 17) % 9000).alias("days")
    )
    return rows.withColumn("age_class", R.age_class("days"))


@query("B7_excel_serial", "select o_orderkey, date '1899-12-30' + cast(30000 + o_custkey % 15000 as int) as day from orders")
def _(t):
    return t.orders.select("o_orderkey", R.excel_serial_to_date(30000 + F.col("o_custkey") % 15000).alias("day"))


@query(
    "B8_season_default",
    """select o_orderkey, case when o_orderpriority = '1-URGENT' then 'SPRING' when o_orderpriority = '2-HIGH' then 'FALL'
       when o_orderstatus = 'O' then 'FALL' when month(o_orderdate) <= 6 then 'SPRING' else 'FALL' end as season from orders""",
)
def _(t):
    recorded = F.when(F.col("o_orderstatus") == "O", "FALL")
    rules = {"1-URGENT": "SPRING", "2-HIGH": "FALL"}
    return t.orders.select("o_orderkey", R.season_default("o_orderpriority", "o_orderdate", recorded, rules).alias("season"))


@query(
    "B9_age_group",
    """select rec_a, rec_b, temp_id, farm_id, score_date,
       case when age = 1 then 'yearling' when age in (2, 3) then 'growing' when age between 4 and 9 then 'mature' when age >= 10 then 'old' end as g1,
       case when age = 1 then 'yearling' when age in (2, 3) then 'twothree' when age between 4 and 7 then 'mature' when age >= 8 then 'old' end as g2,
       case when age = 1 then 'yearling' when age = 2 then 'fch' when age = 3 then 'three' when age >= 4 then 'mature' end as g3 from records""",
)
def _(t):
    groups = {"g1": "growing", "g2": "twothree", "g3": "first_calf"}
    return t.records.select(
        "rec_a", "rec_b", "temp_id", "farm_id", "score_date", *[R.age_group("age", b).alias(c) for c, b in groups.items()]
    )


@query(
    "B10_normalize_text",
    r"""select doc_id, md5(trim(regexp_replace(upper(replace(text, 'ß', 'ss')), '[ \t\n\x0B\f\r]+', ' ', 'g'))) as text_md5 from documents""",
)
def _(t):
    return t.documents.select("doc_id", F.md5(X.normalize_text("text")).alias("text_md5"))


@query(
    "B11_regex_extract",
    """with d as (select p_partkey, (p_partkey % 29 + 1) || ':' || (p_partkey * 37) as id, 'Records_F' || p_partkey || '_' || (2010 + p_partkey % 10) as name from part)
       select p_partkey, cast(split_part(id, ':', 1) as int) as chr, cast(split_part(id, ':', 2) as bigint) as pos,
       'F' || p_partkey as herd, cast(2010 + p_partkey % 10 as int) as year from d""",
)
def _(t):
    k = F.col("p_partkey")
    marker = F.concat_ws(":", k % 29 + 1, k * 37)
    name = F.concat(F.lit("Records_F"), k, F.lit("_"), 2010 + k % 10)
    return t.part.select(
        "p_partkey", X.chr_of(marker).alias("chr"), X.pos_of(marker).alias("pos"), X.group_from_name(name).alias("herd"),
        X.year_from_name(name).alias("year"),
    )


@query(
    "B12_string_tools",
    """select p_partkey, contains(p_name, 'red') as has_red, replace(p_name, ' ', '') as packed, lpad(p_partkey::varchar, greatest(4, length(p_partkey::varchar))::int, '0') as padded,
       upper(p_name[1]) || lower(p_name[2:]) as sentence, cast(length(p_name) as int) as n, split_part(p_name, ' ', 2) as second from part""",
)
def _(t):
    return t.part.select(
        "p_partkey", F.col("p_name").contains("red").alias("has_red"), X.strip_chars("p_name").alias("packed"),
        X.pad_left("p_partkey", 4).alias("padded"), X.sentence_case("p_name").alias("sentence"), F.length("p_name").alias("n"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("second"),
    )


@query(
    "B13_composite_id",
    """select rec_a, rec_b, temp_id, farm_id, score_date, farm_id || year || coalesce(season, 'NA') || coalesce(sex, 'NA') || coalesce(age::varchar, 'NA') as id from records""",
)
def _(t):
    return t.records.select(
        "rec_a", "rec_b", "temp_id", "farm_id", "score_date", text_key("farm_id", "year", "season", "sex", "age").alias("id")
    )


@query(
    "B14_international_id",
    "select c_custkey, 'ABCUSA' || case when c_custkey % 2 = 0 then 'F' else 'M' end || lpad(c_custkey::varchar, 12, '0') as id from customer",
)
def _(t):
    sex = F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M")
    return t.customer.select("c_custkey", X.padded_international_id("ABCUSA", sex, "c_custkey").alias("id"))


@query(
    "B15_prefix_registration",
    """with d as (select c_custkey as k, case c_custkey % 4 when 0 then null when 1 then 'AMAN' || c_custkey when 2 then 'AAA' || c_custkey else '' || c_custkey end as reg from customer)
       select k, case when reg is null then '0' when reg like 'AMAN%' then 'AAA' || substr(reg, 5) when reg like 'AAA%' then reg else 'GVH' || reg end as reg from d""",
)
def _(t):
    k = F.col("c_custkey")
    reg = F.when(k % 4 == 1, F.concat(F.lit("AMAN"), k)).when(k % 4 == 2, F.concat(F.lit("AAA"), k)).when(k % 4 == 3, k.cast("string"))
    out = X.prefix_registration(reg, ["AAA", "SIM", "RAN", "BSW"], {"AMAN": "AAA", "AMSM": "SIM"}, "GVH")
    return t.customer.select(k.alias("k"), out.alias("reg"))


@query(
    "B16_infer_prefix",
    """with d as (select c_custkey as k, case c_custkey % 7 when 0 then 'F' when 1 then 'EF' when 2 then 'M' when 3 then 'EM' else '' end || (c_custkey * 7) as num,
         case when c_custkey % 11 = 0 then 'SIM' end as own, case when c_custkey % 13 = 0 then 'SAV1' else '5' end as calf,
         coalesce(list_extract(['HER', 'AAA', 'CHA', 'RDP'], (c_custkey % 5)::int), '') as s, coalesce(list_extract(['HER', 'AAA', 'CHA', 'RDP'], (c_custkey // 5 % 5)::int), '') as m from customer),
       r as (select *, case when own is not null then own when s = m and s in ('HER', 'CHA', 'RDP') then s when s = 'AAA' and m = 'AAA' and num like '1%' then 'AAA'
         when 'HER' in (s, m) and num like '4%' then 'HER' end as base from d)
       select k, coalesce(base, '') || num as animal,
         coalesce(base, case when calf like 'SAV%' and num like '4%' then 'HER' when calf like 'SAV%' and num like 'M%' then 'CHA' when calf like 'SAV%' and num like '1%' then 'AAA'
           when 'AAA' in (s, m) and num like '1%' then 'AAA' when s = 'CHA' and (num like 'M%' or num like 'EM%') then 'CHA' when m = 'CHA' and num like 'M%' then 'CHA'
           when 'RDP' in (s, m) and num not like '1%' then 'RDP' end, '') || num as sire,
         coalesce(base, case when 'AAA' in (s, m) and num like '1%' then 'AAA' when s = 'CHA' and (num like 'F%' or num like 'EF%') then 'CHA' when m = 'CHA' and num like 'F%' then 'CHA'
           when 'RDP' in (s, m) and num not like '1%' then 'RDP' end, '') || num as dam from r""",
)
def _(t):
    k = F.col("c_custkey")
    registries = F.array(F.lit(None).cast("string"), *map(F.lit, ["HER", "AAA", "CHA", "RDP"]))
    d = t.customer.select(
        k.alias("k"), F.concat(F.get(F.array(*map(F.lit, ["F", "EF", "M", "EM", "", "", ""])), (k % 7).cast("int")), (k * 7).cast("string")).alias("num"),
        F.when(k % 11 == 0, "SIM").alias("own"), F.when(k % 13 == 0, "SAV1").otherwise("5").alias("calf"),
        F.get(registries, (k % 5).cast("int")).alias("s"), F.get(registries, (F.floor(k / 5) % 5).cast("int")).alias("m"),
    )
    return d.select(
        "k", X.infer_prefix("num", "own", "s", "m").alias("animal"), X.infer_prefix("num", "own", "s", "m", "sire", "calf").alias("sire"),
        X.infer_prefix("num", "own", "s", "m", "dam").alias("dam"),
    )


@query(
    "B17_fraction_text",
    """with d as (select p_partkey as k, case p_partkey % 4 when 0 then 'PB AR' when 1 then (p_partkey % 3 + 1) || '/4 AR 1/4 SM'
         when 2 then (p_partkey % 90) || '.5% AR' else '3/4 SM' end as txt from part)
       select k, round(case k % 4 when 0 then 1.0 when 1 then (k % 3 + 1) / 4.0 when 2 then (k % 90 + 0.5) / 100 end, 6)::double as ar from d""",
)
def _(t):
    k = F.col("p_partkey")
    text = (
        F.when(k % 4 == 0, "PB AR").when(k % 4 == 1, F.concat(k % 3 + 1, F.lit("/4 AR 1/4 SM")))
        .when(k % 4 == 2, F.concat(k % 90, F.lit(".5% AR"))).otherwise("3/4 SM")
    )
    return t.part.select(k.alias("k"), r6(R.fraction_of(text, "AR")).alias("ar"))


_SHARES = """select registration_number, sum(case when brd = '1' then pct else 0 end) as an, sum(case when brd = '2' then pct else 0 end) as ar,
    sum(case when brd = '3' then pct else 0 end) as hp, sum(case when brd = '4' then pct else 0 end) as hh,
    sum(case when brd = '5' then pct else 0 end) as sim from fractions group by 1"""


def _shares(t):
    names = {"1": "an", "2": "ar", "3": "hp", "4": "hh", "5": "sim"}
    cells = [F.sum(F.when(F.col("brd") == b, F.col("pct")).otherwise(0.0)).alias(n) for b, n in names.items()]
    return t.fractions.groupBy("registration_number").agg(*cells)


@query(
    "B18_breed_merge",
    f"""with d as ({_SHARES}) select registration_number, round(least(hp + hh, 1), 6) as hfd,
       round(least(case when ar <> 0 and an <> 0 and hp + hh = 0 and sim = 0 then ar + an else ar end, 1), 6) as ar,
       case when round(an, 9) = 1 then 'AN' when round(ar, 9) = 1 then 'AR' when round(sim, 9) = 1 then 'SIM' else 'CROS' end as label from d""",
)
def _(t):
    d = _shares(t).withColumn("hfd", R.merge_breeds(["hp", "hh"]))
    label = R.pure_label({"AN": "an", "AR": "ar", "SIM": "sim"})
    return d.select("registration_number", r6("hfd").alias("hfd"), r6(R.red_angus_share("ar", "an", ["hfd", "sim"])).alias("ar"), label.alias("label"))


@query(
    "B19_breed_label",
    f"""with d as ({_SHARES}) select registration_number, case when an >= 0.625 then 'Angus' when sim >= 0.625 then 'Simmental'
       when ar >= 0.625 then 'Red Angus' else 'Crossbred or other' end as breed from d""",
)
def _(t):
    shares = {"Angus": "an", "Simmental": "sim", "Red Angus": "ar"}
    return _shares(t).select("registration_number", R.dominant_breed(shares).alias("breed"))


@query(
    "B20_date_functions",
    """with d as (select o_orderkey, strftime(o_orderdate, '%m/%d/%Y') as s, o_orderdate::date as day, o_custkey from orders)
       select o_orderkey, day, cast(year(day) as int) as y, cast(month(day) as int) as m, cast(date_diff('day', date '1992-01-01', day) as int) as days,
       make_timestamp(o_custkey * 86400 * 1000000) as ts from d""",
)
def _(t):
    text = F.date_format("o_orderdate", "MM/dd/yyyy")
    day = F.try_to_date(text, "M/d/yyyy")
    return t.orders.select(
        "o_orderkey", day.alias("day"), F.year(day).alias("y"), F.month(day).alias("m"),
        F.date_diff(day, F.lit("1992-01-01").cast("date")).alias("days"),
        F.timestamp_seconds(F.col("o_custkey") * 86400).cast("timestamp_ntz").alias("ts"),
    )


@query("B21_unit_convert", "select event_id, round((value - 32) * 5 / 9, 6) as c from events")
def _(t):
    return t.events.select("event_id", r6(R.f_to_c("value")).alias("c"))


@query(
    "B22_math",
    """select study, snp, chr, pos, round(-log10(p), 6) as neglog10p, round(abs(beta) / se, 6) as z, round(exp(beta), 6) as odds, round(sqrt(se), 6) as root,
       round(greatest(beta, 0.0), 7) as positive from gwas""",
)
def _(t):
    return t.gwas.select(
        "study", "snp", "chr", "pos", r6(-F.log10("p")).alias("neglog10p"), r6(F.abs("beta") / F.col("se")).alias("z"),
        r6(F.exp("beta")).alias("odds"), r6(F.sqrt("se")).alias("root"), r6(F.greatest(F.col("beta"), F.lit(0.0)), 7).alias("positive"),
    )


@query("B23_coalesce", "select rec_a, rec_b, temp_id, farm_id, score_date, coalesce(season, 'NA') as season, coalesce(age, score) as age from records")
def _(t):
    out = t.records.na.fill({"season": "NA"}).withColumn("age", F.coalesce("age", "score"))
    return out.select("rec_a", "rec_b", "temp_id", "farm_id", "score_date", "season", "age")


@query(
    "B24_verify",
    """select 'score' as rule, count(*) filter (where not coalesce(score between 1 and 5, false)) as n_violations from records
       union all select 'age', count(*) filter (where not coalesce(age between 1 and 22, false)) from records
       union all select 'sex', count(*) filter (where not coalesce(sex in ('F', 'M'), false)) from records""",
)
def _(t):
    rows = K.verify(t.records, F.col("score").between(1, 5), "score")
    rules = {"score": F.col("score").between(1, 5), "age": F.col("age").between(1, 22), "sex": F.col("sex").isin("F", "M")}
    return K.violations(rows, rules)


@query(
    "B25_no_fanout",
    """select (select count(*) from orders) as n_before, (select count(*) from orders left join customer on o_custkey = c_custkey) as n_after""",
)
def _(t):
    right = t.customer.select(F.col("c_custkey").alias("k"))
    return K.fanout(t.orders.select(F.col("o_custkey").alias("k")), right, ["k"])


@query(
    "B26_labels",
    """select gene_id, format('{:,}', start_pos) as start_text, chr || ':' || format('{:,}', start_pos) || case when start_pos = end_pos then ''
       else '-' || format('{:,}', end_pos) end as span from genes""",
)
def _(t):
    return t.genes.select("gene_id", X.with_thousands("start_pos").alias("start_text"), X.span_label("chr", "start_pos", "end_pos").alias("span"))


@query(
    "B27_reliability",
    """with d as (select c_custkey, 0.05 + (c_custkey % 50) / 100.0 as se, (c_custkey % 7) / 100.0 as f from customer)
       select c_custkey, round(1 - se * se / ((1 + f) * 0.33133), 6)::double as rel, round(1 - sqrt(se * se / ((1 + f) * 0.33133)), 6) as bif,
       round(greatest(0, 1 - se * se / ((1 + f) * 0.1)), 6)::double as floored from d""",
)
def _(t):
    k = F.col("c_custkey")
    d = t.customer.select(k, (0.05 + (k % 50) / 100.0).alias("se"), ((k % 7) / 100.0).alias("f"))
    u = F.lit(0.33133)
    return d.select(
        "c_custkey", r6(S.reliability(u, "se", "f")).alias("rel"), r6(S.reliability(u, "se", "f", "bif")).alias("bif"),
        r6(S.reliability(F.lit(0.1), "se", "f", floor=True)).alias("floored"),
    )


@query(
    "B28_deregress",
    """with d as (select c_custkey, c_acctbal / 1000 as ebv, 0.3 + (c_custkey % 60) / 100.0::double as r2, (c_custkey % 9) / 10.0::double as s, 0.2 + (c_custkey % 5) / 10.0::double as rs,
         (c_custkey % 8) / 10.0::double as m, 0.1 + (c_custkey % 4) / 10.0::double as rm from customer),
       e as (select *, (1 - 0.4::double) / 0.4 as lam, (s + m) / 2 as pa, 0.5 - (rs + rm) / 4 as den from d),
       g as (select *, 1 / den as a, den / (1 - r2) as dl from e),
       h as (select *, lam * (0.5 * a - 4) + 0.5 * lam * sqrt(a * a + 16 / dl) as zp from g),
       i as (select *, dl * zp + 2 * lam * (2 * dl - 1) as zz from h)
       select c_custkey, round((-2 * lam * pa + (zz + 2 * lam) * ebv) / zz, 6) as drp, round(1 - lam / (zz + lam), 6) as drp_r2 from i""",
)
def _(t):
    k = F.col("c_custkey")
    d = t.customer.select(
        k, (F.col("c_acctbal") / 1000).alias("ebv"), (0.3 + (k % 60) / 100.0).alias("r2"), ((k % 9) / 10.0).alias("s"),
        (0.2 + (k % 5) / 10.0).alias("rs"), ((k % 8) / 10.0).alias("m"), (0.1 + (k % 4) / 10.0).alias("rm"),
    )
    out = S.deregress("ebv", "r2", "s", "rs", "m", "rm", h2=0.4)
    return d.select("c_custkey", r6(out["drp"]).alias("drp"), r6(out["drp_r2"]).alias("drp_r2"))


# erfc by its Taylor series, for moderate arguments; independent of the rational approximations in use
ERFC = (
    "(1 - 2 / sqrt(pi()) * exp(-({x}) * ({x})) * list_sum(list_transform(range(0, 80), "
    "lambda n: exp((2 * n + 1) * ln(greatest({x}, 1e-300)) + n * ln(2) - (lgamma(2 * n + 2) - n * ln(2) - lgamma(n + 1))))))"
)


@query(
    "B29_lrt",
    f"""with d as (select c_custkey, 0.1 + (c_custkey % 100) / 10.0::double as d from customer)
       select c_custkey, round(-log10({ERFC.format(x="sqrt(d / 2)")}) / 2, 6) as half_log, round(-log10({ERFC.format(x="sqrt(d / 2)")} / 2), 6) as half_p from d""",
)
def _(t):
    d = 0.1 + (F.col("c_custkey") % 100) / 10.0
    base = t.customer.select("c_custkey", d.alias("d"), F.lit(0.0).alias("z"))
    return base.select("c_custkey", r6(S.lrt_neglog10p("d", "z")).alias("half_log"), r6(S.lrt_neglog10p("d", "z", "mixture")).alias("half_p"))


@query(
    "B30_interaction",
    """select rec_a, rec_b, temp_id, farm_id, score_date, round((score - (select avg(score) from records)) * (year - (select avg(year) from records)), 6) as x from records""",
)
def _(t):
    means = t.records.agg(F.avg("score").alias("a"), F.avg("year").alias("b"))
    x = (F.col("score") - means.select("a").scalar()) * (F.col("year") - means.select("b").scalar())
    return t.records.select("rec_a", "rec_b", "temp_id", "farm_id", "score_date", r6(x).alias("x"))


@query("B31_clean_numeric", "select p_partkey, cast(p_size as double) as size from part")
def _(t):
    text = F.concat(F.lit("score: "), F.col("p_size"), F.lit(" (ok)"))
    return t.part.select("p_partkey", X.clean_numeric(text).alias("size"))


@query(
    "T4_three_valued_choice",
    "select rec_a, rec_b, temp_id, farm_id, score_date, case when age is null then null when age > 5 then 'old' else 'young' end as k from records",
)
def _(t):
    return t.records.select("rec_a", "rec_b", "temp_id", "farm_id", "score_date", if_else3(F.col("age") > 5, "old", "young").alias("k"))
