"""Variance components, pedigrees and validation of evaluations."""

from pyspark.sql import functions as F

from herdframe.catalog.base import query
from herdframe.catalog.columns import ERFC
from herdframe.functions.base import r6
from herdframe.operators import evaluation as E
from herdframe.operators import pedigree as D

_VC = """with d as (select o_orderpriority as run, sum(o_totalprice) / 1e9 as a, count(*) / 1000.0::double as b, avg(o_totalprice) / 1e6 as c from orders group by 1)"""


def varcomp(t):
    """Variance components per order priority in the melted layout of solver logs."""
    d = t.orders.groupBy(F.col("o_orderpriority").alias("run")).agg(
        (F.sum("o_totalprice") / 1e9).alias("a"), (F.count(F.lit(1)) / 1000.0).alias("b"), (F.avg("o_totalprice") / 1e6).alias("c")
    )
    cell = lambda x, y, v: F.struct(F.lit(x).alias("val1"), F.lit(y).alias("val2"), F.col(v).alias("var_cov"))
    names = [("ww_dir", "ww_dir", "a"), ("ww_dir", "ww_mat", "c"), ("ww_mat", "ww_dir", "c"), ("ww_mat", "ww_mat", "b"), ("ww_pe", "ww_pe", "c"), ("ww_res", "ww_res", "a")]
    names += [("hs_dir", "hs_dir", "b"), ("hs_pe", "hs_pe", "c"), ("hs_res", "hs_res", "a")]
    return d.select("run", F.inline(F.array(*[cell(*n) for n in names])))


@query(
    "J16_heritability",
    f"""{_VC} select run, 'Weight' as key, round(2 * a + b + 2 * c, 6) as total_variance, round(a / (2 * a + b + 2 * c), 6) as direct_h2, round(b / (2 * a + b + 2 * c), 6) as maternal_h2,
       round((a + c) / (2 * a + b + 2 * c), 6) as repeatability from d
       union all select run, 'Score', round(a + b + c, 6), round(b / (a + b + c), 6), null, round((b + c) / (a + b + c), 6) from d""",
)
def _(t):
    out = E.heritability(varcomp(t), {"ww": "Weight", "hs": "Score"}, ["run"], mat=True, pe=True)
    return out.select("run", "key", *[r6(c).alias(c) for c in ("total_variance", "direct_h2", "maternal_h2", "repeatability")])


# Coancestry of sire and dam: the younger of two animals is replaced by its parents until both are one. Ids rise with age here.
_COANCESTRY = """with recursive w as (select full_reg as x, greatest(sire_reg, dam_reg) as a, least(sire_reg, dam_reg) as b, 1.0::double as w from {ped} where sire_reg > 0 and dam_reg > 0
       union all
       select x, greatest(u, v), least(u, v), sum(w) / 2 from (
         select x, case when a = b or i = 1 then q.sire_reg else q.dam_reg end as u, case when a = b then q.dam_reg else b end as v, w
         from w join {ped} q on q.full_reg = a join (values (1), (2)) k(i) on a <> b or i = 1) where u > 0 and v > 0 group by 1, 2, 3)
       select full_reg, round(coalesce(f, 0), 6)::double as f from {ped} left join (select x, sum(w) / 2 as f from w where a = b group by x) on full_reg = x"""


@query("J17_inbreeding", _COANCESTRY.format(ped="pedigree"))
def _(t):
    return D.inbreeding(t.pedigree, 0).select("full_reg", r6("f").alias("f"))


@query("J17_inbreeding_geno_herd", _COANCESTRY.format(ped="geno_ped"))
def _(t):
    return D.inbreeding(t.geno_ped, 0).select("full_reg", r6("f").alias("f"))


# As above with the generations each line has left (r of a, q of b).
_BOUNDED = """with recursive w as (select full_reg as x, greatest(sire_reg, dam_reg) as a, least(sire_reg, dam_reg) as b, {depth} - 1 as r, {depth} - 1 as q, 1.0::double as w
       from {ped} where sire_reg > 0 and dam_reg > 0
       union all
       select x, greatest(u, v), least(u, v), case when u >= v then r else q end, case when u >= v then q else r end, sum(w) / 2 from (
         select x, case when a = b or i = 1 then p.sire_reg else p.dam_reg end as u, case when a = b then p.dam_reg else b end as v,
                case when a = b then least(r, q) else r end - 1 as r, case when a = b then least(r, q) - 1 else q end as q, w
         from w join {ped} p on p.full_reg = a join (values (1), (2)) k(i) on a <> b or i = 1 where r > 0 and (a <> b or q > 0)) where u > 0 and v > 0 group by 1, 2, 3, 4, 5)
       select full_reg, round(coalesce(f, 0), 6)::double as f from {ped} left join (select x, sum(w) / 2 as f from w where a = b group by x) on full_reg = x"""


@query("J17_inbreeding_depth", _BOUNDED.format(ped="pedigree", depth=4))
def _(t):
    return D.inbreeding(t.pedigree, 0, depth=4).select("full_reg", r6("f").alias("f"))


@query(
    "J17_pair_kinship",
    """with recursive pairs as (select full_reg as i, full_reg - 1 as j from pedigree where full_reg > 1 union select full_reg, sire_reg from pedigree where sire_reg > 0),
       w as (select i, j, greatest(i, j) as a, least(i, j) as b, 1.0::double as w from pairs
       union all
       select i, j, greatest(u, v), least(u, v), sum(w) / 2 from (
         select i, j, case when a = b or k = 1 then p.sire_reg else p.dam_reg end as u, case when a = b then p.dam_reg else b end as v, w
         from w join pedigree p on p.full_reg = a join (values (1), (2)) t(k) on a <> b or k = 1) where u > 0 and v > 0 group by 1, 2, 3, 4)
       select pairs.i as animal_i, pairs.j as animal_j, round(coalesce(f, 0), 6)::double as kinship
       from pairs left join (select i, j, sum(w) / 2 as f from w where a = b group by 1, 2) s on pairs.i = s.i and pairs.j = s.j""",
)
def _(t):
    p = t.pedigree
    pairs = p.filter("full_reg > 1").select("full_reg", F.col("full_reg") - 1).unionAll(p.filter("sire_reg > 0").select("full_reg", "sire_reg"))
    out = D.kinship(p, pairs.toDF("animal_i", "animal_j"), 0)
    return out.select("animal_i", "animal_j", r6("kinship").alias("kinship"))


def aligned(t):
    e = t.evaluations
    full = e.select("full_reg", F.col("solution_full").alias("solution"))
    reduced = e.select("iter", "full_reg", F.col("solution_reduced").alias("solution"))
    return E.align_evaluations(full, reduced, e.filter("grp = 'dropped'"), ["iter"])


@query(
    "J18_align_evaluations",
    """select iter, full_reg, round(solution_full, 6) as solution_full, round(solution_reduced, 6) as solution_reduced, grp as "group" from evaluations""",
)
def _(t):
    return aligned(t).select("iter", "full_reg", r6("solution_full").alias("solution_full"), r6("solution_reduced").alias("solution_reduced"), "group")


@query(
    "J18_bias_stats",
    """with d as (select iter, abs(solution_reduced - solution_full) as x from evaluations)
       select iter, round(min(x), 6) as min, round(avg(x), 6) as mean, round(max(x), 6) as max, round(stddev_samp(x), 6) as sd from d group by iter""",
)
def _(t):
    out = E.bias_stats(aligned(t), ["iter"])
    return out.select("iter", *[r6(c).alias(c) for c in ("min", "mean", "max", "sd")])


@query(
    "J19_dispersion",
    """select iter, grp as "group", case when regr_sxx(solution_full, solution_reduced) > 0 then round(regr_slope(solution_full, solution_reduced), 6) end as slope, regr_count(solution_full, solution_reduced) as n from evaluations group by all""",
)
def _(t):
    return E.dispersion(aligned(t), ["iter", "group"]).select("iter", "group", r6("slope").alias("slope"), "n")


@query(
    "J20_lr_accuracy",
    """with f as (select c_custkey as k, (c_custkey % 10) / 100.0::double as f from customer), c as (select iter, covar_samp(solution_full, solution_reduced) as cov from evaluations group by iter),
       m as (select iter, avg(f) as f from evaluations join f on full_reg = k where grp = 'dropped' group by iter)
       select c.iter, round(sqrt(cov / ((1 - f) * (10 + c.iter))), 6) as accuracy from c left join m on c.iter = m.iter""",
)
def _(t):
    f = t.customer.select(F.col("c_custkey").alias("full_reg"), ((F.col("c_custkey") % 10) / 100.0).alias("f"))
    par = t.evaluations.select("iter").distinct().withColumn("gen_var", 10 + F.col("iter"))
    return E.lr_accuracy(aligned(t), ["iter"], par, f).select("iter", r6("accuracy").alias("accuracy"))


@query(
    "J21_model_compare",
    f"""with m as (select n_name as run, sum(c_acctbal) / 1000 as ll from nation join customer on n_nationkey = c_nationkey group by 1),
       p as (select a.n_name as x, b.n_name as y from nation a join nation b on b.n_nationkey = a.n_nationkey + 1),
       d as (select x, y, m.ll as lx, k.ll as ly from p join m on x = m.run join m k on y = k.run)
       select x as null_model, y as test_model, round(case when lx - ly > 40 then ((lx - ly) / 2 + ln(sqrt((lx - ly) / 2 * pi())) - ln(1 - 1 / (lx - ly) + 3 / power(lx - ly, 2) - 15 / power(lx - ly, 3) + 105 / power(lx - ly, 4))) / ln(10) / 2
         when lx - ly > 0 then -log10({ERFC.format(x="sqrt(least(greatest(lx - ly, 0), 60) / 2)")}) / 2 else 0 end, 4) as neglog10p, round(lx - ly, 6) as aic_gain from d""",
)
def _(t):
    ll = t.nation.join(t.customer, F.col("n_nationkey") == F.col("c_nationkey")).groupBy(F.col("n_name").alias("run"))
    metrics = ll.agg((F.sum("c_acctbal") / 1000).alias("neg2logl")).withColumn("aic", F.col("neg2logl") + 2)
    a = t.nation.select(F.col("n_name").alias("null_model"), (F.col("n_nationkey") + 1).alias("k"))
    pairs = a.join(t.nation.select(F.col("n_name").alias("test_model"), F.col("n_nationkey").alias("k")), "k").drop("k")
    out = E.model_compare(metrics, pairs)
    return out.select("null_model", "test_model", r6("neglog10p", 4).alias("neglog10p"), r6("aic_gain").alias("aic_gain"))
