"""Association results, genotypes, enrichment."""

from pyspark.sql import functions as F

from herdframe.catalog.base import query
from herdframe.catalog.columns import ERFC
from herdframe.functions import stats as S
from herdframe.functions import tails as T
from herdframe.functions.base import r6
from herdframe.operators import enrichment as N
from herdframe.operators import genotypes as Y
from herdframe.operators import gwas as G
from herdframe.operators import intervals as V
from herdframe.operators.keys import shuffled
from herdframe.session import cut_lineage


def sql_poly(coefs, x):
    out = repr(float(coefs[0]))
    for c in coefs[1:]:
        out = f"({out} * {x} + {float(c)!r})"
    return out


def sql_ratio(pair, x):
    return f"({sql_poly(pair[0], x)} / {sql_poly(pair[1], x)})"


def sql_isf(p):
    """Chi-square (1 df) value of an upper tail p in (0, 1] as SQL: square of the AS241 normal quantile of p / 2."""
    half, q = f"({p} / 2)", f"({p} / 2 - 0.5::double)"
    r = f"sqrt(-ln({half}))"
    inner = f"{q} * {sql_ratio(T.AS241_CENTRE, f'(0.180625::double - {q} * {q})')}"
    far = f"case when {r} <= 5 then {sql_ratio(T.AS241_MIDDLE, f'({r} - 1.6::double)')} else {sql_ratio(T.AS241_TAIL, f'({r} - 5::double)')} end"
    return f"(case when {p} = 1 then 0 else power(case when abs({q}) <= 0.425 then {inner} else -({far}) end, 2) end)"


MEDIAN = repr(S.CHI2_1_MEDIAN)


@query(
    "J0_chi2_quantile",
    f"""select study, snp, chr, pos, round({sql_isf("p")}, 6) as chi2, round(p, 6) as back from gwas""",
)
def _(t):
    d = t.gwas.withColumn("chi2", T.chi2_1_isf("p")).withColumn("back", T.chi2_1_sf("chi2"))
    return d.select("study", "snp", "chr", "pos", r6("chi2").alias("chi2"), r6("back").alias("back"))


@query(
    "J0_chi2_tail",
    f"""select c_custkey, round({ERFC.format(x="sqrt((c_custkey % 200) / 20.0::double / 2)")}, 6) as p1,
       round(exp(-(c_custkey % 200) / 40.0::double) * (1 + (c_custkey % 200) / 40.0::double), 6) as p4 from customer""",
)
def _(t):
    d = t.customer.select("c_custkey", ((F.col("c_custkey") % 200) / 20.0).alias("x"))
    return d.select("c_custkey", r6(T.chi2_1_sf("x")).alias("p1"), r6(T.chi2_sf("x", F.lit(4))).alias("p4"))


@query(
    "J1_inflation_factor",
    f"""select study, round(median({sql_isf("p")}) / {MEDIAN}, 6) as "lambda" from gwas group by study""",
)
def _(t):
    return G.inflation_factor(t.gwas, "p", ["study"]).select("study", r6("lambda").alias("lambda"))


@query("J1_inflation_global", f"""select round(median({sql_isf("p")}) / {MEDIAN}, 6) as "lambda" from gwas""")
def _(t):
    return G.inflation_factor(t.gwas, "p").select(r6("lambda").alias("lambda"))


@query(
    "J2_gc_adjust",
    f"""with g as (select study, snp, chr, pos, {sql_isf("p")} as x from gwas), m as (select study, median(x) / {MEDIAN} as lam from g group by study),
       a as (select g.study, snp, chr, pos, sqrt(x / lam / 2) as y from g join m on g.study = m.study)
       select study, snp, chr, pos, round(case when y < 5 then {ERFC.format(x="y")} else 0 end, 6) as adj_p from a""",
)
def _(t):
    return G.gc_adjust(t.gwas, "p", ["study"]).select("study", "snp", "chr", "pos", r6("adj_p").alias("adj_p"))


_PI0 = " + ".join(
    f"count(*) filter (where p >= {lam}::double) * ({w!r} / (1 - {lam}::double))"
    for lam, w in zip(S.LAMBDA_GRID, S.smoother_weights(), strict=True)
)


def sql_q(by, pi0):
    return f"""with s as (select study, count(*) as m, least(({pi0}) / count(*), 1) as pi0 from gwas group by study),
       r as (select gwas.*, count(*) over (partition by gwas.study order by p) as rk, m, pi0 from gwas join s on gwas.study = s.study)
       select study, snp, chr, pos, round(pi0 * least(1, min(p * m / rk) over (partition by study order by p rows between current row and unbounded following)), 6) as q from r"""


@query("J3_qvalue", sql_q("study", _PI0))
def _(t):
    return G.qvalue(t.gwas, "p", ["study"]).select("study", "snp", "chr", "pos", r6("q").alias("q"))


@query(
    "J4_fdr_summary",
    """with r as (select gwas.*, count(*) over (partition by study order by p) as rk, count(*) over (partition by study) as m from gwas),
       q as (select study, least(1, min(p * m / rk) over (partition by study order by p rows between current row and unbounded following)) as q from r)
       select study, count(*) filter (where q <= 0.9) as n_a, round(min(-log10(q)) filter (where q <= 0.9), 6) as min_a,
       count(*) filter (where q <= 0.99) as n_b, round(min(-log10(q)) filter (where q <= 0.99), 6) as min_b from q group by study""",
)
def _(t):
    adjusted = G.qvalue(t.gwas, "p", ["study"], pi0=1.0)
    out = G.fdr_summary(adjusted, "q", ["study"], {"a": 0.9, "b": 0.99})
    return out.select("study", "n_a", r6("min_a").alias("min_a"), "n_b", r6("min_b").alias("min_b"))


@query(
    "J24_bh_adjust",
    """with r as (select gwas.*, count(*) over (order by p) as rk, count(*) over () as m from gwas)
       select study, snp, chr, pos, round(least(1, min(p * m / rk) over (order by p rows between current row and unbounded following)), 6) as p_adj from r""",
)
def _(t):
    return G.bh_adjust(t.gwas, "p").select("study", "snp", "chr", "pos", r6("p_adj").alias("p_adj"))


@query(
    "J5_meta_analysis",
    """with g as (select snp, beta as b, se * se as v from gwas),
       f as (select snp, count(*) as k, sum(1 / v) as w, sum(b / v) as wb, sum(b * b / v) as wbb, sum(1 / v / v) as ww from g group by snp),
       h as (select snp, k, wb / w as beta_fe, sqrt(1 / w) as std_fe, greatest(wbb - wb * wb / w, 0) as q,
             case when w - ww / w > 0 then greatest((greatest(wbb - wb * wb / w, 0) - (k - 1)) / (w - ww / w), 0) else 0 end as tau2 from f),
       r as (select g.snp, sum(1 / (v + tau2)) as wr, sum(b / (v + tau2)) as wbr from g join h on g.snp = h.snp group by g.snp)
       select h.snp, k, round(beta_fe, 6) as beta_fe, round(std_fe, 6) as std_fe, round(wbr / wr, 6) as beta_re, round(sqrt(1 / wr), 6) as std_re,
       round(q, 4) as q_stat, round(tau2, 6) as tau2, round(case when q > 0 then greatest(1 - (k - 1) / q, 0) else 0 end, 6) as i2 from h join r on h.snp = r.snp""",
)
def _(t):
    out = G.meta_analysis(t.gwas, ["snp"])
    cols = ["beta_fe", "std_fe", "beta_re", "std_re", "tau2", "i2"]
    return out.select("snp", "k", *[r6(c).alias(c) for c in cols], r6("q_stat", 4).alias("q_stat"))


@query(
    "J5_meta_pvalues",
    f"""with g as (select snp, beta as b, se * se as v from gwas),
       f as (select snp, count(*) as k, sum(1 / v) as w, sum(b / v) as wb, greatest(sum(b * b / v) - sum(b / v) * sum(b / v) / sum(1 / v), 0) as q, sum(1 / v / v) as ww from g group by snp),
       h as (select *, case when w - ww / w > 0 then greatest((q - (k - 1)) / (w - ww / w), 0) else 0 end as tau2 from f),
       r as (select g.snp, sum(b / (v + tau2)) / sqrt(sum(1 / (v + tau2))) as zr from g join h on g.snp = h.snp group by g.snp),
       x as (select h.snp, abs(wb / sqrt(w)) as zf, abs(zr) as zr, q / 2 as h, k - 1 as df from h join r on h.snp = r.snp)
       select snp, round(case when zf < 7 then {ERFC.format(x="(zf / sqrt(2))")} else 0 end, 6) as pvalue_fe, round(case when zr < 7 then {ERFC.format(x="(zr / sqrt(2))")} else 0 end, 6) as pvalue_re,
         round(case when df < 1 then null when h = 0 then 1 when df % 2 = 0 then list_sum(list_transform(range(0, df // 2), lambda i: exp(i * ln(h) - h - lgamma(i + 1))))
           else case when h < 25 then {ERFC.format(x="sqrt(h)")} else 0 end + coalesce(list_sum(list_transform(range(0, (df - 1) // 2), lambda i: exp((i + 0.5) * ln(h) - h - lgamma(i + 1.5)))), 0) end, 6) as pvalue_q from x""",
)
def _(t):
    out = G.meta_analysis(t.gwas, ["snp"])
    return out.select("snp", *[r6(c).alias(c) for c in ("pvalue_fe", "pvalue_re", "pvalue_q")])


@query(
    "J6_genotype_qc",
    """with g as (select coalesce(case when animal < 10 then animal + 5000 end, animal) as animal, snp, dosage from genotypes
         where animal not in (select s_suppkey from supplier where s_nationkey = 3) and snp not in (select snp from markers where chr = 29)),
       f as (select snp, sum(dosage) / (2.0 * count(dosage)) as fr from g group by snp)
       select animal, snp, dosage from g where snp in (select snp from f where least(fr, 1 - fr) >= 0.3)""",
)
def _(t):
    remove = t.supplier.filter("s_nationkey = 3").select(F.col("s_suppkey").alias("animal"))
    rename = t.supplier.filter("s_suppkey < 10").select(F.col("s_suppkey").alias("animal"), (F.col("s_suppkey") + 5000).alias("new_id"))
    out = Y.genotype_qc(t.genotypes, t.markers, remove, rename, 0.3, (29,))
    return out.select("animal", "snp", "dosage")


@query(
    "J7_allele_stats",
    """select snp, count(*) filter (where dosage = 0) as g0, count(*) filter (where dosage = 1) as g1, count(*) filter (where dosage = 2) as g2,
       round(sum(dosage) / (2.0 * count(dosage)), 6)::double as freq, round(1 - count(dosage) / count(*), 6) as missing, 2 * count(dosage) as nchrobs from genotypes group by snp""",
)
def _(t):
    out = Y.allele_stats(t.genotypes)
    return out.select("snp", "g0", "g1", "g2", r6("freq").alias("freq"), r6("missing").alias("missing"), "nchrobs")


_PAIRS = """select full_reg, 'Animal-Sire' as comparison, sire_reg as parent_reg from geno_ped union all select full_reg, 'Animal-Dam', dam_reg from geno_ped"""


@query(
    "J8_parent_conflicts",
    f"""with p as ({_PAIRS}) select comparison, full_reg, parent_reg, count(*) as n_snps, count(*) filter (where abs(c.dosage - q.dosage) = 2) as n_conflicts,
       round(100 * count(*) filter (where abs(c.dosage - q.dosage) = 2) / count(*), 6) as percent_conflicts
       from p join genotypes c on full_reg = c.animal join genotypes q on parent_reg = q.animal and c.snp = q.snp
       where c.dosage is not null and q.dosage is not null group by 1, 2, 3""",
)
def _(t):
    out = Y.parent_conflicts(t.genotypes, t.geno_ped)
    return out.withColumn("percent_conflicts", r6("percent_conflicts"))


_TRIO = """select full_reg, sire_reg, dam_reg, count(s.dosage + d.dosage) as n_trio,
    count(*) filter (where case c.dosage when 0 then s.dosage = 2 or d.dosage = 2 when 2 then s.dosage = 0 or d.dosage = 0
      else (s.dosage = 0 and d.dosage = 0) or (s.dosage = 2 and d.dosage = 2) end and s.dosage is not null and d.dosage is not null) as trio_conflicts,
    count(s.dosage) as n_sire, count(*) filter (where abs(c.dosage - s.dosage) = 2) as sire_conflicts,
    count(d.dosage) as n_dam, count(*) filter (where abs(c.dosage - d.dosage) = 2) as dam_conflicts
    from geno_ped join genotypes c on full_reg = c.animal and c.dosage is not null
    left join genotypes s on sire_reg = s.animal and c.snp = s.snp left join genotypes d on dam_reg = d.animal and c.snp = d.snp group by 1, 2, 3"""


@query("J9_trio_conflicts", _TRIO)
def _(t):
    return Y.trio_conflicts(t.genotypes, t.geno_ped).select(
        "full_reg", "sire_reg", "dam_reg", "n_trio", "trio_conflicts", "n_sire", "sire_conflicts", "n_dam", "dam_conflicts"
    )


@query(
    "J10_removal_list",
    f"""with c as ({_TRIO}), r as (select sire_reg as parent_reg, 100.0 * sire_conflicts / nullif(n_sire, 0) as pct from c union all select dam_reg, 100.0 * dam_conflicts / nullif(n_dam, 0) from c)
       select parent_reg from r where pct is not null group by 1 having count(*) filter (where pct >= 20) > 1
       and count(*) filter (where pct >= 20) > 0.5 * count(*)""",
)
def _(t):
    tallies = Y.trio_tally(Y.trio_conflicts(t.genotypes, t.geno_ped), 20)
    return Y.removal_list(tallies, min_fail=1)


@query(
    "J10_wrong_parents",
    f"""with p as ({_PAIRS}), k as (select comparison, full_reg, parent_reg, 100.0 * count(*) filter (where abs(c.dosage - q.dosage) = 2) / count(*) as pct
       from p join genotypes c on full_reg = c.animal join genotypes q on parent_reg = q.animal and c.snp = q.snp where c.dosage is not null and q.dosage is not null group by 1, 2, 3)
       select distinct full_reg, case when comparison = 'Animal-Sire' then '0' end as wrong_sire, case when comparison = 'Animal-Dam' then '0' end as wrong_dam
       from k where pct > 20 and parent_reg not in (select s_suppkey from supplier where s_nationkey = 5)""",
)
def _(t):
    removed = t.supplier.filter("s_nationkey = 5").select(F.col("s_suppkey").alias("parent_reg"))
    return Y.wrong_parents(Y.parent_conflicts(t.genotypes, t.geno_ped), removed, 20)


_Z = """with m as (select snp, avg(dosage) as mu from genotypes group by snp), z as (select animal, g.snp, dosage - mu as c, mu * (1 - mu / 2) as v
    from genotypes g join m on g.snp = m.snp where dosage is not null and mu * (1 - mu / 2) > 0),
    links as (select full_reg as a, full_reg as b from geno_ped union all select full_reg, sire_reg from geno_ped union all select full_reg, dam_reg from geno_ped union all select sire_reg, dam_reg from geno_ped),
    pairs as (select distinct least(a, b) as i, greatest(a, b) as j from links)"""


def relatives(t):
    """Pairs the relationship is wanted for: animals with themselves, their parents, and the parents with each other."""
    p = t.geno_ped
    links = p.select("full_reg", "full_reg").unionAll(p.select("full_reg", "sire_reg")).unionAll(p.select("full_reg", "dam_reg")).unionAll(p.select("sire_reg", "dam_reg"))
    return links.toDF("animal_i", "animal_j")


@query(
    "J11_grm_standardised",
    f"""{_Z} select a.animal as animal_i, b.animal as animal_j, round(sum(a.c * b.c / a.v) / (select count(distinct snp) from z), 6) as value
       from pairs join z a on a.animal = i join z b on b.animal = j and a.snp = b.snp group by 1, 2""",
)
def _(t):
    out = Y.grm(t.genotypes, relatives(t))
    return out.select("animal_i", "animal_j", r6("value").alias("value"))


@query(
    "J11_grm_vanraden",
    f"""{_Z} select a.animal as animal_i, b.animal as animal_j, round(sum(a.c * b.c) / (select sum(v) from (select distinct snp, v from z)), 6) as value
       from pairs join z a on a.animal = i join z b on b.animal = j and a.snp = b.snp group by 1, 2""",
)
def _(t):
    out = Y.grm(t.genotypes, relatives(t), "vanraden")
    return out.select("animal_i", "animal_j", r6("value").alias("value"))


@query(
    "J12_pca",
    f"""{_Z.split(", links")[0]}, d as (select animal, snp, c / sqrt(v) as z from z)
       select pc, count(distinct animal) as animals, count(distinct snp) as markers, round(sum(z * z), 3) as total, 1.0::double as norm, 0.0::double as product, 0.0::double as residual, true as ordered
       from d, (select unnest([1, 2]) as pc) group by pc""",
)
def _(t):
    """What makes scores principal components: unit length, no common part, and Z Z' score = eigenvalue * score."""
    out = Y.pca(t.genotypes, 2)
    scores = cut_lineage(out)
    z = Y.standardise(t.genotypes).select("animal", "snp", "z")
    total = z.agg(F.count_distinct("snp").alias("markers"), F.count_distinct("animal").alias("animals"), F.sum(F.col("z") * F.col("z")).alias("total"))
    down = z.join(scores, "animal").groupBy("pc", "snp").agg(F.sum(F.col("z") * F.col("score")).alias("u"))
    up = z.join(down, "snp").groupBy("pc", "animal").agg(F.sum(F.col("z") * F.col("u")).alias("w"))
    wide = scores.groupBy("animal").pivot("pc", [1, 2]).agg(F.first("score"))
    product = wide.agg(F.sum(F.col("1") * F.col("2")).alias("x"))
    gap = F.col("w") / (F.col("eigenvalue") * F.lit(total.select("markers").first()[0])) - F.col("score")
    per_pc = up.join(scores, ["pc", "animal"]).groupBy("pc").agg(
        F.sum(F.col("score") * F.col("score")).alias("norm"), F.sqrt(F.sum(gap * gap)).alias("gap"), F.first("share").alias("share")
    )
    first = per_pc.agg(F.max(F.when(F.col("pc") == 1, F.col("share"))) >= F.max(F.when(F.col("pc") == 2, F.col("share"))))
    return per_pc.select(
        "pc", *[total.select(c).scalar().alias(c) for c in ("animals", "markers")], r6(total.select("total").scalar(), 3).alias("total"), r6("norm").alias("norm"),
        r6(product.scalar()).alias("product"), r6("gap").alias("residual"), first.scalar().alias("ordered"),
    )


_EFFECT = """select snp, n, round(b, 10) as b, round(se, 10) as se, round(r2, 10) as r2, round(b / nullif(se, 0), 4) as t,
    round(case when se > 0 then case when abs(b / se) < 7 then """ + ERFC.format(x="abs(b / se) / sqrt(2)") + """ else 0 end end, 6) as p
    from (select snp, n, case when ok then gy / gg end as b, case when ok then sqrt(greatest(yy - gy * gy / gg, 0) / (n - k) / gg) end as se,
          case when ok and yy > 0 then gy * gy / gg / yy end as r2 from f)"""


def effect_columns(out):
    return out.select("snp", "n", *[r6(c, 10).alias(c) for c in ("b", "se", "r2")], r6("t", 4).alias("t"), r6("p").alias("p"))


@query(
    "J13_snp_regression",
    f"""with d as (select snp, dosage as g, y from genotypes g join pheno p on g.animal = p.animal where dosage is not null),
       f as (select snp, count(*) as n, 2 as k, regr_sxx(y, g) as gg, regr_sxy(y, g) as gy, regr_syy(y, g) as yy, regr_sxx(y, g) > 1e-10 * sum(g * g) and count(*) > 2 as ok from d group by snp) {_EFFECT}""",
)
def _(t):
    return effect_columns(Y.snp_regression(t.genotypes, t.pheno.select("animal", "y"), "y"))


@query(
    "J13_snp_regression_weighted_covariate",
    f"""with d as (select snp, dosage as g, y, env as x, wt as w from genotypes g join pheno p on g.animal = p.animal where dosage is not null),
       m as (select snp, sum(w) as sw, sum(w * g) / sum(w) as mg, sum(w * y) / sum(w) as my, sum(w * x) / sum(w) as mx, count(*) as n from d group by snp),
       c as (select d.snp, n, sum(w * (g - mg) * (g - mg)) as gg, sum(w * (g - mg) * (x - mx)) as gx, sum(w * (x - mx) * (x - mx)) as xx, sum(w * (g - mg) * (y - my)) as gy, sum(w * (x - mx) * (y - my)) as xy,
             sum(w * (y - my) * (y - my)) as yy, sum(w * g * g) as rg, sum(w * x * x) as rx from d join m on d.snp = m.snp group by d.snp, n),
       f as (select snp, n, 3 as k, gg - gx * gx / nullif(xx, 0) as gg, gy - gx * xy / nullif(xx, 0) as gy, yy - xy * xy / nullif(xx, 0) as yy,
             coalesce(n > 3 and xx > 1e-10 * rx and gg - gx * gx / nullif(xx, 0) > 1e-10 * rg, false) as ok from c) {_EFFECT}""",
)
def _(t):
    return effect_columns(Y.snp_regression(t.genotypes, t.pheno, "y", ["env"], "wt"))


@query(
    "J14_gxe_regression",
    f"""with d as (select snp, cast(dosage as double) as g, y, env as x, dosage * env as gx from genotypes g join pheno p on g.animal = p.animal where dosage is not null),
       s1 as (select snp, count(*) as n, avg(x) as mx, avg(g) as mg, avg(gx) as mi, avg(y) as my, regr_sxx(y, x) > 1e-10 * sum(x * x) as okx, sum(g * g) as rg, sum(gx * gx) as ri,
              regr_sxy(g, x) / nullif(regr_sxx(y, x), 0) as bg, regr_sxy(gx, x) / nullif(regr_sxx(y, x), 0) as bi, regr_sxy(y, x) / nullif(regr_sxx(y, x), 0) as by_ from d group by snp),
       r1 as (select d.snp, n, okx, rg, ri, g - mg - bg * (x - mx) as eg, gx - mi - bi * (x - mx) as ei, y - my - by_ * (x - mx) as ey from d join s1 on d.snp = s1.snp),
       s2 as (select snp, n, okx, rg, ri, sum(eg * eg) as gg, sum(eg * ei) as gi, sum(ei * ei) as ii, sum(eg * ey) as gy, sum(ei * ey) as iy, sum(ey * ey) as yy from r1 group by all),
       f as (select snp, n, 4 as k, ii - gi * gi / nullif(gg, 0) as gg, iy - gi * gy / nullif(gg, 0) as gy, yy - gy * gy / nullif(gg, 0) as yy,
             coalesce(n > 4 and okx and gg > 1e-10 * rg and ii - gi * gi / nullif(gg, 0) > 1e-10 * ri, false) as ok from s2) {_EFFECT}""",
)
def _(t):
    return effect_columns(Y.gxe_regression(t.genotypes, t.pheno, "y", "env"))


def clump_input(t):
    best = t.gwas.groupBy("snp").agg(F.min("p").alias("p"))
    return best.join(shuffled(t.markers), "snp")


@query(
    "J15_ld_clump",
    """with recursive c as (select m.snp, m.chr, m.pos, g.p from (select snp, min(p) as p from gwas group by snp) g join markers m on g.snp = m.snp where g.p <= 0.01),
       near as materialized (select a.snp as a, b.snp as b from c a join c b on a.chr = b.chr and a.snp <> b.snp and abs(a.pos - b.pos) <= 20000),
       linked as materialized (select a, b from near join genotypes x on x.snp = a join genotypes y on y.snp = b and x.animal = y.animal
                  where x.dosage is not null and y.dosage is not null group by a, b having not isnan(corr(x.dosage, y.dosage)) and round(power(corr(x.dosage, y.dosage), 2), 9) > 0.2),
       steps as (select 0 as i, snp, p, first_value(snp) over (order by p, snp) as lead from c
                 union all
                 select i + 1, snp, p, first_value(snp) over (order by p, snp) from (select s.* from steps s where s.snp <> s.lead and not exists (select 1 from linked where a = s.lead and b = s.snp)) q)
       select c.snp, c.chr, c.pos, round(c.p, 6) as p from c where c.snp in (select lead from steps)""",
)
def _(t):
    out = Y.ld_clump(clump_input(t), t.genotypes, window=20_000, r2=0.2, p_max=0.01)
    return out.select("snp", "chr", "pos", r6("p").alias("p"))


_GENE_HITS = "(select distinct study, gene_id from gwas m join genes g on m.chr = g.chr and pos between start_pos - 50 and end_pos + 50 where p < 0.02)"
_HYPER = """least(1, list_sum(list_transform(range(k, least(n, m) + 1), lambda i: exp(lgamma(m + 1) - lgamma(i + 1) - lgamma(m - i + 1)
    + lgamma(t - m + 1) - lgamma(n - i + 1) - lgamma(t - m - n + i + 1) - lgamma(t + 1) + lgamma(n + 1) + lgamma(t - n + 1)))))"""


def gene_hits(t):
    found = V.interval_join(t.gwas.filter("p < 0.02"), t.genes, 50, how="right_semi", by=["study"])
    return found.select("study", "gene_id").distinct()


@query(
    "J22_term_enrichment",
    f"""with h as {_GENE_HITS}, c as (select h.study, term, count(*) as k from h join genes on h.gene_id = genes.gene_id group by all),
       n as (select study, count(*) as n from h group by study), m as (select term, count(*) as m from genes group by term),
       p as (select c.study, c.term, k, n, m, (select count(*) from genes) as t from c join n on c.study = n.study join m on c.term = m.term),
       e as (select study, term, k, m, {_HYPER} as pv from p), r as (select *, count(*) over (partition by study order by pv) as rk, count(*) over (partition by study) as mm from e)
       select study, term, k as intersection_size, m as term_size, round(pv, 6) as p_value,
       round(least(1, min(pv * mm / rk) over (partition by study order by pv rows between current row and unbounded following)), 6) as p_adjusted from r""",
)
def _(t):
    out = N.term_enrichment(gene_hits(t), t.genes.select("gene_id", "term"), "gene_id", "term", ["study"])
    return out.select("study", "term", "intersection_size", "term_size", r6("p_value").alias("p_value"), r6("p_adjusted").alias("p_adjusted"))


@query(
    "J22_intersecting_genes",
    f"""with h as {_GENE_HITS} select study, term, string_agg('G' || genes.gene_id, '; ' order by chr, start_pos, 'G' || genes.gene_id) as intersecting_items
       from h join genes on h.gene_id = genes.gene_id group by study, term""",
)
def _(t):
    info = t.genes.select("gene_id", "chr", "start_pos", F.concat(F.lit("G"), "gene_id").alias("label"))
    rows = gene_hits(t).join(shuffled(info), "gene_id")
    terms = t.genes.select("gene_id", "term")
    return N.intersecting_items(rows, terms, "gene_id", "term", ["study"], ["chr", "start_pos"], "label")


@query(
    "J22_intersecting_rows",
    f"""with h as {_GENE_HITS} select study, term, row_number() over (partition by study, term order by chr, start_pos, 'G' || genes.gene_id)::int as place, 'G' || genes.gene_id as item
       from h join genes on h.gene_id = genes.gene_id""",
)
def _(t):
    info = t.genes.select("gene_id", "chr", "start_pos", F.concat(F.lit("G"), "gene_id").alias("label"))
    return N.intersecting_rows(gene_hits(t).join(shuffled(info), "gene_id"), t.genes.select("gene_id", "term"), "gene_id", "term", ["study"], ["chr", "start_pos"], "label")


@query(
    "J23_qtl_enrichment",
    f"""with h as (select distinct study, m.chr, pos, gene_id, term from gwas m join genes g on m.chr = g.chr and pos between start_pos - 50 and end_pos + 50 where p < 0.02),
       c as (select study, term, count(distinct gene_id) as k from h group by all), n as (select study, count(distinct gene_id) as n from h group by study), m as (select term, count(*) as m from genes group by term),
       p as (select c.study, c.term, k, n, m, (select count(*) from genes) as t from c join n on c.study = n.study join m on c.term = m.term),
       e as (select study, term, k, {_HYPER} as pv from p), r as (select *, count(*) over (partition by study order by pv) as rk, count(*) over (partition by study) as mm from e),
       a as (select study, term, k, least(1, min(pv * mm / rk) over (partition by study order by pv rows between current row and unbounded following)) as p_adj from r),
       s as (select study, term, count(*) as n_snps, string_agg(chr || ':' || format('{{:,}}', pos), '; ' order by chr, pos) as snps from (select distinct study, term, chr, pos from h) group by all having count(*) > 1)
       select a.study, a.term, round(p_adj, 6) as p_adjusted, k as n_annotations, n_snps, snps from a join s on a.study = s.study and a.term = s.term where p_adj < 1 and k > 1""",
)
def _(t):
    hits = t.gwas.filter("p < 0.02").select("study", "chr", "pos").distinct()
    records = V.interval_join(hits, t.genes, 50, how="right_semi", by=["study"])
    enriched = N.qtl_enrichment(records, t.genes.select("gene_id", "term"), "term", "gene_id", ["study"])
    # a term's genes as stretches without overlap: one pair of marker and term instead of one of marker and gene
    near = V.interval_join(hits, V.merged(t.genes, ["term"], 50))
    out = N.enriched_trait_report(enriched, near, "term", ["study"], limit=1.0)
    return out.withColumn("p_adjusted", r6("p_adjusted"))


@query(
    "J25_hit_table",
    """with lead as (select chr, pos, min(p) as p, avg(beta) as beta from gwas group by all),
       h as (select m.chr, pos, gene_id, start_pos, end_pos, term from (select distinct chr, pos from gwas where p < 0.02) m join genes g on m.chr = g.chr and pos between start_pos - 200 and end_pos + 200)
       select h.chr || ':' || format('{:,}', h.pos) as snp, 'G' || gene_id as gene, format('{:,}', start_pos) as start_text, format('{:,}', least(abs(h.pos - start_pos), abs(h.pos - end_pos))) as distance,
       round(p, 9) as p, round(beta, 6) as beta, count(*) over (partition by gene_id) as n from h join lead on h.chr = lead.chr and h.pos = lead.pos""",
)
def _(t):
    from herdframe.plans.reports import hit_table

    stats = t.gwas.groupBy("chr", "pos").agg(r6(F.min("p"), 9).alias("p"), r6(F.avg("beta")).alias("beta"))
    genes = t.genes.withColumn("gene", F.concat(F.lit("G"), "gene_id"))
    out = hit_table(t.gwas.filter("p < 0.02").select("chr", "pos").distinct(), genes, 200, stats, ["p", "beta"])
    return out.select("snp", "gene", "start_text", "distance", "p", "beta", "n")


@query(
    "J26_manhattan_table",
    """with c as (select chr, max(pos) as len from gwas group by chr), o as (select chr, cast(coalesce(sum(len) over (order by chr rows between unbounded preceding and 1 preceding), 0) as bigint) as off from c),
       l as (select distinct chr, pos from gwas where p < 0.001)
       select g.study, g.snp, g.chr, g.pos, g.pos + o.off as pos_cum, case when g.chr % 2 = 1 then 'odd' else 'even' end as chr_class, -log10(p) >= 2 as passing, l.chr is not null as highlight
       from gwas g join o on g.chr = o.chr left join l on g.chr = l.chr and g.pos = l.pos""",
)
def _(t):
    rows = t.gwas.withColumn("neglog10p", -F.log10("p"))
    out = G.manhattan_table(rows, "neglog10p", 2.0, t.gwas.filter("p < 0.001"), ["chr", "pos"])
    return out.select("study", "snp", "chr", "pos", "pos_cum", "chr_class", "passing", "highlight")


@query(
    "J27_label_scores",
    """with s as (select c_custkey as full_reg, c_acctbal / 1000 as pc1 from customer), b as (select registration_number, max(pct) filter (where brd = '1') as an, max(pct) filter (where brd = '5') as sim from fractions group by 1),
       l as (select full_reg, pc1, case when coalesce(an, 0) >= 0.4 then 'Angus' when coalesce(sim, 0) >= 0.4 then 'Simmental' else 'Crossbred or other' end as breed from s left join b on full_reg = registration_number)
       select breed, count(*) as n, round(avg(pc1), 6) as pc1 from l group by breed""",
)
def _(t):
    from herdframe.plans.breeds import label_scores

    shares = t.fractions.groupBy("registration_number").agg(
        F.max(F.when(F.col("brd") == "1", F.col("pct"))).alias("an"), F.max(F.when(F.col("brd") == "5", F.col("pct"))).alias("sim")
    )
    scores = t.customer.select(F.col("c_custkey").alias("full_reg"), (F.col("c_acctbal") / 1000).alias("pc1"))
    key = shares.withColumnRenamed("registration_number", "full_reg")
    rules = [("Angus", F.col("an") >= 0.4), ("Simmental", F.col("sim") >= 0.4)]
    out = label_scores(scores, key, rules)
    return out.groupBy("breed").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("pc1")).alias("pc1"))
