"""Association results: genomic control, false discovery rates, meta-analysis, tables behind the plots."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdframe.functions.stats import CHI2_1_MEDIAN, LAMBDA_GRID, smoother_weights
from herdframe.functions.tails import chi2_1_isf, chi2_sf, erfc, scaled_tail
from herdframe.operators import ranks as R
from herdframe.operators.keys import null_safe_join
from herdframe.operators.shape import pivot_wider
from herdframe.session import cut_lineage


def inflation_factor(df: DataFrame, p: str, by: list[str] | None = None) -> DataFrame:
    """Median chi-square over its expected median per group.

    Chi-square falls as p rises, so the middle p-values are found first and only these are transformed.
    """
    by = by or []
    middle = R.quantile_ends(df.filter(F.col(p).between(0, 1)), by, p, [0.5])
    # of an even number the chi-squares of both middle values are averaged
    values = middle.withColumn("__chi2", (chi2_1_isf("low") + chi2_1_isf("high")) / 2)
    return values.select(*by, (F.col("__chi2") / CHI2_1_MEDIAN).alias("lambda"))


def gc_adjust(df: DataFrame, p: str, by: list[str] | None = None, out: str = "adj_p") -> DataFrame:
    """p-values of chi-square divided by the inflation factor."""
    by = by or []
    factors = inflation_factor(df, p, by)
    if by:
        # stored first: with the size of the factors known, the results need no shuffle for this join
        joined = null_safe_join(df, cut_lineage(factors.withColumnRenamed("lambda", "__lambda")), by)
    else:
        # a literal: a subquery may not be the argument of an Arrow function
        row = factors.first()
        joined = df.withColumn("__lambda", F.lit(row and row["lambda"]).cast("double"))
    return joined.withColumn(out, scaled_tail(p, "__lambda")).drop("__lambda")


def pi0_table(df: DataFrame, p: str, by: list[str]) -> DataFrame:
    """Share of true nulls per group: smoothed tail counts over the lambda grid, evaluated at its end."""
    weights = smoother_weights()
    parts = [
        F.count_if(F.col(p) >= lam) * (w / (1 - lam)) for lam, w in zip(LAMBDA_GRID, weights, strict=True)
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return df.groupBy(*by).agg(F.count(p).alias("__m"), F.least(total / F.count(p), F.lit(1.0)).alias("__pi0"))


def qvalue(df: DataFrame, p: str, by: list[str] | None = None, out: str = "q", pi0: float | None = None) -> DataFrame:
    """Storey q-values; equal p-values share the largest rank. ``pi0`` fixes the share of true nulls.

    The distinct p-values are sorted once, by range, and stored; ranks and minima are carried over the table of blocks."""
    by = by or []
    known = df.filter(F.col(p).isNotNull())
    blocks = R.value_blocks(known, by, p)
    info = R.placed(blocks, by)
    if pi0 is not None:
        info = info.withColumn("pi0", F.lit(float(pi0)))
    elif by:
        info = null_safe_join(info, pi0_table(known, p, by).drop("__m").withColumnRenamed("__pi0", "pi0"), by)
    else:
        info = info.withColumn("pi0", pi0_table(known, p, by).select("__pi0").scalar())
    # each value times all values over its rank, the largest of equal ones; a q-value is the least of these from the value on
    raw = lambda row: row["v"] * row["total"] / (row["before"] + np.cumsum(row["n"]))
    located = blocks.join(info.drop(*by), "block")
    least = R.spread(located, [*by, "block"], "low double", lambda row: {"low": raw(row).min(keepdims=True)})
    later = R.carried(least, by, F.col("low"), F.min, "later", reverse=True)

    def values(row: dict) -> dict[str, np.ndarray]:
        low = np.minimum.accumulate(np.append(np.inf if row["later"] is None else row["later"], raw(row)[::-1]))[:0:-1]
        return {p: row["v"], out: row["pi0"] * np.minimum(low, 1)}

    q = R.spread(located.join(later, "block"), by, f"`{p}` double, `{out}` double", values)
    return null_safe_join(df, q, [*by, p])


def bh_adjust(df: DataFrame, p: str, by: list[str] | None = None, out: str = "p_adj") -> DataFrame:
    """Benjamini-Hochberg: the q-value with no share of true nulls taken out."""
    return qvalue(df, p, by, out, pi0=1.0)


def fdr_summary(df: DataFrame, q: str, by: list[str], levels: dict[str, float]) -> DataFrame:
    """Rows passing each level and the smallest passing -log10 q, one pass."""
    aggs = []
    for name, level in levels.items():
        passing = F.col(q) <= level
        aggs += [F.count_if(passing).alias(f"n_{name}"), F.min(F.when(passing, -F.log10(q))).alias(f"min_{name}")]
    return df.groupBy(*by).agg(*aggs)


def meta_analysis(df: DataFrame, by: list[str], beta: str = "beta", se: str = "se") -> DataFrame:
    """Fixed effect, DerSimonian-Laird random effects and Cochran's Q from weighted sums per marker."""
    ok = df.filter(F.col(beta).isNotNull() & (F.col(se) > 0))
    w = 1 / (F.col(se) * F.col(se))
    sums = ok.groupBy(*by).agg(
        F.count(F.lit(1)).alias("k"), F.sum(w).alias("__w"), F.sum(w * F.col(beta)).alias("__wb"),
        F.sum(w * F.col(beta) * F.col(beta)).alias("__wbb"), F.sum(w * w).alias("__ww"),
    )
    beta_fe = F.col("__wb") / F.col("__w")
    q = F.greatest(F.col("__wbb") - F.col("__wb") * F.col("__wb") / F.col("__w"), F.lit(0.0))
    c = F.col("__w") - F.col("__ww") / F.col("__w")
    tau2 = F.when(c > 0, F.greatest((q - (F.col("k") - 1)) / c, F.lit(0.0))).otherwise(F.lit(0.0))
    fixed = sums.withColumns({"__tau2": tau2, "__q": q})
    # the between-study variance goes back to the studies, so no list of studies is ever collected
    spread = null_safe_join(ok.select(*by, beta, se), fixed.select(*by, "__tau2"), by)
    wr = 1 / (F.col(se) * F.col(se) + F.col("__tau2"))
    random = spread.groupBy(*by).agg(F.sum(wr).alias("__wr"), F.sum(wr * F.col(beta)).alias("__wbr"))
    joined = null_safe_join(fixed, random, by)
    staged = joined.withColumns(
        {
            "beta_fe": beta_fe, "std_fe": F.sqrt(1 / F.col("__w")),
            "beta_re": F.col("__wbr") / F.col("__wr"), "std_re": F.sqrt(1 / F.col("__wr")),
            "__zf": F.abs(F.col("__wb")) / F.sqrt("__w") / math.sqrt(2),
            "__zr": F.abs(F.col("__wbr")) / F.sqrt("__wr") / math.sqrt(2),
        }
    )
    excess = F.when(F.col("__q") > 0, F.greatest(1 - (F.col("k") - 1) / F.col("__q"), F.lit(0.0))).otherwise(0.0)
    return staged.select(
        *by, "k", "beta_fe", "std_fe", erfc("__zf").alias("pvalue_fe"), "beta_re", "std_re",
        erfc("__zr").alias("pvalue_re"), F.col("__q").alias("q_stat"), F.col("__tau2").alias("tau2"),
        chi2_sf("__q", F.col("k") - 1).alias("pvalue_q"), excess.alias("i2"),
    )


def meta_input(
    df: DataFrame, snp: list[str], study: str, studies: list, order: list[str], beta: str = "beta", se: str = "se"
) -> DataFrame:
    """Effects and standard errors of all studies side by side, rounded to seven digits.

    Of several rows of a marker in one study the first by ``order`` (then effect and error) is taken, effect and error from the
    same row.
    """
    known = df.filter(F.col(beta).isNotNull())
    pair = F.struct(F.round(beta, 7).alias("b"), F.round(se, 7).alias("se"))
    rank = F.struct(*order, beta, se)
    picks = [F.min_by(F.when(F.col(study) == F.lit(s), pair), F.when(F.col(study) == F.lit(s), rank)).alias(f"__{s}") for s in studies]
    cells = [F.col(f"__{s}.{c}").alias(f"{c}_{s}") for s in studies for c in ("b", "se")]
    return known.groupBy(*snp).agg(*picks).select(*snp, *cells)


def conditional_input(meta: DataFrame, freq: DataFrame, on: list[str]) -> DataFrame:
    """Meta-analysis rows with both alleles (a1, a2, if ``freq`` has them), frequency and N = chromosomes / 2; markers of frequency zero go."""
    known = meta.filter(F.col("beta_re").isNotNull() & F.col("std_re").isNotNull())
    joined = known.join(freq, on, "inner").withColumn("n", F.col("nchrobs") / 2)
    return joined.filter(F.col("freq") != 0).select(
        *on, *[c for c in ("a1", "a2") if c in freq.columns], "freq", F.col("beta_re").alias("b"), F.col("std_re").alias("se"), F.col("adj_p").alias("p"), "n"
    )


def genome_offsets(df: DataFrame, chrom: str = "chr", pos: str = "pos") -> DataFrame:
    """(chr, offset, length): where each chromosome starts on one axis. The running sum is over chromosomes."""
    lengths = df.groupBy(chrom).agg(F.max(pos).alias("length"))
    w = Window.orderBy(chrom).rowsBetween(Window.unboundedPreceding, -1)
    return lengths.withColumn("offset", F.coalesce(F.sum("length").over(w), F.lit(0)))


def cumulative_position(df: DataFrame, chrom: str = "chr", pos: str = "pos") -> DataFrame:
    joined = df.join(cut_lineage(genome_offsets(df, chrom, pos).drop("length")), chrom, "left")
    return joined.withColumn("pos_cum", F.col(pos) + F.col("offset")).drop("offset")


def axis_centres(df: DataFrame, chrom: str = "chr", pos: str = "pos") -> DataFrame:
    ends = df.groupBy(chrom).agg(F.min(pos).alias("lo"), F.max(pos).alias("length"))
    w = Window.orderBy(chrom).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("length").over(w), F.lit(0))
    return ends.select(chrom, (start + (F.col("lo") + F.col("length")) / 2).alias("centre"))


def chromosome_class(chrom: str = "chr") -> Column:
    """Alternating class for colouring: odd or even chromosome."""
    return F.when(F.col(chrom) % 2 == 1, "odd").otherwise("even")


def manhattan_table(df: DataFrame, y: str, threshold: float, leads: DataFrame, on: list[str]) -> DataFrame:
    """Axis position, class, threshold flag and lead-marker flag per row."""
    flagged = df.join(leads.select(*on).distinct().withColumn("highlight", F.lit(True)), on, "left")
    out = cumulative_position(flagged)
    return out.withColumns(
        {
            "chr_class": chromosome_class(),
            "passing": F.col(y) >= threshold,
            "highlight": F.coalesce(F.col("highlight"), F.lit(False)),
        }
    )


def qq_points(df: DataFrame, p: str, by: list[str] | None = None) -> DataFrame:
    """Observed and expected -log10 p; values outside (0, 1) are left out. Ties take consecutive ranks."""
    by = by or []
    ok = df.filter((F.col(p) > 0) & (F.col(p) < 1))
    blocks = R.value_blocks(ok, by, p)
    to = lambda row: row["before"] + np.cumsum(row["n"])
    ranked = R.spread(
        blocks.join(R.placed(blocks, by).drop(*by), "block"), by, f"`{p}` double, __to long, __n long, __m long",
        lambda row: {p: row["v"], "__to": to(row), "__n": row["n"], "__m": np.full(len(row["v"]), row["total"])},
    )
    rows = ranked.withColumn("rank", F.explode(F.sequence(F.col("__to") - F.col("__n") + 1, F.col("__to"))))
    a = F.when(F.col("__m") <= 10, F.lit(0.375)).otherwise(F.lit(0.5))
    expected = (F.col("rank") - a) / (F.col("__m") + 1 - 2 * a)
    return rows.select(*by, "rank", (-F.log10(p)).alias("observed"), (-F.log10(expected)).alias("expected"))
