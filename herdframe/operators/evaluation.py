"""Variance components, model comparison and validation of breeding values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.functions.base import row_sum
from herdframe.functions.stats import lrt_neglog10p
from herdframe.operators.aggregates import simple_regression, summary_of
from herdframe.operators.keys import null_safe_join


def heritability(
    varcomp: DataFrame, traits: dict[str, str], by: list[str] | None = None, mat: bool = False, mpe: bool = False, pe: bool = False
) -> DataFrame:
    """Direct heritability, total variance and, on request, maternal h2, maternal environment c2, repeatability.

    ``varcomp``: by..., val1, val2, var_cov. ``traits``: short name -> description; one trait is the univariate case.
    Labels read ``trait_dir``, ``trait_mat``, ``trait_mpe``, ``trait_pe``, ``trait_res``. The total adds every
    variance and the direct-maternal covariance once.
    """
    by = by or []
    key = None
    for short, text in traits.items():
        cond = F.col("val1").startswith(f"{short}_")
        key = F.when(cond, text) if key is None else key.when(cond, text)
    kind1, kind2 = (F.regexp_replace(c, "^(" + "|".join(traits) + ")_", "") for c in ("val1", "val2"))
    cross = (kind1 == "dir") & (kind2 == "mat")
    rows = varcomp.select(*by, key.alias("key"), F.when(cross, "dir_mat").when(F.col("val1") == F.col("val2"), kind1).alias("part"), "var_cov")
    rows = rows.filter(F.col("part").isNotNull() & F.col("key").isNotNull())
    parts = ["dir", "mat", "dir_mat", "mpe", "pe", "res"]
    wide = rows.groupBy(*by, "key").agg(
        F.sum("var_cov").alias("total_variance"),
        *[F.max(F.when(F.col("part") == p, F.col("var_cov"))).alias(p) for p in parts],
    )
    total = F.col("total_variance")
    out = [*by, "key", "total_variance", (F.col("dir") / total).alias("direct_h2")]
    if mat:
        out.append((F.col("mat") / total).alias("maternal_h2"))
    if mpe:
        out.append((F.col("mpe") / total).alias("mpe_c2"))
    if pe:
        out.append((row_sum("dir", "pe") / total).alias("repeatability"))
    return wide.select(*out)


def model_compare(metrics: DataFrame, pairs: DataFrame, mode: str = "reference") -> DataFrame:
    """Likelihood-ratio tests for listed model pairs: -log10 p and the gain in AIC.

    ``metrics``: run, aic, neg2logl. ``pairs``: null_model, test_model.
    """
    side = lambda key, tag: metrics.select(F.col("run").alias(key), F.col("aic").alias(f"__aic_{tag}"), F.col("neg2logl").alias(f"__ll_{tag}"))
    both = pairs.join(side("null_model", "a"), "null_model").join(side("test_model", "b"), "test_model")
    return both.select(
        "null_model", "test_model", lrt_neglog10p("__ll_a", "__ll_b", mode).alias("neglog10p"),
        (F.col("__aic_a") - F.col("__aic_b")).alias("aic_gain"),
    )


def align_evaluations(full: DataFrame, reduced: DataFrame, masked: DataFrame, by: list[str], animal: str = "full_reg") -> DataFrame:
    """Full and reduced solutions side by side per animal and iteration, tagged dropped or kept."""
    a = full.select(animal, F.col("solution").alias("solution_full"))
    b = reduced.select(*by, animal, F.col("solution").alias("solution_reduced"))
    joined = b.join(a, animal, "left")
    flag = masked.select(*by, animal).distinct().withColumn("__m", F.lit(True))
    tagged = null_safe_join(joined, flag, [*by, animal])
    return tagged.withColumn("group", F.when(F.col("__m"), "dropped").otherwise("kept")).drop("__m")


def bias_stats(df: DataFrame, by: list[str], full: str = "solution_full", reduced: str = "solution_reduced") -> DataFrame:
    """Min, mean, max and sd of the absolute difference of the two evaluations."""
    return summary_of(df.withColumn("difference", F.abs(F.col(reduced) - F.col(full))), by, "difference")


def dispersion(df: DataFrame, by: list[str], full: str = "solution_full", reduced: str = "solution_reduced") -> DataFrame:
    """Slope of full on reduced solutions; one means no over- or under-dispersion."""
    return simple_regression(df, by, full, reduced)


def lr_accuracy(
    df: DataFrame, by: list[str], parameters: DataFrame, inbreeding: DataFrame, animal: str = "full_reg",
    full: str = "solution_full", reduced: str = "solution_reduced", validation_only: bool = False,
) -> DataFrame:
    """sqrt(cov(full, reduced) / ((1 - F) var_u)), F averaged over validation animals.

    ``parameters``: by..., gen_var. ``inbreeding``: animal, f. The covariance uses all animals unless
    ``validation_only``.
    """
    known = df.filter(F.col(full).isNotNull() & F.col(reduced).isNotNull())
    base = known.filter("group = 'dropped'") if validation_only else known
    cov = base.groupBy(*by).agg(F.covar_samp(full, reduced).alias("cov"))
    tested = df.filter("group = 'dropped'").join(inbreeding.select(animal, "f"), animal, "left")
    mean_f = tested.groupBy(*by).agg(F.avg("f").alias("f"))
    joined = reduce(lambda x, y: null_safe_join(x, y, by), [cov, mean_f, parameters.select(*by, "gen_var")])
    return joined.withColumn("accuracy", F.sqrt(F.try_divide(F.col("cov"), (1 - F.col("f")) * F.col("gen_var"))))
