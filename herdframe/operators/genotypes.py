"""Genotypes in long form (animal, snp, dosage 0/1/2/null): quality, parentage, relationships, regressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdframe.functions.tails import chi2_1_sf
from herdframe.operators import packed as P
from herdframe.operators.keys import left_join_known, shuffled
from herdframe.session import cut_lineage

#: Matrices of so many tasks are put together at a time.
_TREE = 64
#: Genotypes a task multiplies, unless there are more tasks anyway.
_BLOCK = 8 << 20
#: Bytes of a table of vectors that may be sent to every task.
_SENT = 64 << 20
#: Growth of the leading direction that ends a polynomial, and the least that the longest one has to reach.
_GROWTH, _LEAST_GROWTH = 1e3, 1e2


def allele_stats(geno: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts per genotype, frequency of the counted allele, missing share and observed chromosomes per marker."""
    d = F.col("dosage")
    out = geno.groupBy(*(by or ["snp"])).agg(
        F.count_if(d == 0).alias("g0"), F.count_if(d == 1).alias("g1"), F.count_if(d == 2).alias("g2"),
        F.count(F.lit(1)).alias("n_all"), F.count(d).alias("n_called"),
    )
    return out.withColumns(
        {
            "freq": F.try_divide(2 * F.col("g2") + F.col("g1"), 2 * F.col("n_called")),
            "missing": 1 - F.col("n_called") / F.col("n_all"),
            "nchrobs": 2 * F.col("n_called"),
        }
    ).drop("n_all", "n_called")


def genotype_qc(
    geno: DataFrame, markers: DataFrame, remove: DataFrame | None = None, rename: DataFrame | None = None,
    min_maf: float = 0.01, drop_chr: tuple[int, ...] = (30,),
) -> DataFrame:
    """Drop listed animals and chromosomes, rename animals, then drop markers of low minor allele frequency.

    ``remove``: animal. ``rename``: animal, new_id. ``markers``: snp, chr.
    """
    rows = geno
    if drop_chr:
        rows = rows.join(markers.filter(F.col("chr").isin(*drop_chr)).select("snp"), "snp", "left_anti")
    if remove is not None:
        rows = rows.join(remove.select("animal").distinct(), "animal", "left_anti")
    if rename is not None:
        rows = rows.join(rename, "animal", "left").withColumn("animal", F.coalesce("new_id", "animal")).drop("new_id")
    stats = allele_stats(rows)
    common = stats.filter(F.least(F.col("freq"), 1 - F.col("freq")) >= min_maf).select("snp")
    return rows.join(common, "snp", "left_semi")


def parent_conflicts(geno: DataFrame, ped: DataFrame) -> DataFrame:
    """Opposing homozygotes per animal-parent pair: markers compared, conflicts, percent.

    ``ped``: full_reg, sire_reg, dam_reg. Only animals of pairs with calls on both sides are packed; work is one row per pair and 64 markers.
    """
    pairs = ped.select(
        "full_reg",
        F.inline(
            F.array(
                F.struct(F.lit("Animal-Sire").alias("comparison"), F.col("sire_reg").alias("parent_reg")),
                F.struct(F.lit("Animal-Dam").alias("comparison"), F.col("dam_reg").alias("parent_reg")),
            )
        ),
    )
    called = geno.filter(F.col("dosage").isNotNull())
    planes = _packed(called, pairs.select("full_reg").unionAll(pairs.select("parent_reg")).toDF("animal"))
    ids = planes.select("animal").distinct()
    for c in ("full_reg", "parent_reg"):
        pairs = pairs.join(ids.select(F.col("animal").alias(c)), c, "left_semi")
    both = pairs.join(P.side(planes, "animal", "full_reg", "_c"), "full_reg").join(P.side(planes, "animal", "parent_reg", "_p"), ["parent_reg", "chunk"])
    out = both.groupBy("comparison", "full_reg", "parent_reg").agg(
        F.sum(P.ones(P.all_called("_c", "_p"))).alias("n_snps"), F.sum(P.ones(P.opposing("_c", "_p"))).alias("n_conflicts")
    )
    return out.filter("n_snps > 0").withColumn("percent_conflicts", 100 * F.col("n_conflicts") / F.col("n_snps"))


def _packed(called: DataFrame, wanted: DataFrame) -> DataFrame:
    """Calls of the wanted animals, 64 markers a row. A stored table."""
    mine = called.join(wanted.distinct(), "animal", "left_semi")
    return cut_lineage(P.pack(mine, "animal", P.bit_places(called, "snp")))


def trio_conflicts(geno: DataFrame, ped: DataFrame) -> DataFrame:
    """Impossible trios per animal with both single-parent comparisons in the same row.

    A trio is impossible when the child's dosage cannot come from one allele of each parent. Parents without a call are taken out of the pedigree rows
    first, and rows without a parent left are not paired with markers.
    """
    called = geno.filter(F.col("dosage").isNotNull())
    rows = ped.select("full_reg", "sire_reg", "dam_reg")
    planes = _packed(called, rows.select(F.explode(F.array("full_reg", "sire_reg", "dam_reg")).alias("animal")).filter("animal is not null"))
    ids = planes.select("animal").distinct()
    rows = rows.join(ids.select(F.col("animal").alias("full_reg")), "full_reg", "left_semi")
    for c in ("sire_reg", "dam_reg"):
        rows = left_join_known(rows, ids.select(F.col("animal").alias(c), F.lit(True).alias(f"__has_{c}")), c)
    rows = rows.withColumns({f"__{c}": F.when(F.col(f"__has_{c}"), F.col(c)) for c in ("sire_reg", "dam_reg")})
    trios = cut_lineage(rows.select("full_reg", "sire_reg", "dam_reg", "__sire_reg", "__dam_reg"))
    keys = ["full_reg", "sire_reg", "dam_reg"]
    with_parent = trios.filter("__sire_reg is not null or __dam_reg is not null").join(P.side(planes, "animal", "full_reg", "_c"), "full_reg")
    for key, s in (("__sire_reg", "_s"), ("__dam_reg", "_d")):
        parent = P.side(planes, "animal", "__id", s).withColumnRenamed("chunk", "__chunk")
        # rows without this parent carry a key of their own, so they spread
        apart = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("none "), F.col("full_reg").cast("string")))
        on = (apart == F.col("__id").cast("string")) & (F.col("chunk") == F.col("__chunk")) & F.col(key).isNotNull()
        with_parent = with_parent.join(parent, on, "left").drop("__id", "__chunk")
    zero = F.lit(0).cast("long")
    plane = with_parent.withColumns({f"{p}{s}": F.coalesce(f"{p}{s}", zero) for p in ("lo", "hi") for s in ("_s", "_d")})
    counts = {
        "n_trio": P.all_called("_c", "_s", "_d"), "trio_conflicts": P.impossible("_c", "_s", "_d"), "n_sire": P.all_called("_c", "_s"),
        "sire_conflicts": P.opposing("_c", "_s"), "n_dam": P.all_called("_c", "_d"), "dam_conflicts": P.opposing("_c", "_d"),
    }
    found = plane.groupBy(*keys).agg(*[F.sum(P.ones(bits)).alias(c) for c, bits in counts.items()])
    alone = trios.filter("__sire_reg is null and __dam_reg is null").select(*keys).distinct()
    out = found.unionByName(alone.select(*keys, *[zero.alias(c) for c in counts]))
    for name in ("trio", "sire", "dam"):
        pct = F.try_divide(100 * F.col(f"{name}_conflicts"), F.col(f"n_{name}"))
        out = out.withColumn(f"percent_{name}_conflicts", pct)
    return out


def trio_tally(trios: DataFrame, limit: float = 0.5) -> DataFrame:
    """Passed and failed single-parent comparisons per parent."""
    rows = trios.select(
        F.inline(
            F.array(
                F.struct(F.col("sire_reg").alias("parent_reg"), F.col("percent_sire_conflicts").alias("pct")),
                F.struct(F.col("dam_reg").alias("parent_reg"), F.col("percent_dam_conflicts").alias("pct")),
            )
        )
    ).filter("pct is not null")
    return rows.groupBy("parent_reg").agg(
        F.count_if(F.col("pct") < limit).alias("pass_trio"), F.count_if(F.col("pct") >= limit).alias("fail_trio")
    )


def removal_list(tallies: DataFrame, earlier: DataFrame | None = None, min_fail: int = 2, share: float = 0.5) -> DataFrame:
    """Genotypes to remove: more than ``min_fail`` failed trios and more than ``share`` of all trios failed."""
    bad = tallies.filter(
        (F.col("fail_trio") > min_fail) & (F.col("fail_trio") / (F.col("pass_trio") + F.col("fail_trio")) > share)
    ).select("parent_reg")
    return (bad if earlier is None else bad.unionByName(earlier.select("parent_reg"))).distinct()


def wrong_parents(conflicts: DataFrame, removed: DataFrame, limit: float = 0.5) -> DataFrame:
    """Parent links to cut: pairs above the limit, unless the parent's genotype is removed anyway."""
    bad = conflicts.filter(F.col("percent_conflicts") > limit).join(removed.select("parent_reg"), "parent_reg", "left_anti")
    return bad.select(
        "full_reg",
        F.when(F.col("comparison").contains("Sire"), "0").alias("wrong_sire"),
        F.when(F.col("comparison").contains("Dam"), "0").alias("wrong_dam"),
    ).distinct()


def standardise(geno: DataFrame, scale: bool = True) -> DataFrame:
    """Centred (and scaled) dosages z of polymorphic markers; a missing call is the mean, so its z is 0 and the row
    is left out."""
    called = geno.filter(F.col("dosage").isNotNull())
    stats = called.groupBy("snp").agg(F.avg("dosage").alias("__mu"))
    stats = stats.withColumn("__v", F.col("__mu") * (1 - F.col("__mu") / 2)).filter("__v > 0")
    sd = F.sqrt("__v") if scale else F.lit(1.0)
    return called.join(stats, "snp").select("animal", "snp", ((F.col("dosage") - F.col("__mu")) / sd).alias("z"), "__v")


def grm(geno: DataFrame, pairs: DataFrame, method: str = "standardised") -> DataFrame:
    """Genomic relationship of the given pairs of animals: (animal_i, animal_j, value) with animal_i <= animal_j.

    ``pairs``: animal_i, animal_j, such as pedigree relatives or candidates; pairs without a genotype on both sides or without a common
    marker drop out. ``standardised``: mean of products of standardised dosages. ``vanraden``: centred products over the
    summed marker variances. Missing calls count as the mean. Dosages are joined by animal, then by (animal, marker), so
    the work is one row per pair and marker and sums are made before they are moved.
    """
    scaled = method == "standardised"
    if method not in ("standardised", "vanraden"):
        raise ValueError(f"unknown method {method}")
    z = standardise(geno, scaled)
    per_snp = z.groupBy("snp").agg(F.first("__v").alias("v"))
    denominator = per_snp.agg((F.count(F.lit(1)).cast("double") if scaled else F.sum("v")).alias("d"))
    wanted = pairs.filter("animal_i is not null and animal_j is not null").select(
        F.least("animal_i", "animal_j").alias("animal_i"), F.greatest("animal_i", "animal_j").alias("animal_j")
    )
    ids = geno.select("animal").distinct()
    for c in ("animal_i", "animal_j"):
        wanted = wanted.join(ids.select(F.col("animal").alias(c)), c, "left_semi")
    left = z.select(F.col("animal").alias("animal_i"), "snp", F.col("z").alias("__a"))
    right = z.select(F.col("animal").alias("animal_j"), "snp", F.col("z").alias("__b"))
    both = wanted.distinct().join(left, "animal_i").join(right, ["animal_j", "snp"])
    sums = both.groupBy("animal_i", "animal_j").agg(F.sum(F.col("__a") * F.col("__b")).alias("s"))
    return sums.select("animal_i", "animal_j", (F.col("s") / denominator.scalar()).alias("value"))


def _stacked_r(frame: DataFrame, names: list[str]) -> np.ndarray:
    """R of the QR factorisation of a tall table. Each task factors its rows, the factors are stacked and factored again in groups until few are left."""
    width = len(names)

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            r = np.linalg.qr(np.vstack([r, np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in r.T], names=names)

    schema = ", ".join(f"{n} double" for n in names)
    parts = frame.select(*names).mapInArrow(factor, schema)
    tasks = parts.rdd.getNumPartitions()
    while tasks > _TREE:
        tasks = -(-tasks // _TREE)
        parts = parts.repartition(tasks).mapInArrow(factor, schema)
    rows = parts.toArrow()
    return np.linalg.qr(np.column_stack([c.to_numpy() for c in rows.columns]), mode="r") if rows.num_rows else np.zeros((0, width))


def _products(frame: DataFrame, left: list[str], right: list[str]) -> np.ndarray:
    """left' right over all rows."""
    row = frame.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"s{i}_{j}") for i, a in enumerate(left) for j, b in enumerate(right)]).first()
    return np.array([[row[f"s{i}_{j}"] or 0.0 for j in range(len(right))] for i in range(len(left))])


def _combined(sources: list[str], m: np.ndarray, out: list[str]) -> list[Column]:
    """Columns ``out`` = sources * m."""
    return [sum((F.col(s) * float(m[i, j]) for i, s in enumerate(sources)), F.lit(0.0)).alias(o) for j, o in enumerate(out)]


def _dealt(z: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows kept by marker, in as many parts as tasks run at a time, or more if a part would hold over ``_BLOCK`` rows."""
    parts = max(z.sparkSession.sparkContext.defaultParallelism, n // _BLOCK + 1)
    return z.repartition(parts, "snp").sortWithinPartitions("snp").persist()


def _multiplied(z: DataFrame, vectors: DataFrame, names: list[str], out: list[str]) -> DataFrame:
    """Z Z' times the columns ``names`` of ``vectors``: (animal, out)."""
    down = z.join(vectors, "animal").groupBy("snp").agg(*[F.sum(F.col("z") * F.col(n)).alias(n) for n in names])
    return z.join(shuffled(down), "snp").groupBy("animal").agg(*[F.sum(F.col("z") * F.col(n)).alias(o) for n, o in zip(names, out, strict=True)])


def _polynomial(values: np.ndarray, degree: int, wanted: float) -> tuple[float, int]:
    """Half of the interval on which a Chebyshev polynomial stays small, and its degree, from falling eigenvalues.

    The degree rises from ``degree`` to eight times that, until the first direction grows by ``_GROWTH`` (more would cost digits) or by ``wanted`` times.
    If the values are too close even for the highest degree, the interval ends below them, or values inside of it might not be damped at all.
    """
    cut = max(values[-1], 1e-6 * values[0])
    rate = np.arccosh(max(2 * values[0] / cut - 1, 1.0))
    steps = int(np.clip(np.ceil(np.arccosh(np.clip(wanted, 1.0, _GROWTH)) / max(rate, 1e-12)), degree, 8 * degree))
    if 8 * degree * rate < np.arccosh(_LEAST_GROWTH):
        steps = 8 * degree
        cut = 2 * values[0] / (1 + np.cosh(np.arccosh(_LEAST_GROWTH) / steps))
    return float(cut / 2), steps


def pca(geno: DataFrame, k: int = 2, tolerance: float = 1e-7, extra: int = 14, degree: int = 4, seed: int = 1) -> DataFrame:
    """Leading principal components of standardised dosages: (animal, pc, score, eigenvalue, share).

    Subspace iteration: a tall table of k + extra columns, one row per animal, is multiplied by Z and Z' through joins and sums. Its
    columns are made orthonormal by a tree of QR factors, so only matrices of k + extra rows reach the driver. Each round multiplies by a
    Chebyshev polynomial of Z Z' that is small on the eigenvalues below the last column's. Its degree is at least ``degree`` and, where the eigenvalues
    are close, up to eight times as high: one polynomial parts them far better than several of low degree.
    Rounds go on until the largest principal angle between the k leading directions and their image has a sine below ``tolerance``.

    Genotypes are dealt by marker once and kept so: sums by marker, and their products with the genotypes, are made where the marker is. What is moved in a
    multiplication is one row per animal and task. The table of vectors is sent to all tasks up to ``_SENT`` bytes and joined by a shuffle beyond.
    """
    z = cut_lineage(standardise(geno).select("animal", "snp", "z"))
    size = k + extra
    total, n_snps, n = z.agg(F.sum(F.col("z") * F.col("z")), F.count_distinct("snp"), F.count(F.lit(1))).first()
    x, y, w = ([f"{c}{i}" for i in range(size)] for c in "xyw")
    if not n_snps:
        return z.select("animal", F.lit(0).alias("pc"), *[F.lit(0.0).alias(c) for c in ("score", "eigenvalue", "share")]).limit(0)
    start = [(F.pmod(F.xxhash64("animal", F.lit(seed + i)), F.lit(1_000_003)) / 1_000_003.0 - 0.5).alias(n) for i, n in enumerate(y)]
    frame = cut_lineage(z.select("animal").distinct().select("animal", *start))
    small = frame.count() * (size + 1) * 8 <= _SENT
    z = _dealt(z, n)

    def times(frame: DataFrame) -> DataFrame:
        vectors = frame.select("animal", *y)
        up = _multiplied(z, vectors.hint("broadcast") if small else vectors, y, w)
        return frame.join(up, "animal")

    def orthonormal(frame: DataFrame, names: list[str]) -> DataFrame:
        _, s, v = np.linalg.svd(_stacked_r(frame, names), full_matrices=False)
        full = s > 1e-12 * s.max(initial=0)
        m = np.zeros((size, size))
        m[:, : full.sum()] = v[full].T / s[full]
        return frame.select("animal", *_combined(names, m, y))

    basis = orthonormal(frame, y)
    while True:
        image = cut_lineage(times(basis))  # y orthonormal, w = Z Z' y
        values, vectors = np.linalg.eigh(_symmetric(_products(image, y, w)))
        values, vectors = np.maximum(values[::-1], 1e-12), vectors[:, ::-1]
        lead, moved = [f"u{i}" for i in range(k)], [f"m{i}" for i in range(k)]
        turned = image.select("animal", *_combined(y, vectors[:, :k], lead), *_combined(w, vectors[:, :k], moved))
        # what an image has outside of the old directions; its size against the image is the sine of the angle
        off = turned.select(*moved, *[(F.col(m) - F.col(u) * float(v)).alias(f"o{i}") for i, (m, u, v) in enumerate(zip(moved, lead, values, strict=False))])
        gram, rest = _symmetric(_products(off, moved, moved)), _symmetric(_products(off, *[[f"o{i}" for i in range(k)]] * 2))
        inner, axes = np.linalg.eigh(gram)
        whiten = axes / np.sqrt(np.maximum(inner, 1e-300))
        sine = np.sqrt(max(np.linalg.eigvalsh(whiten.T @ rest @ whiten).max(), 0))
        if sine <= tolerance:
            break
        # Chebyshev polynomial on [0, smallest value kept], by its recurrence
        half, steps = _polynomial(values, degree, 10 * sine / tolerance)
        frame = image.select("animal", *[F.col(b).alias(a) for a, b in zip(x, y, strict=True)], *[(F.col(c) / half - F.col(b)).alias(b) for b, c in zip(y, w, strict=True)])
        for _ in range(steps - 1):
            step = [(2 * (F.col(c) / half - F.col(b)) - F.col(a)).alias(b) for a, b, c in zip(x, y, w, strict=True)]
            frame = cut_lineage(times(frame).select("animal", *[F.col(b).alias(a) for a, b in zip(x, y, strict=True)], *step))
        basis = orthonormal(frame.select("animal", *y), y)
    z.unpersist()
    scores = turned.select("animal", *_combined(moved, axes @ np.diag(1 / np.sqrt(np.maximum(inner, 1e-300))) @ axes.T, lead))
    cells = [
        F.struct(
            F.lit(i + 1).alias("pc"), F.col(lead[i]).alias("score"),
            F.lit(float(values[i] / n_snps)).alias("eigenvalue"), F.lit(float(values[i] / total)).alias("share"),
        )
        for i in range(k)
    ]
    return scores.select("animal", F.inline(F.array(*cells)))


def _symmetric(m: np.ndarray) -> np.ndarray:
    return (m + m.T) / 2


def _cross_products(names: list[str], weight) -> list:
    cells = []
    for i, a in enumerate(names):
        for b in names[i:]:
            cells.append(F.sum(weight * F.col(a) * F.col(b)).alias(f"s_{a}_{b}"))
    return cells


def _sweep(df: DataFrame, names: list[str], pivots: list[str], keep: list[str]) -> DataFrame:
    """Take the pivots out of a matrix of cross-products held in columns, one elimination step per pivot."""
    rest = list(names)
    # a pivot that is rounding noise of its own unswept sum is linearly dependent: nothing can be tested then
    df = df.withColumns({f"__raw_{p}": F.col(f"s_{p}_{p}") for p in pivots})
    keep = [*keep, *[f"__raw_{p}" for p in pivots]]
    for pivot in pivots:
        rest = [n for n in rest if n != pivot]
        own = F.col(f"s_{pivot}_{pivot}")
        cols = []
        for i, a in enumerate(rest):
            for b in rest[i:]:
                pa = f"s_{pivot}_{a}"
                pb = f"s_{pivot}_{b}"
                cols.append(
                    (F.col(f"s_{a}_{b}") - F.col(pa) * F.col(pb) / F.when(own > 1e-10 * F.col(f"__raw_{pivot}"), own)).alias(f"s_{a}_{b}")
                )
        df = df.select(*keep, *cols)
    return df


def _tested_effect(df: DataFrame, by: list[str], regressors: list[str], y: str, weight) -> DataFrame:
    """Effect of the last regressor in a weighted regression of y on all regressors and a mean, per group."""
    rows = df.withColumn("one", F.lit(1.0))
    names = ["one", *regressors, y]
    tested = regressors[-1]
    sums = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *_cross_products(names, weight))
    sums = sums.withColumn("__raw", F.col(f"s_{tested}_{tested}"))
    swept = _sweep(sums, names, ["one", *regressors[:-1]], [*by, "n", "__raw"])
    sgg, sgy, syy = F.col(f"s_{tested}_{tested}"), F.col(f"s_{tested}_{y}"), F.col(f"s_{y}_{y}")
    dof = F.col("n") - len(regressors) - 1
    # markers whose residual variation is rounding noise of their own sum of squares cannot be tested
    ok = (sgg > 1e-10 * F.col("__raw")) & (dof > 0)
    b = F.when(ok, sgy / sgg)
    sse = F.greatest(syy - sgy * sgy / sgg, F.lit(0.0))
    se = F.when(ok, F.sqrt(sse / dof / sgg))
    out = swept.select(*by, "n", b.alias("b"), se.alias("se"), F.when(ok & (syy > 0), sgy * sgy / sgg / syy).alias("r2"))
    stat = F.when(F.col("se") > 0, F.col("b") / F.col("se"))
    return out.withColumn("t", stat).withColumn("__t2", F.col("t") * F.col("t")).withColumn("p", chi2_1_sf("__t2")).drop("__t2")


def snp_regression(
    geno: DataFrame, pheno: DataFrame, y: str, covars: list[str] | None = None, weight: str | None = None
) -> DataFrame:
    """Per-marker weighted least squares of y on dosage and covariates: n, b, se, t, p (Wald) and the share of
    residual variance explained. No kinship term: adjust with principal components as covariates.

    All markers are fitted from one aggregation of cross-products; missing calls leave their row out.
    """
    covars = covars or []
    p = _centred(pheno, [y, *covars])
    rows = geno.filter(F.col("dosage").isNotNull()).join(p, "animal").filter(F.col(y).isNotNull())
    rows = rows.withColumn("g", F.col("dosage").cast("double"))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return _tested_effect(rows, ["snp"], [*covars, "g"], y, w)


def gxe_regression(geno: DataFrame, pheno: DataFrame, y: str, env: str, covars: list[str] | None = None) -> DataFrame:
    """Per-marker test of dosage x environment next to both main effects."""
    covars = covars or []
    p = _centred(pheno, [y, env, *covars])
    rows = geno.filter(F.col("dosage").isNotNull()).join(p, "animal").filter(F.col(y).isNotNull() & F.col(env).isNotNull())
    rows = rows.withColumn("g", F.col("dosage").cast("double")).withColumn("gxe", F.col("g") * F.col(env))
    return _tested_effect(rows, ["snp"], [*covars, env, "g", "gxe"], y, F.lit(1.0))


def _centred(pheno: DataFrame, cols: list[str]) -> DataFrame:
    """Centre columns by their means; leaves all slopes as they are and keeps the sums well conditioned."""
    means = pheno.agg(*[F.avg(c).alias(c) for c in cols])
    return pheno.withColumns({c: F.col(c).cast("double") - means.select(c).scalar() for c in cols})


def _squared_correlation(both: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, r2) from the planes of both sides in the chunks they share. Sums are whole numbers, so equal data give equal values."""
    sums = both.groupBy(a, b).agg(*[c.cast("double").alias(f"__{name}") for name, c in P.dosage_sums("_a", "_b").items()])
    n, x, y, xx, yy, xy = (F.col(f"__{c}") for c in ("n", "x", "y", "xx", "yy", "xy"))
    top = n * xy - x * y
    return sums.select(a, b, F.try_divide(top * top, (n * xx - x * x) * (n * yy - y * y)).alias("r2"))


def pair_r2(pairs: DataFrame, planes: DataFrame, a: str, b: str) -> DataFrame:
    """Squared correlation of dosages per marker pair over animals called for both, from packed markers (snp, chunk, lo, hi).

    A marker of many pairs is spread over its chunks.
    """
    both = pairs.join(P.side(planes, "snp", a, "_a"), a).join(P.side(planes, "snp", b, "_b"), [b, "chunk"])
    return _squared_correlation(both, a, b)


def _linked(tested: DataFrame, planes: DataFrame, window: int, r2: float) -> DataFrame:
    """(lead, snp): pairs of tested markers within the window and above the r2 limit, the one of better p first.

    Markers meet by stretch of the chromosome and chunk of animals, so pairs without an animal called for both are not made.
    """
    here = planes.join(shuffled(tested.withColumn("__bin", F.floor(F.col("pos") / window))), "snp")
    side = lambda name, s: here.select(F.col("snp").alias(name), "chr", "__bin", "chunk", F.col("pos").alias(f"__pos{s}"), F.col("p").alias(f"__p{s}"), F.col("lo").alias(f"lo{s}"), F.col("hi").alias(f"hi{s}"))
    other = side("snp", "_b").withColumn("__bin", F.explode(F.array(F.col("__bin") - 1, F.col("__bin"), F.col("__bin") + 1)))
    both = side("lead", "_a").join(shuffled(other), ["chr", "__bin", "chunk"])
    both = both.filter((F.struct("__p_a", "lead") < F.struct("__p_b", "snp")) & (F.abs(F.col("__pos_a") - F.col("__pos_b")) <= window) & (P.all_called("_a", "_b") != 0))
    return _squared_correlation(both, "lead", "snp").filter(F.round("r2", 9) > r2).select("lead", "snp")


def ld_clump(
    results: DataFrame, geno: DataFrame, window: int = 1_000_000, r2: float = 0.1, p_max: float = 1e-5,
) -> DataFrame:
    """Independent lead markers: best p first, markers within the window and above the r2 limit go with it.

    ``results``: snp, chr, pos, p; of several rows of a marker the best p counts. r2 is compared after rounding to nine digits. Links of tested markers are found in one
    job. A round takes every marker without a better linked one left and removes those linked to it; these are exactly the markers a one-by-one pass would
    choose. Markers without links need no round, and rounds follow chains of links, not the number of markers in a window.
    """
    tested = results.filter(F.col("p") <= p_max).filter("snp is not null").select("snp", "chr", "pos", "p")
    best = tested.groupBy("snp").agg(F.min("p").alias("p"))
    tested = cut_lineage(tested.select("snp", "chr", "pos").distinct().join(shuffled(best), "snp"))
    calls = geno.join(shuffled(tested.select("snp").distinct()), "snp", "left_semi")
    planes = cut_lineage(P.pack(calls, "snp", P.bit_places(calls, "animal")))
    links = cut_lineage(_linked(tested, planes, int(window), r2))
    gone = None
    while not links.isEmpty():
        tops = links.select("lead").distinct().join(shuffled(links.select(F.col("snp").alias("lead"))), "lead", "left_anti")
        out = cut_lineage(links.join(shuffled(tops), "lead", "left_semi").select("snp").distinct())
        left = links.join(shuffled(out), "snp", "left_anti")
        links = cut_lineage(left.join(shuffled(out.withColumnRenamed("snp", "lead")), "lead", "left_anti").select("lead", "snp"))
        gone = out if gone is None else gone.unionByName(out)
    leads = tested.select("snp") if gone is None else tested.select("snp").join(shuffled(gone), "snp", "left_anti")
    return results.join(shuffled(leads.distinct()), "snp", "left_semi").select("snp", "chr", "pos", "p")
