"""Genetic evaluation formulas and test statistics as expressions; distribution tails are in ``tails``."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from herdframe.functions.base import ColumnLike, col
from herdframe.functions.tails import chi2_1_neglog10_sf

# median of the chi-square distribution with one degree of freedom
CHI2_1_MEDIAN = 0.45493642311957283


def lrt_neglog10p(ll_null: ColumnLike, ll_test: ColumnLike, mode: str = "reference") -> Column:
    """-log10 p of the difference of two -2logL values, one degree of freedom.

    ``reference`` halves the log of p, ``mixture`` halves p (boundary test), ``plain`` leaves it.
    """
    value = chi2_1_neglog10_sf(col(ll_null) - col(ll_test))
    if mode == "reference":
        return value / 2
    if mode == "mixture":
        return value + math.log10(2)
    if mode == "plain":
        return value
    raise ValueError(f"unknown mode {mode}")


def reliability(u: ColumnLike, se: ColumnLike, f: ColumnLike, option: str = "reliability", floor: bool = False) -> Column:
    """1 - se^2 / ((1 + f) u), or one minus its root for the breed-improvement scale."""
    ratio = (col(se) * col(se)) / ((1 + col(f)) * col(u))
    if option not in ("reliability", "bif"):
        raise ValueError(f"unknown option {option}")
    out = 1 - (ratio if option == "reliability" else F.sqrt(ratio))
    return F.greatest(out, F.lit(0.0)) if floor else out


def deregress(
    ebv: ColumnLike, r2: ColumnLike, sire_ebv: ColumnLike, sire_r2: ColumnLike, dam_ebv: ColumnLike,
    dam_r2: ColumnLike, h2: float, c: float = 0.1,
) -> dict[str, Column]:
    """De-regressed proof, its reliability and weight after Garrick, Taylor and Fernando (2009)."""
    lam = (1 - h2) / h2
    pa = (col(sire_ebv) + col(dam_ebv)) / 2
    r2_pa = (col(sire_r2) + col(dam_r2)) / 4
    alpha = 1 / (0.5 - r2_pa)
    delta = (0.5 - r2_pa) / (1 - col(r2))
    zz_pa = lam * (0.5 * alpha - 4) + 0.5 * lam * F.sqrt(alpha * alpha + 16 / delta)
    zz = delta * zz_pa + 2 * lam * (2 * delta - 1)
    drp = (-2 * lam * pa + (zz + 2 * lam) * col(ebv)) / zz
    r2_drp = 1 - lam / (zz + lam)
    weight = (1 - h2) / ((c + (1 - r2_drp) / r2_drp) * h2)
    return {"drp": drp, "drp_r2": r2_drp, "drp_weight": weight}


def corr_or_null(x: ColumnLike, y: ColumnLike) -> Column:
    """Pearson correlation over pairs with both values; null when one side does not vary."""
    both = col(x).isNotNull() & col(y).isNotNull()
    a, b = F.when(both, col(x).cast("double")), F.when(both, col(y).cast("double"))
    r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


# fixed values: the lambda grid of the q-value method (Storey and Tibshirani 2003)
LAMBDA_GRID = [round(0.05 * i, 2) for i in range(1, 20)]


def smoother_weights(grid: list[float] = LAMBDA_GRID, df: float = 3.0) -> list[float]:
    """Weights w with  smoothed(last grid point) = sum w_i y_i  for a natural cubic smoothing spline whose
    smoother matrix has trace ``df`` (Green and Silverman 1994). Depends on the grid only, not on data."""
    x = np.asarray(grid, dtype=float)
    n, h = len(x), np.diff(x)
    q = np.zeros((n, n - 2))
    r = np.zeros((n - 2, n - 2))
    for j in range(n - 2):
        q[j, j], q[j + 1, j], q[j + 2, j] = 1 / h[j], -1 / h[j] - 1 / h[j + 1], 1 / h[j + 1]
        r[j, j] = (h[j] + h[j + 1]) / 3
        if j + 1 < n - 2:
            r[j, j + 1] = r[j + 1, j] = h[j + 1] / 6
    values, vectors = np.linalg.eigh(q @ np.linalg.solve(r, q.T))
    values = np.clip(values, 0, None)
    low, high = -30.0, 30.0
    for _ in range(200):
        mid = (low + high) / 2
        if np.sum(1 / (1 + math.exp(mid) * values)) > df:
            low = mid
        else:
            high = mid
    smoother = vectors @ np.diag(1 / (1 + math.exp((low + high) / 2) * values)) @ vectors.T
    return [float(w) for w in smoother[-1]]
