"""Distribution tails on numpy arrays, and the columns made of them.

A column function here is an Arrow function: a batch of values goes to numpy as it is and comes back as one array. To the planner such a call is one
short expression, so that a filter, a sort or a join on its result plans like one on a plain column.

Normal quantile: Wichura's AS241 (1988). Complementary error function: Cody (1969). Both about 1e-16 relative.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from herdframe.functions.base import ColumnLike, col

# fixed values: AS241 numerators and denominators, highest power first (centre, middle, tail)
AS241_CENTRE = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
     1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
     5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0),
)
AS241_MIDDLE = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258,
     3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940, 2.05319162663775882187, 1.0),
)
AS241_TAIL = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
     2.96560571828504891230e-1, 1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
     1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
)
# fixed values: Cody's rational approximations, highest power first (small, medium, large argument)
CODY_SMALL = (
    (1.85777706184603153e-1, 3.16112374387056560, 1.13864154151050156e2, 3.77485237685302021e2,
     3.20937758913846947e3),
    (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3),
)
CODY_MEDIUM = (
    (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594, 6.61191906371416295e1,
     2.98635138197400131e2, 8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3,
     1.23033935479799725e3),
    (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
     3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3),
)
CODY_LARGE = (
    (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1,
     1.60837851487422766e-2, 6.58749161529837803e-4),
    (1.0, 2.56852019228982242, 1.87295284992346725, 5.27905102951428412e-1, 6.05183413124413191e-2,
     2.33520497626869185e-3),
)


def _ratio(pair: tuple, x: np.ndarray) -> np.ndarray:
    return np.polyval(pair[0], x) / np.polyval(pair[1], x)


def norm_quantile(p: np.ndarray) -> np.ndarray:
    """Standard normal quantile; undefined outside (0, 1)."""
    q = p - 0.5
    r = np.sqrt(-np.log(np.minimum(p, 1 - p)))
    centre = q * _ratio(AS241_CENTRE, 0.180625 - q * q)
    side = np.sign(q) * np.where(r <= 5, _ratio(AS241_MIDDLE, r - 1.6), _ratio(AS241_TAIL, r - 5))
    return np.where((p > 0) & (p < 1), np.where(np.abs(q) <= 0.425, centre, side), np.nan)


def erfc_scaled(y: np.ndarray) -> np.ndarray:
    """exp(y^2) erfc(y) for y >= 0; does not underflow."""
    square = y * y
    inverse = 1 / np.maximum(square, 16)
    small = np.exp(np.minimum(square, 1)) * (1 - y * _ratio(CODY_SMALL, np.minimum(square, 1)))
    medium = _ratio(CODY_MEDIUM, np.minimum(y, 4))
    large = (1 / math.sqrt(math.pi) - inverse * _ratio(CODY_LARGE, inverse)) / np.maximum(y, 4)
    return np.where(y >= 0, np.where(y <= 0.46875, small, np.where(y <= 4, medium, large)), np.nan)


def erfc_of(x: np.ndarray) -> np.ndarray:
    tail = np.exp(-x * x) * erfc_scaled(np.abs(x))
    return np.where(x >= 0, tail, 2 - tail)


def _chi2_1_sf(x: np.ndarray) -> np.ndarray:
    return erfc_of(np.sqrt(np.where(x < 0, 0, x) / 2))


def _chi2_1_isf(p: np.ndarray) -> np.ndarray:
    return np.where(p == 0, np.inf, np.where(p <= 1, norm_quantile(p / 2) ** 2, np.nan))


def _chi2_1_neglog10_sf(x: np.ndarray) -> np.ndarray:
    y = np.sqrt(np.where(x < 0, 0, x) / 2)
    return y * y / math.log(10) - np.log10(erfc_scaled(y))


def _chi2_sf(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Finite series, each term taken from its logarithm."""
    h = np.where(x < 0, 0, x) / 2
    df = np.floor(df)
    odd, steps = df % 2 == 1, np.floor((df - 1) / 2)
    out = np.where(odd, erfc_of(np.sqrt(h)), np.exp(-h))
    log_h = np.log(h)
    known = np.isfinite(df)
    for i in range(1, int(steps[known].max(initial=0)) + 1):
        power = np.where(odd, i - 0.5, float(i))
        base = np.where(odd, math.lgamma(i + 0.5), math.lgamma(i + 1))
        out += np.where((i <= steps) & (h > 0), np.exp(power * log_h - h - base), 0)
    return np.where(df >= 1, np.minimum(out, 1), np.nan)


def _scaled_tail(p: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Tail of the chi-square value (1 df) of p, divided by a factor: its root is all that is needed."""
    z = np.where(p == 0, np.inf, np.where(p == 1, 0, np.abs(norm_quantile(p / 2))))
    return np.where(p <= 1, erfc_of(z / np.sqrt(2 * factor)), np.nan)


def log_factorial(n: np.ndarray) -> np.ndarray:
    """ln n! : exact below 10, Stirling's series above (error under 1e-13)."""
    table = np.array([math.lgamma(i + 1) for i in range(10)])
    x = np.maximum(n, 1)
    v = 1 / x
    stirling = x * np.log(x) - x + 0.5 * np.log(2 * math.pi * x) + v * (1 / 12 - v * v * (1 / 360 - v * v * (1 / 1260 - v * v / 1680)))
    return np.where(n < 10, table[np.clip(np.nan_to_num(n), 0, 9).astype(np.int64)], stirling)


def _hypergeom_sf(hits: np.ndarray, drawn: np.ndarray, marked: np.ndarray, total: np.ndarray) -> np.ndarray:
    """P(X >= hits). Beyond the mean terms are added upward from ``hits``, below it downward from the one before and taken from one; both ways
    they shrink, and a row is done when its terms no longer count."""
    low, high = np.maximum(0, drawn + marked - total), np.minimum(drawn, marked)
    up = hits * total > drawn * marked
    i = np.where(up, hits, hits - 1)
    inside = (i >= low) & (i <= high)
    at = np.clip(i, low, high)
    parts = [marked, total - marked, drawn, total - drawn]
    under = [at, marked - at, drawn - at, total - marked - drawn + at, total]
    term = np.where(inside, np.exp(sum(map(log_factorial, parts)) - sum(map(log_factorial, under))), 0)
    sums, active = term.copy(), np.flatnonzero(term > 0)
    i = at.copy()
    while len(active):
        a, n, m, t = i[active], drawn[active], marked[active], total[active]
        rise = (m - a) * (n - a) / ((a + 1) * (t - m - n + a + 1))
        fall = a * (t - m - n + a) / ((m - a + 1) * (n - a + 1))
        term[active] *= np.where(up[active], rise, fall)
        sums[active] += term[active]
        i[active] += np.where(up[active], 1, -1)
        active = active[term[active] > 1e-17 * sums[active]]
    tail = np.minimum(np.where(up, sums, 1 - sums), 1)
    known = np.isfinite(hits + drawn + marked + total)
    return np.where(known, np.where(hits <= low, 1, np.where(hits > high, 0, tail)), np.nan)


def arrow_column(fn: Callable[..., np.ndarray]) -> Callable[..., Column]:
    """A function of columns from one of double arrays; null where an argument is null or the value undefined."""

    def evaluate(*args: pa.Array) -> pa.Array:
        values = [pc.cast(a, pa.float64()).to_numpy(zero_copy_only=False) for a in args]
        with np.errstate(all="ignore"):
            return pa.array(fn(*values), pa.float64(), from_pandas=True)

    evaluate.__name__ = fn.__name__.strip("_")
    made = F.arrow_udf(evaluate, DoubleType())

    def call(*columns: ColumnLike) -> Column:
        return made(*[col(c).cast("double") for c in columns])

    call.__name__, call.__doc__ = evaluate.__name__, fn.__doc__
    return call


norm_ppf = arrow_column(norm_quantile)
erfcx = arrow_column(erfc_scaled)
erfc = arrow_column(erfc_of)
chi2_1_sf = arrow_column(_chi2_1_sf)
chi2_1_isf = arrow_column(_chi2_1_isf)
chi2_1_neglog10_sf = arrow_column(_chi2_1_neglog10_sf)
chi2_sf = arrow_column(_chi2_sf)
scaled_tail = arrow_column(_scaled_tail)
hypergeom_sf = arrow_column(_hypergeom_sf)
