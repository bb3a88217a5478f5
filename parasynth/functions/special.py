"""Gamma distribution and test p-values: small numeric helpers.

Used through Arrow-batched UDFs on rows that Spark has already reduced (one per
variable or test), and for the gamma marginal, which has no closed form.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

TINY = 1e-300


def _lgamma(a: np.ndarray) -> np.ndarray:
    """Once per distinct shape: a variable has one, whatever its rows."""
    if len(a) and (a == a[0]).all():
        return np.full(len(a), math.lgamma(a[0]))
    shapes, where = np.unique(a, return_inverse=True)
    return np.array([math.lgamma(s) for s in shapes.tolist()])[where] if len(a) else a


def gamma_p(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma P(a, x), elementwise."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    out = np.full(a.shape, np.nan)
    out[(x <= 0) & (a > 0)] = 0.0
    out[np.isposinf(x) & (a > 0)] = 1.0
    ok = (a > 0) & (x > 0) & np.isfinite(x)
    logs = np.zeros(a.shape)
    logs[ok] = a[ok] * np.log(x[ok]) - x[ok] - _lgamma(a[ok])
    series = ok & (x < a + 1)
    if series.any():
        out[series] = np.exp(logs[series]) * _gamma_series(a[series], x[series])
    tail = ok & ~series
    if tail.any():
        out[tail] = 1.0 - np.exp(logs[tail]) * _gamma_fraction(a[tail], x[tail])
    return out


def _gamma_series(a, x):
    out, at = np.empty(a.shape), np.arange(len(a))
    term = 1.0 / a
    total, n = term.copy(), a.copy()
    for _ in range(100000):
        n = n + 1.0
        term = term * x / n
        total = total + term
        live = np.abs(term) >= np.abs(total) * 1e-16
        if not live.all():  # settled elements leave, so each is as it would be alone
            out[at[~live]] = total[~live]
            at, x, n, term, total = at[live], x[live], n[live], term[live], total[live]
            if not len(at):
                return out
    out[at] = total
    return out


def _gamma_fraction(a, x):
    out, at = np.empty(a.shape), np.arange(len(a))
    b = x + 1.0 - a
    c = np.full(a.shape, 1.0 / TINY)
    d = 1.0 / b
    h = d.copy()
    for i in range(1, 100000):
        an = -i * (i - a)
        b = b + 2.0
        d = an * d + b
        d = np.where(np.abs(d) < TINY, TINY, d)
        c = b + an / c
        c = np.where(np.abs(c) < TINY, TINY, c)
        d = 1.0 / d
        step = d * c
        h = h * step
        live = np.abs(step - 1.0) >= 1e-15
        if not live.all():
            out[at[~live]] = h[~live]
            at, a, b, c, d, h = at[live], a[live], b[live], c[live], d[live], h[live]
            if not len(at):
                return out
    out[at] = h
    return out


def gamma_ppf(a: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Inverse of P(a, .): Wilson-Hilferty start, then bracketed Newton steps."""
    a, u = (v.copy() for v in np.broadcast_arrays(np.asarray(a, float), np.asarray(u, float)))
    out = np.full(a.shape, np.nan)
    out[u <= 0] = 0.0
    out[u >= 1] = np.inf
    ok = (u > 0) & (u < 1) & (a > 0)
    if not ok.any():
        return out
    a, u = a[ok], u[ok]
    lgam = _lgamma(a)
    t = np.sqrt(-2.0 * np.log(np.minimum(u, 1 - u)))
    z = t - (2.30753 + 0.27061 * t) / (1 + t * (0.99229 + 0.04481 * t))
    z = np.where(u < 0.5, -z, z)
    start = a * (1.0 - 1.0 / (9.0 * a) + z / (3.0 * np.sqrt(a))) ** 3
    low_start = np.exp((np.log(u) + lgam + np.log(a)) / a)
    x = np.where((a < 1) | (start <= 0) | (u < 0.01), np.maximum(low_start, TINY), start)
    low, high, at, found = np.zeros_like(x), np.full_like(x, np.inf), np.arange(len(x)), np.empty_like(x)
    for _ in range(200):
        p = gamma_p(a, x)
        low = np.where(p < u, x, low)
        high = np.where(p >= u, x, high)
        density = np.exp((a - 1) * np.log(np.maximum(x, TINY)) - x - lgam)
        step = x - (p - u) / np.maximum(density, TINY)
        middle = np.where(np.isinf(high), 2 * x + 1e-12, 0.5 * (low + high))
        new = np.where((step > low) & (step < high), step, middle)
        moved = np.abs(new - x) > 1e-13 * np.abs(x)
        x = new
        if not moved.all():
            found[at[~moved]] = x[~moved]
            at, a, u, lgam, x, low, high = (v[moved] for v in (at, a, u, lgam, x, low, high))
            if not len(at):
                break
    found[at] = x
    out[ok] = found
    return out


@F.pandas_udf(T.DoubleType())
def gamma_cdf_udf(x: pd.Series, shape: pd.Series, scale: pd.Series) -> pd.Series:
    return pd.Series(gamma_p(shape.to_numpy(float), x.to_numpy(float) / scale.to_numpy(float)))


@F.pandas_udf(T.DoubleType())
def gamma_ppf_udf(u: pd.Series, shape: pd.Series, scale: pd.Series) -> pd.Series:
    return pd.Series(gamma_ppf(shape.to_numpy(float), u.to_numpy(float)) * scale.to_numpy(float))


# --- p-values ------------------------------------------------------------------


def chi2_sf(statistic: float, dof: float) -> float:
    if math.isnan(statistic):
        return math.nan
    if dof <= 0:
        return math.nan
    if statistic <= 0:
        return 1.0
    if math.isinf(statistic):
        return 0.0
    a, x = dof / 2.0, statistic / 2.0
    if x < a + 1:
        return float(1.0 - gamma_p(np.array([a]), np.array([x]))[0])
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    return float(scale * _gamma_fraction(np.array([a]), np.array([x]))[0])


def kolmogorov_sf(d: float, n: int) -> float:
    """P(D_n >= d): exact matrix form for small n, Pelz-Good series beyond."""
    if math.isnan(d) or n <= 0:
        return math.nan
    if d <= 0.5 / n:
        return 1.0
    if d >= 1.0:
        return 0.0
    if n * d * d > 18.0:
        return min(1.0, 2.0 * _one_sided(d, n))
    value = _kolmogorov_exact(d, n) if n <= 140 else _pelz_good(d, n)
    return min(1.0, max(0.0, 1.0 - value))


def _one_sided(d: float, n: int) -> float:
    """Asymptotic one-sided tail, with the usual finite-n correction."""
    s = 6.0 * n * d + 1.0
    return math.exp(-s * s / (18.0 * n))


def _kolmogorov_exact(d: float, n: int) -> float:
    """Marsaglia, Tsang and Wang (2003): P(D_n < d) as a matrix power."""
    k = int(n * d) + 1
    size = 2 * k - 1
    h = k - n * d
    m = np.array([[1.0 if i - j + 1 >= 0 else 0.0 for j in range(size)] for i in range(size)])
    for i in range(size):
        m[i, 0] -= h ** (i + 1)
        m[size - 1, i] -= h ** (size - i)
    m[size - 1, 0] += (2 * h - 1) ** size if 2 * h - 1 > 0 else 0.0
    for i in range(size):
        for j in range(size):
            if i - j + 1 > 0:
                m[i, j] /= math.factorial(i - j + 1)
    power, exponent = np.eye(size), 0
    base, base_exponent, left = m, 0, n
    while left:
        if left & 1:
            power, exponent = power @ base, exponent + base_exponent
        base, base_exponent, left = base @ base, 2 * base_exponent, left >> 1
        for_scale = base[k - 1, k - 1]
        if for_scale > 1e140:
            base, base_exponent = base * 1e-140, base_exponent + 140
        if power[k - 1, k - 1] > 1e140:
            power, exponent = power * 1e-140, exponent + 140
    value = power[k - 1, k - 1]
    for i in range(1, n + 1):
        value = value * i / n
        if value < 1e-140:
            value, exponent = value * 1e140, exponent - 140
    return value * 10.0**exponent


def _pelz_good(d: float, n: int) -> float:
    """Pelz and Good (1976): four terms in powers of n**-1/2."""
    z = math.sqrt(n) * d
    z2 = z * z
    pi2 = math.pi**2
    half, whole = np.arange(0, 60) + 0.5, np.arange(1, 60)
    h2, w2 = half**2, whole**2
    eh = 2 * np.exp(-pi2 * h2 / (2 * z2))  # k and -(k+1) give the same term
    ew = 2 * np.exp(-pi2 * w2 / (2 * z2))
    root = math.sqrt(math.pi / 2)
    k0 = math.sqrt(2 * math.pi) / z * float(np.sum(eh)) / 2
    k1 = root / (6 * z**4) * float(np.sum((pi2 * h2 - z2) * eh))
    k2 = root / (72 * z**7) * float(
        np.sum(((6 * z2**3 + 2 * z2**2) + pi2 * (2 * z2**2 - 5 * z2) * h2 + pi2**2 * (1 - 2 * z2) * h2**2) * eh)
    ) - root / (36 * z**3) * float(np.sum(pi2 * w2 * ew))
    k3 = root / (6480 * z**10) * float(
        np.sum(
            (
                pi2**3 * h2**3 * (5 - 30 * z2)
                + pi2**2 * h2**2 * (-60 * z2 + 212 * z2**2)
                + pi2 * h2 * (135 * z2**2 - 96 * z2**3)
                + (-30 * z2**3 - 90 * z2**4)
            )
            * eh
        )
    ) + root / (216 * z**6) * float(np.sum((3 * pi2 * w2 * z2 - pi2**2 * w2**2) * ew))
    return k0 + k1 / math.sqrt(n) + k2 / n + k3 / n**1.5


def student_t_two_sided(t: float, dof: float) -> float:
    if math.isnan(t) or dof <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    return _beta_i(dof / 2.0, 0.5, dof / (dof + t * t))


def _beta_i(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def _beta_fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > TINY else TINY)
    h = d
    for m in range(1, 10000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > TINY else TINY)
            c = 1.0 + num / c
            c = c if abs(c) > TINY else TINY
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def wilcoxon_p(w: float, n: int, tie_term: float, exact: bool) -> float:
    """Two-sided p of the signed-rank statistic min(W+, W-)."""
    if n <= 0 or math.isnan(w):
        return math.nan
    if exact:
        counts = np.zeros(n * (n + 1) // 2 + 1)
        counts[0] = 1.0
        for i in range(1, n + 1):
            shifted = np.zeros_like(counts)
            shifted[i:] = counts[:-i]
            counts = counts + shifted
        return float(min(1.0, 2.0 * counts[: int(w) + 1].sum() / 2.0**n))
    mean = n * (n + 1) / 4.0
    variance = n * (n + 1) * (2 * n + 1) / 24.0 - tie_term / 48.0
    if variance <= 0:
        return math.nan
    return math.erfc(abs(w - mean) / math.sqrt(variance) / math.sqrt(2.0))


def _over(fn, *columns):
    return pd.Series([
        float("nan") if any(v is None or v != v for v in row) else fn(*row) for row in zip(*columns)
    ], dtype=float)


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return _over(lambda s, k: chi2_sf(float(s), float(k)), statistic, dof)


@F.pandas_udf(T.DoubleType())
def kolmogorov_sf_udf(d: pd.Series, n: pd.Series) -> pd.Series:
    return _over(lambda v, k: kolmogorov_sf(float(v), int(k)), d, n)


@F.pandas_udf(T.DoubleType())
def student_t_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _over(lambda v, k: student_t_two_sided(float(v), float(k)), t, dof)


@F.pandas_udf(T.DoubleType())
def wilcoxon_udf(w: pd.Series, n: pd.Series, tie_term: pd.Series, exact: pd.Series) -> pd.Series:
    return _over(lambda a, b, c, e: wilcoxon_p(float(a), int(b), float(c), bool(e)), w, n, tie_term, exact)


@F.pandas_udf(T.DoubleType())
def mean_nearest_udf(points: pd.Series) -> pd.Series:
    """Mean distance to the nearest other point, per (bounded) set of points."""
    out = []
    for listed in points:
        x = np.array([np.asarray(p, dtype=float) for p in listed])
        nearest = []
        for i in range(len(x)):
            gap = ((x - x[i]) ** 2).sum(axis=1)
            gap[i] = np.inf
            nearest.append(math.sqrt(gap.min()))
        out.append(float(np.mean(nearest)) if nearest else float("nan"))
    return pd.Series(out, dtype=float)
