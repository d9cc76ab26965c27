"""Resampling and tests in numpy, for grouped-map use; no scipy."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable

import numpy as np

#: Resamples are drawn in slabs of so many counts, so memory stays bounded.
SLAB = 2_000_000


def seed_of(seed: int, *names: str) -> int:
    """A seed per statistic and stratum: results do not depend on partitions."""
    return zlib.crc32("|".join([str(seed), *names]).encode())


def resampled(values: np.ndarray, statistic: Callable[[np.ndarray, np.ndarray], np.ndarray], b: int, seed: int, counts: np.ndarray | None = None) -> np.ndarray:
    """``statistic`` of b resamples with replacement of a sample given as ascending distinct values and their counts.

    A resample is a multinomial draw of counts: time and memory grow with the distinct values, not with the rows.
    """
    counts = np.ones(len(values), np.int64) if counts is None else np.asarray(counts, np.int64)
    n, rng, found, step = int(counts.sum()), np.random.default_rng(seed), [], max(1, SLAB // max(1, len(values)))
    for k in range(0, b, step):
        found.append(statistic(values, rng.multinomial(n, counts / n, min(step, b - k))))
    return np.concatenate(found) if found else np.zeros(0)


def mean(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Means of samples given by counts of ascending values, along the last axis."""
    return (counts @ values) / counts.sum(-1)


def median(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    run, n = counts.cumsum(-1), counts.sum(-1)
    low = (run < ((n + 1) // 2)[..., None]).sum(-1)
    high = (run < (n // 2 + 1)[..., None]).sum(-1)
    return (values[low] + values[high]) / 2


def percentile_ci(values: np.ndarray, statistic: Callable[[np.ndarray, np.ndarray], np.ndarray], b: int, seed: int, level: float = 0.95, counts: np.ndarray | None = None) -> tuple[float, float]:
    """Percentile bootstrap; fewer than two values give the value itself, none NaN."""
    if len(values) < 2:
        v = float(values[0]) if len(values) else math.nan
        return v, v
    lo, hi = np.quantile(resampled(values, statistic, b, seed, counts), [(1 - level) / 2, (1 + level) / 2])
    return float(lo), float(hi)


def block_ci(rates: np.ndarray, weights: np.ndarray, b: int, seed: int, broken: float = 0.3) -> tuple[float, float]:
    """Interval of a document's weighted rate from resampled pages.

    Fewer than two pages, or a page whose rate shows that the pages do not meet, give the point itself.
    """
    point = float(np.average(rates, weights=weights)) if weights.sum() > 0 else float(rates.mean())
    if len(rates) < 2 or rates.max() >= broken:
        return point, point
    rng = np.random.default_rng(seed)
    found = []
    step = max(1, SLAB // len(rates))
    for k in range(0, b, step):
        at = rng.integers(0, len(rates), (min(step, b - k), len(rates)))
        total = weights[at].sum(-1)
        found.append(np.where(total > 0, (rates[at] * weights[at]).sum(-1) / np.where(total > 0, total, 1), rates[at].mean(-1)))
    lo, hi = np.quantile(np.concatenate(found), [0.025, 0.975])
    return float(lo), float(hi)


def bernoulli_ci(hits: int, n: int, b: int, seed: int) -> tuple[float, float]:
    """Percentile interval of a share: a resample's hits are binomial."""
    if not n:
        return math.nan, math.nan
    draws = np.sort(np.random.default_rng(seed).binomial(n, hits / n, b) / n)
    return float(draws[int(0.025 * b)]), float(draws[min(int(0.975 * b), b - 1)])


def erfinv(x: float) -> float:
    """Winitzki's approximation."""
    a = 0.147
    ln = math.log(1 - x * x)
    t = 2 / (math.pi * a) + ln / 2
    return math.copysign(math.sqrt(math.sqrt(t * t - ln / a) - t), x)


def norm_cdf(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def norm_ppf(p: float) -> float:
    return math.sqrt(2) * erfinv(2 * p - 1)


def bca_ci(values: np.ndarray, statistic: Callable[[np.ndarray, np.ndarray], np.ndarray], b: int, seed: int, level: float = 0.95, counts: np.ndarray | None = None) -> tuple[float, float]:
    """Bias-corrected and accelerated interval; acceleration by the jackknife, once for each distinct value."""
    counts = np.ones(len(values), np.int64) if counts is None else np.asarray(counts, np.int64)
    if counts.sum() < 2:
        return percentile_ci(values, statistic, b, seed, level, counts)
    point, draws = float(statistic(values, counts)), np.sort(resampled(values, statistic, b, seed, counts))
    share = min(max(float((draws < point).mean()), 1 / (2 * b)), 1 - 1 / (2 * b))
    z0 = norm_ppf(share)
    jack, step = np.zeros(len(values)), max(1, SLAB // len(values))
    for k in range(0, len(values), step):
        less = np.tile(counts, (min(step, len(values) - k), 1))
        less[np.arange(len(less)), k + np.arange(len(less))] -= 1
        jack[k : k + len(less)] = statistic(values, less)
    d = np.average(jack, weights=counts) - jack
    bottom = 6 * float((counts * d**2).sum()) ** 1.5
    a = float((counts * d**3).sum()) / bottom if bottom else 0.0

    def bound(alpha: float) -> float:
        z = z0 + norm_ppf(alpha)
        p = norm_cdf(z0 + z / (1 - a * z)) if 1 - a * z else alpha
        return float(draws[min(b - 1, max(0, int(p * (b - 1))))])

    return bound((1 - level) / 2), bound((1 + level) / 2)


def paired(diff: np.ndarray, b: int, seed: int, counts: np.ndarray | None = None) -> tuple[float, float, float, float]:
    """(mean, low, high, two-sided p) of paired differences, given as ascending distinct values and counts."""
    if not len(diff):
        return math.nan, math.nan, math.nan, math.nan
    counts = np.ones(len(diff), np.int64) if counts is None else np.asarray(counts, np.int64)
    draws, point = np.sort(resampled(diff, mean, b, seed, counts)), float(mean(diff, counts))
    opposite = float((draws <= 0).mean() if point > 0 else (draws >= 0).mean())
    return point, float(draws[int(0.025 * (b - 1))]), float(draws[int(0.975 * (b - 1))]), min(1.0, 2 * opposite)


def chi2_sf(x: float, df: int) -> float:
    """Wilson and Hilferty's approximation of the upper tail."""
    if df <= 0 or x <= 0:
        return 1.0
    k = 2 / (9 * df)
    return 1 - norm_cdf(((x / df) ** (1 / 3) - (1 - k)) / math.sqrt(k))


def ks_p(d: float, n: int, m: int) -> float:
    """Asymptotic p of the two-sample Kolmogorov-Smirnov statistic, with the correction for small samples."""
    root = math.sqrt(n * m / (n + m))
    t = (root + 0.12 + 0.11 / root) * d
    if t < 0.2:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * t * t) for k in range(1, 101))))


def pearson_p(r: float, n: int) -> float:
    """Two-sided p of a correlation: Student's t by the regularised incomplete beta function."""
    if n < 3 or abs(r) >= 1:
        return 1.0 if n < 3 else 0.0
    dof = n - 2
    return incomplete_beta(dof / 2, 0.5, 1 - r * r)


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised, by Lentz's continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
    f, c, d = 1.0, 1.0, 0.0
    for i in range(400):
        m = i // 2
        top = 1.0 if i == 0 else m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if i % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + top * d or 1e-30)
        c = 1 + top / c or 1e-30
        f *= c * d
        if abs(1 - c * d) < 1e-12:
            break
    return front * (f - 1)


def solved(n: float, sx: np.ndarray, sxx: np.ndarray, sy: float, sxy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least squares with an intercept from sums: (coefficients, inverse of the normal matrix)."""
    m = np.block([[np.array([[n]]), sx[None]], [sx[:, None], sxx]])
    inverse = np.linalg.pinv(m)
    return inverse @ np.r_[sy, sxy], inverse


def single_loocv(x: np.ndarray, y: np.ndarray) -> float:
    """Leave-one-out R² of one feature; the slope divides the sample covariance by the population variance."""
    n, total = len(x), float(((y - y.mean()) ** 2).sum())
    if n < 3 or total == 0:
        return 0.0
    sx, sy = x.sum() - x, y.sum() - y
    mx, my = sx / (n - 1), sy / (n - 1)
    cov = ((x * y).sum() - x * y - (n - 1) * mx * my) / (n - 2)
    var = np.maximum(((x * x).sum() - x * x) / (n - 1) - mx * mx, 0)
    slope = np.where(var < 1e-18, 0, cov / np.where(var < 1e-18, 1, var))
    return 1 - float(((y - (my + slope * (x - mx))) ** 2).sum()) / total
