"""Unit-root tests and Student-t probabilities in plain numpy, to compare the expressions with."""

from __future__ import annotations

import math

import numpy as np

from splitlab.functions.unitroot import PVALUE_LEFT, PVALUE_MAX, PVALUE_MIN, PVALUE_RIGHT, PVALUE_SWITCH, TREND_CRITICAL, TREND_SIZES


def _design(x: np.ndarray, lags: int, trend: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(changes, deterministic and lagged-change columns, levels) for rows of equal-length series."""
    diff = np.diff(x, axis=1)
    n = diff.shape[1] - lags
    lagged = [diff[:, lags - k : lags - k + n] for k in range(1, lags + 1)]
    fixed = [np.ones((x.shape[0], n))]
    if trend:
        fixed.append(np.broadcast_to(np.arange(1.0, n + 1), (x.shape[0], n)))
    return diff[:, lags:], np.stack(fixed + lagged, axis=2), x[:, lags:-1]


def _level_t(x: np.ndarray, lags: int, trend: bool) -> np.ndarray:
    """t statistic of the lagged level: it is the last column of a QR factorisation."""
    change, other, level = _design(x, lags, trend)
    columns = np.concatenate([other, level[:, :, None]], axis=2)
    n, k = columns.shape[1:]
    q, r = np.linalg.qr(columns)
    along = np.einsum("snk,sn->sk", q, change)
    left = np.maximum((change**2).sum(1) - (along**2).sum(1), 0.0)
    last = r[:, -1, -1]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = along[:, -1] * np.sign(last) / np.sqrt(left / (n - k))
    flat = np.abs(last) <= 1e-10 * np.maximum(np.abs(level).max(1), 1e-300)
    return np.where(flat | ~np.isfinite(t), np.nan, t)


def _aic_lags(x: np.ndarray, most: int) -> np.ndarray:
    """Number of lagged changes with the lowest AIC, all candidates on the same sample.

    Candidates are nested, so one factorisation gives the residual sum of every one of them.
    """
    change, other, level = _design(x, most, trend=False)
    columns = np.concatenate([other[:, :, :1], level[:, :, None], other[:, :, 1:]], axis=2)
    n = columns.shape[1]
    q, _ = np.linalg.qr(columns)
    explained = np.cumsum(np.einsum("snk,sn->sk", q, change) ** 2, axis=1)[:, 1:]
    left = np.maximum((change**2).sum(1)[:, None] - explained, 1e-300)
    aic = n * np.log(left / n) + 2 * np.arange(2, 2 + explained.shape[1])
    return aic.argmin(axis=1)


def _normal_cdf(z: np.ndarray) -> np.ndarray:
    return np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])


def _constant_pvalue(t: np.ndarray) -> np.ndarray:
    z = np.where(t <= PVALUE_SWITCH, np.polyval(PVALUE_LEFT[::-1], t), np.polyval(PVALUE_RIGHT[::-1], t))
    p = np.where(t > PVALUE_MAX, 1.0, np.where(t < PVALUE_MIN, 0.0, _normal_cdf(z)))
    return np.where(np.isnan(t), np.nan, p)


def _trend_pvalue(t: np.ndarray, n: int) -> np.ndarray:
    critical = [np.interp(n, TREND_SIZES, row) for row in TREND_CRITICAL.values()]
    return np.where(np.isnan(t), np.nan, np.interp(t, critical, list(TREND_CRITICAL)))


def adf_aic(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stat, p, lags): constant, number of lags chosen by AIC, then refitted on its own sample."""
    n = x.shape[1]
    most = max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))
    lags = _aic_lags(x, most)
    stat = np.full(len(x), np.nan)
    for k in np.unique(lags):
        stat[lags == k] = _level_t(x[lags == k], int(k), trend=False)
    return stat, _constant_pvalue(stat), lags


def adf_trend(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stat, p, lags): constant and trend, fixed number of lags, tabulated p-value."""
    n = x.shape[1]
    lags = int((n - 1) ** (1 / 3) + 1e-9)
    stat = _level_t(x, lags, trend=True)
    return stat, _trend_pvalue(stat, n - 1), np.full(len(x), lags)


_TINY = 1e-300


def _beta_fraction(x: float, a: float, b: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    c, d = 1.0, 1.0 / (max(abs(1 - (a + b) * x / (a + 1)), _TINY))
    value = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + step * d
            d = 1 / (d if abs(d) > _TINY else _TINY)
            c = 1 + step / c
            c = c if abs(c) > _TINY else _TINY
            value *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return value


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(x, a, b) / a
    return 1 - front * _beta_fraction(1 - x, b, a) / b


def two_sided_p(t: float, df: float) -> float:
    return beta_cdf(df / (df + t * t), df / 2, 0.5)


def t_quantile(p: float, df: float) -> float:
    """The t with two-sided probability ``p`` beyond it, by bisection."""
    low, high = 0.0, 1.0
    while two_sided_p(high, df) > p:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if two_sided_p(middle, df) > p else (low, middle)
    return (low + high) / 2
