"""Plain pandas versions of the experiment operators, written from their definitions."""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd

from splitlab.functions.hashing import group_of_slot


def slot(unit: int, salt: str, n: int) -> int:
    return int(hashlib.md5(f"{unit}{salt}".encode()).hexdigest()[28:32], 16) % n


def daily(frame: pd.DataFrame, salt: str, slots: list[int], metrics: list[str]) -> pd.DataFrame:
    rows = frame.assign(grp=[slots[slot(u, salt, len(slots))] for u in frame["unit_id"]])
    sums = rows.groupby(["day", "grp"], as_index=False)[metrics].sum()
    units = rows.groupby("grp")["unit_id"].nunique().rename("n").reset_index()
    return sums.merge(units, on="grp")


def pairs(frame, salt, config, metrics, per_unit):
    d = daily(frame, salt, config.slots, metrics)
    if per_unit:
        d[metrics] = d[metrics].div(d["n"], axis=0)
    control = d[d.grp.isin(config.control)].sort_values(["day", "grp"])
    test = d[d.grp.isin(config.test)]
    merged = control.merge(test, on="day", how="left", suffixes=("_c", "_t"))
    with np.errstate(all="ignore"):
        for m in metrics:
            merged[m] = merged[f"{m}_t"] / merged[f"{m}_c"]
    return merged


def loss(frame, salt, config, metrics, version):
    merged = pairs(frame, salt, config, metrics, per_unit=True)
    if version == 3:
        error = merged[metrics] - 1
        return float((error.abs().sum() / error.var(ddof=0)).sum() / config.period)
    total = sum(((merged[m].abs() - 1).abs()).sum() for m in metrics) / config.period
    return float(total / len(config.exp_groups) if version == 1 else total)


def bootstrap(frame, salt, period, weights, schemes, metrics):
    out = []
    for scheme in schemes:
        d = daily(frame, salt, group_of_slot(weights, scheme), metrics)
        top = len(scheme)
        present = sorted(d[d.grp < top - 1].day.unique())
        for i, j in combinations(range(top), 2):
            left, right = (d[d.grp == g].set_index("day")[metrics] for g in (i, j))
            with np.errstate(all="ignore"):
                ratio = left / right.reindex(left.index) - 1
            for week in range(1, period // 7 + 1):
                kept = ratio[ratio.index.isin(present[: 7 * week])]
                if len(kept):
                    out.append((f"{i}_{j}", 7 * week, top, *kept.mean()))
    return out


def kpss(x: np.ndarray) -> float:
    n = len(x)
    e = x - x.mean()
    lags = int(np.ceil(12 * (n / 100) ** 0.25))
    variance = e @ e + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))
    return float((np.cumsum(e) ** 2).sum() / n**2 / (variance / n))


def regress(y: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, float]:
    """Coefficients, t values and residual sum of squares by least squares."""
    x = np.column_stack(columns)
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    left = y - x @ beta
    sigma = left @ left / (len(y) - x.shape[1])
    return beta, beta / np.sqrt(sigma * np.diag(np.linalg.inv(x.T @ x))), float(left @ left)


def adf(x: np.ndarray) -> tuple[float, int]:
    """t statistic and lag by AIC, one regression per lag."""
    n, dx = len(x), np.diff(x)
    most = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)

    def fit(lags: int, skip: int):
        y = dx[skip:]
        cols = [np.ones(len(y)), x[skip:-1]] + [dx[skip - k : len(dx) - k] for k in range(1, lags + 1)]
        return len(y), regress(y, cols)

    scores = []
    for lags in range(most + 1):
        m, (_, _, ssr) = fit(lags, most)
        scores.append(m * np.log(ssr / m) + 2 * (lags + 2))
    best = int(np.argmin(scores))
    return float(fit(best, best)[1][1][1]), best
