"""Statistics of short series held in one array column each, as built-in expressions.

A series is one ordered ARRAY<DOUBLE> per row (weeks of days, not data-sized), so no window or
self join is needed. Intermediate arrays are columns of their own: inside a lambda Spark
evaluates an expression anew for every element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlab.functions.arith import safe_ratio

# Critical values of the level-stationarity test (Kwiatkowski et al. 1992, table 1).
KPSS_CRITICAL = [(0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01)]

MIN_POINTS = 8


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)


def dot(x: Column, y: Column) -> Column:
    return total(F.zip_with(x, y, lambda a, b: a * b))


def centred(x: Column) -> Column:
    n = F.size(x)
    return F.zip_with(x, F.array_repeat(total(x) / n, n), lambda v, mean: v - mean)


def testable(x: Column, points: int = MIN_POINTS) -> Column:
    """Enough points, all of them defined and finite."""
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (F.size(x) >= points) & ~bad


def legacy_lags(n: Column) -> Column:
    return F.ceil(12 * F.pow(n / 100, F.lit(0.25))).cast("int")


def short_lags(n: Column) -> Column:
    return F.floor(4 * F.pow(n / 100, F.lit(0.25))).cast("int")


def with_kpss(df: DataFrame, series: str, out: str = "kpss", lags=legacy_lags) -> DataFrame:
    """Add the KPSS level statistic of ``series``; NULL where it is undefined."""
    e, n = F.col("__e"), F.size("__e")
    prepared = df.withColumn("__e", centred(F.when(testable(F.col(series), 2), F.col(series))))
    prepared = prepared.withColumn("__l", lags(n))
    walk = F.aggregate(
        e, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")),
        lambda acc, v: F.struct((acc["s"] + v).alias("s"), (acc["q"] + (acc["s"] + v) * (acc["s"] + v)).alias("q")),
    )["q"]

    def weighted_autocovariance(k: Column) -> Column:
        kept = F.greatest(n - k, F.lit(0))
        return (1 - k / (F.col("__l") + 1)) * dot(F.slice(e, k + 1, kept), F.slice(e, F.lit(1), kept))

    lagged = F.when(F.col("__l") > 0, F.sequence(F.lit(1), F.col("__l"))).otherwise(F.array().cast("array<int>"))
    variance = (dot(e, e) + 2 * total(F.transform(lagged, weighted_autocovariance))) / n
    return prepared.withColumn(out, safe_ratio(walk / n / n, variance)).drop("__e", "__l")


def kpss_pvalue(stat: Column) -> Column:
    """p-value interpolated between the critical values and clipped to their range."""
    (first, top), (last, bottom) = KPSS_CRITICAL[0], KPSS_CRITICAL[-1]
    p = F.when(stat <= first, F.lit(top)).when(stat >= last, F.lit(bottom))
    for (c0, p0), (c1, p1) in zip(KPSS_CRITICAL, KPSS_CRITICAL[1:]):
        p = p.when(stat < c1, p0 + (stat - c0) * ((p1 - p0) / (c1 - c0)))
    return p


def with_dickey_fuller(df: DataFrame, series: str, out: str = "df_stat") -> DataFrame:
    """Add the Dickey-Fuller t statistic without lagged differences (constant, no trend)."""
    # Two parameters are fitted to the changes.
    x = F.when(testable(F.col(series), 4), F.col(series))
    level = F.slice(x, F.lit(1), F.size(x) - 1)
    change = F.zip_with(F.slice(x, F.lit(2), F.size(x) - 1), level, lambda b, a: b - a)
    prepared = df.withColumns({"__x": centred(level), "__d": centred(change)})
    dx, dd = F.col("__x"), F.col("__d")
    prepared = prepared.withColumns({"__xx": dot(dx, dx), "__xy": dot(dx, dd), "__yy": dot(dd, dd)})
    slope = safe_ratio(F.col("__xy"), F.col("__xx"))
    residual = (F.col("__yy") - slope * F.col("__xy")) / (F.size("__d") - 2)
    stat = safe_ratio(slope, F.sqrt(safe_ratio(F.greatest(residual, F.lit(0.0)), F.col("__xx"))))
    return prepared.withColumn(out, stat).drop("__x", "__d", "__xx", "__xy", "__yy")
