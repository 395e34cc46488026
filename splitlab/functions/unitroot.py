"""Augmented Dickey-Fuller tests of short series, as built-in expressions.

A series is one array per row. Its regressions of growing order are one successive
orthogonalisation: the columns of the longest regression are listed, each is taken in turn, and
the rest of the list, the explained changes last, is made orthogonal to it by a fold. What is left
of the changes after each step is the residual sum of one more order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlab.functions.probability import bound, normal_cdf
from splitlab.functions.series import testable

# Fixed values. p-value polynomials for a constant and no trend (MacKinnon 1994).
PVALUE_MAX, PVALUE_MIN, PVALUE_SWITCH = 2.74, -18.83, -1.61
PVALUE_LEFT = (2.1659, 1.4412, 0.038269)
PVALUE_RIGHT = (1.7339, 0.93202, -0.12745, -0.010368)

# Fixed values. Critical values with constant and trend by number of observations
# (Fuller 1976, table 8.5.2), one row per probability.
TREND_SIZES = (25, 50, 100, 250, 500, 100_000)
TREND_CRITICAL = {
    0.01: (-4.38, -4.15, -4.04, -3.99, -3.98, -3.96),
    0.025: (-3.95, -3.80, -3.73, -3.69, -3.68, -3.66),
    0.05: (-3.60, -3.50, -3.45, -3.43, -3.42, -3.41),
    0.10: (-3.24, -3.18, -3.15, -3.13, -3.13, -3.12),
    0.90: (-1.14, -1.19, -1.22, -1.23, -1.24, -1.25),
    0.95: (-0.80, -0.87, -0.90, -0.92, -0.93, -0.94),
    0.975: (-0.50, -0.58, -0.62, -0.64, -0.65, -0.66),
    0.99: (-0.15, -0.24, -0.28, -0.31, -0.32, -0.33),
}
# Share of the largest level below which the level counts as explained by the other columns.
FLAT = 1e-10


def _dot(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (p, q) -> p * q), 0D, (s, e) -> s + e)"


def _centred(v: str) -> str:
    mean = f"aggregate({v}, 0D, (s, e) -> s + e) / size({v})"
    return bound(f"named_struct('v', {v}, 'm', {mean})", lambda c: f"transform({c}.v, e -> e - {c}.m)")


def _orthogonal(columns: str) -> str:
    """The columns after the first one, each less its part along the first."""
    def less(q: str) -> str:
        def one(c: str) -> str:
            return f"zip_with(u, {q}.v, (a, b) -> a - {c} * b)"

        share = bound(f"coalesce(try_divide({_dot('u', f'{q}.v')}, {q}.s), 0D)", one)
        return f"transform(slice({columns}, 2, size({columns}) - 1), u -> {share})"

    first = bound(f"{columns}[0]", lambda v: f"named_struct('v', {v}, 's', {_dot(v, v)})")
    return bound(first, less)


def _last(columns: str) -> str:
    return f"element_at({columns}, -1)"


def _steps(columns: str, n: str) -> str:
    """Columns after ``n`` orthogonalisations, and the squared length of the last column after each."""
    def grown(w: str) -> str:
        return f"named_struct('v', {w}, 'left', concat(t.left, array({bound(_last(w), lambda y: _dot(y, y))})))"

    start = f"named_struct('v', {columns}, 'left', cast(array() as array<double>))"
    some = f"if({n} > 0, sequence(1, greatest({n}, 1)), cast(array() as array<int>))"
    return f"aggregate({some}, {start}, (t, i) -> {bound(_orthogonal('t.v'), grown)})"


def _lagged(lags: str, m: str) -> str:
    """The changes 1, 2, ... ``lags`` days before the last ``m`` changes."""
    some = f"if({lags} > 0, sequence(1, greatest({lags}, 1)), cast(array() as array<int>))"
    return f"transform({some}, k -> {_centred(f'slice(__d, {lags} - k + 1, {m})')})"


def _regressed(df: DataFrame, lags: str, trend: bool) -> DataFrame:
    """Adds __t, the t statistic of the lagged level with ``lags`` lagged changes; NULL where it is undefined."""
    level, change = f"slice(__x, {lags} + 1, __m)", f"slice(__d, {lags} + 1, __m)"
    time = f"array({_centred('transform(sequence(1, __m), i -> cast(i as double))')}), " if trend else ""
    steps = f"{lags} + 1" if trend else lags
    design = f"concat({time}{_lagged(lags, '__m')}, array({_centred(level)}, {_centred(change)}))"
    left = df.withColumn("__m", F.expr(f"size(__d) - {lags}")).withColumn("__c", F.expr(design))
    left = left.withColumn("__c", F.expr(f"{_steps('__c', steps)}.v"))
    left = left.withColumns({
        "__xx": F.expr(_dot("__c[0]", "__c[0]")), "__xy": F.expr(_dot("__c[0]", "__c[1]")),
        "__largest": F.expr(f"array_max(transform({level}, e -> abs(e)))"),
    }).withColumn("__c", F.expr(_orthogonal("__c")))
    left = left.withColumn("__ss", F.expr(_dot("__c[0]", "__c[0]")))
    freedom = f"(__m - {lags} - {3 if trend else 2})"
    flat = f"sqrt(__xx) <= {FLAT}D * greatest(__largest, 1e-300D)"
    stat = f"CASE WHEN NOT ({flat}) AND __ss > 0 AND {freedom} > 0 THEN __xy / sqrt(__ss / {freedom} * __xx) END"
    return left.withColumn("__t", F.expr(stat)).drop("__m", "__c", "__xx", "__xy", "__largest", "__ss")


def _constant_pvalue(df: DataFrame) -> DataFrame:
    """Adds __p to __t by the polynomials for a constant."""
    def value(parts: tuple[float, ...]) -> Column:
        total = F.lit(parts[-1])
        for c in reversed(parts[:-1]):
            total = total * F.col("__t") + c
        return total

    z = F.when(F.col("__t") <= PVALUE_SWITCH, value(PVALUE_LEFT)).otherwise(value(PVALUE_RIGHT))
    p = F.when(F.col("__t") > PVALUE_MAX, 1.0).when(F.col("__t") < PVALUE_MIN, 0.0).otherwise(normal_cdf("__z"))
    return df.withColumn("__z", z).withColumn("__p", p).drop("__z")


def _between(x: Column, points: list[tuple[Column | float, Column | float]]) -> Column:
    """Piecewise linear through ``points``, constant beyond them."""
    value = F.when(x <= points[0][0], points[0][1])
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        value = value.when(x <= x1, y0 + (x - x0) * ((y1 - y0) / (x1 - x0)))
    return value.when(x > points[-1][0], points[-1][1])


def _trend_pvalue(df: DataFrame) -> DataFrame:
    """Adds __p to __t by the tabulated critical values, between sizes and probabilities."""
    n = F.size("__d").cast("double")
    names = {p: f"__c{i}" for i, p in enumerate(TREND_CRITICAL)}
    rows = df.withColumns({
        name: _between(n, [(float(s), F.lit(c)) for s, c in zip(TREND_SIZES, TREND_CRITICAL[p])]) for p, name in names.items()
    })
    points = [(F.col(name), F.lit(p)) for p, name in names.items()]
    return rows.withColumn("__p", _between(F.col("__t"), points)).drop(*names.values())


def _prepared(df: DataFrame, series: str) -> DataFrame:
    x = F.when(testable(F.col(series)), F.col(series))
    changes = "zip_with(slice(__x, 2, size(__x) - 1), slice(__x, 1, size(__x) - 1), (b, a) -> b - a)"
    return df.withColumn("__x", x).withColumn("__d", F.expr(changes))


def with_adf(df: DataFrame, series: str, stat: str = "adf", pvalue: str = "adf_pvalue", lags: str = "adf_lags") -> DataFrame:
    """Adds statistic, p-value and number of lags of the test with a constant; NULL for series under eight points or with undefined ones.

    The number of lagged changes is the one of lowest AIC, the smaller one of equals, all
    candidates on the sample of the longest; the statistic is then fitted on its own sample.
    """
    rows = _prepared(df, series)
    n = "size(__x)"
    most = f"CASE WHEN __x IS NOT NULL THEN greatest(0, least(cast(ceil(12 * power({n} / 100D, 0.25D)) as int), {n} div 2 - 2)) END"
    rows = rows.withColumn("__most", F.expr(most).cast("int")).withColumn("__m", F.expr("size(__d) - __most"))
    level, change = "slice(__x, __most + 1, __m)", "slice(__d, __most + 1, __m)"
    design = f"concat(array({_centred(level)}), {_lagged('__most', '__m')}, array({_centred(change)}))"
    rows = rows.withColumn("__c", F.expr(f"CASE WHEN __x IS NOT NULL THEN {design} END"))
    rows = rows.withColumn("__left", F.expr(f"CASE WHEN __x IS NOT NULL THEN {_steps('__c', '__most + 1')}.left END"))
    aic = "transform(__left, (e, k) -> named_struct('aic', __m * ln(greatest(e, 1e-300D) / __m) + 2D * (k + 2), 'k', k))"
    rows = rows.withColumn("__lags", F.expr(f"array_min({aic}).k")).drop("__c", "__left", "__m", "__most")
    rows = _constant_pvalue(_regressed(rows.withColumn("__x", F.expr("CASE WHEN __lags IS NOT NULL THEN __x END")), "__lags", trend=False))
    return rows.select(*df.columns, F.col("__t").alias(stat), F.col("__p").alias(pvalue), F.col("__lags").alias(lags))


def with_adf_trend(df: DataFrame, series: str, stat: str = "adf", pvalue: str = "adf_pvalue") -> DataFrame:
    """Adds statistic and tabulated p-value of the test with constant and trend; the lags are the whole cube root of the changes."""
    rows = _prepared(df, series)
    # A cube root of a cube may end just below it.
    rows = rows.withColumn("__lags", F.expr("cast(floor(power(size(__d), 1 / 3D) + 1e-9D) as int)"))
    rows = _trend_pvalue(_regressed(rows, "__lags", trend=True))
    return rows.select(*df.columns, F.col("__t").alias(stat), F.col("__p").alias(pvalue))
