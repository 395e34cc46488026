"""Normal and Student-t probabilities as built-in expressions.

Series and continued fractions are folds over a fixed number of steps that stop changing once
they have converged, so a probability is one expression of a row. They are meant for result
tables, a row per comparison or per series.
"""

from __future__ import annotations

import math
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

_names = count()

# Steps of the folds. The series of the normal distribution needs about 150 at |z| = 8, the fraction
# of the beta function about the square root of its larger parameter.
NORMAL_STEPS, BETA_STEPS, HALVINGS = 200, 500, 60
NORMAL_REACH = 8.0
# Degrees of freedom from which the t distribution is the normal one to more digits than are reported.
NORMAL_FROM = 1e8
# Bernoulli numbers B2, B4, ...
_BERNOULLI = (1 / 6, -1 / 30, 1 / 42, -1 / 30, 5 / 66)
# The series for the ratio of gamma functions is used from here on; smaller arguments are raised to it.
_SHIFT = 16


def bound(value: str, body) -> str:
    """SQL of ``body(name)``, with ``value`` computed once: inside a lambda Spark would evaluate it at every use."""
    name = f"b{next(_names)}"
    return f"transform(array({value}), {name} -> {body(name)})[0]"


def normal_cdf_sql(z: str) -> str:
    """Standard normal probability below ``z``, to about 1e-15."""
    def inside(x: str) -> str:
        start = f"named_struct('term', {x}, 'sum', {x})"
        # z + z^3/3 + z^5/(3*5) + ...
        term = f"a.term * {x} * {x} / (2 * i + 1)"
        total = f"aggregate(sequence(1, {NORMAL_STEPS}), {start}, (a, i) -> named_struct('term', {term}, 'sum', a.sum + {term}), a -> a.sum)"
        middle = f"0.5D + {total} * exp(-{x} * {x} / 2) / {math.sqrt(2 * math.pi)!r}D"
        return f"CASE WHEN {x} < -{NORMAL_REACH} THEN 0D WHEN {x} > {NORMAL_REACH} THEN 1D ELSE {middle} END"

    return bound(f"CAST({z} AS DOUBLE)", inside)


def log_beta_sql(df: str) -> str:
    """log B(df/2, 1/2), to about 1e-15: the two gamma functions enter by their ratio, so nothing large cancels."""
    def ratio(z: str) -> str:  # log of gamma(z + 1/2) over gamma(z)
        series = "0D"
        for k in range(len(_BERNOULLI), 0, -1):
            n = 2 * k - 1
            series = f"({(2.0**-n - 2) * _BERNOULLI[k - 1] / (n * (n + 1))!r}D + {series} / ({z} * {z}))"
        return f"(0.5D * ln({z}) + {series} / {z})"

    raised = " + ".join(f"ln(({df} + {2 * k}) / ({df} + {2 * k + 1}))" for k in range(_SHIFT))
    return f"({0.5 * math.log(math.pi)!r}D - {bound(f'{df} / 2 + {_SHIFT}D', ratio)} - ({raised}))"


def _beta_fraction_sql(x: str, a: str, b: str) -> str:
    """Continued fraction of the incomplete beta function by Lentz's method."""
    def away(v: str) -> str:
        return bound(v, lambda w: f"if(abs({w}) < 1e-300D, 1e-300D, {w})")

    def step(s: str, coefficient: str) -> str:
        d = f"1 / {away(f'1 + {coefficient} * {s}.d')}"
        c = away(f"1 + {coefficient} / {s}.c")
        return bound(f"named_struct('c', {c}, 'd', {d})", lambda t: f"named_struct('c', {t}.c, 'd', {t}.d, 'f', {s}.f * {t}.c * {t}.d, 'delta', abs({t}.c * {t}.d - 1))")

    even = f"(m * ({b} - m) * {x} / (({a} + 2 * m - 1) * ({a} + 2 * m)))"
    odd = f"(-({a} + m) * ({a} + {b} + m) * {x} / (({a} + 2 * m) * ({a} + 2 * m + 1)))"
    both = bound(step("s", even), lambda t: step(t, odd))
    first = f"1 / {away(f'1 - ({a} + {b}) * {x} / ({a} + 1)')}"
    start = bound(first, lambda d: f"named_struct('c', 1D, 'd', {d}, 'f', {d}, 'delta', 1D)")
    return f"aggregate(sequence(1, {BETA_STEPS}), {start}, (s, m) -> if(s.delta < 1e-15D, s, {both}), s -> s.f)"


def _two_sided_sql(t: str, df: str, log_beta: str) -> str:
    """P(|T| > |t|); ``log_beta`` is log B(df/2, 1/2)."""
    def of(q: str) -> str:  # q = t^2 / df; x = 1 / (1 + q)
        a, x, y = f"({df} / 2)", f"(1 / (1 + {q}))", f"({q} / (1 + {q}))"
        front = f"exp(-{a} * log1p({q}) + 0.5D * ln({y}) - {log_beta})"
        low = f"{front} * {_beta_fraction_sql(x, a, '0.5D')} / {a}"
        high = f"1 - {front} * {_beta_fraction_sql(y, '0.5D', a)} / 0.5D"
        return f"CASE WHEN {q} = 0 THEN 1D WHEN {x} = 0 THEN 0D WHEN {x} < ({a} + 1) / ({a} + 2.5D) THEN {low} ELSE {high} END"

    normal = bound(f"abs({t})", lambda z: f"2 * {normal_cdf_sql(f'-{z}')}")
    exact = bound(f"{t} * {t} / {df}", of)
    return f"CASE WHEN isnan({t}) THEN CAST(NULL AS DOUBLE) WHEN abs({t}) = double('infinity') THEN 0D WHEN {df} >= {NORMAL_FROM!r}D THEN {normal} ELSE {exact} END"


def _quoted(column: str) -> str:
    return "CAST(`" + column.replace("`", "``") + "` AS DOUBLE)"


def normal_cdf(z: str) -> Column:
    """Standard normal probability below the column ``z``; NULL and NaN give NULL."""
    return F.expr(f"CASE WHEN NOT isnan({_quoted(z)}) THEN {normal_cdf_sql(_quoted(z))} END")


def t_pvalue(t: str, df: str) -> Column:
    """Two-sided p-value of the column ``t`` with ``df`` degrees of freedom; NULL where one is missing or df is not positive."""
    p = bound(f"named_struct('t', {_quoted(t)}, 'df', {_quoted(df)}, 'lb', {log_beta_sql(_quoted(df))})", lambda r: _two_sided_sql(f"{r}.t", f"{r}.df", f"{r}.lb"))
    return F.expr(f"CASE WHEN {_quoted(t)} IS NOT NULL AND {_quoted(df)} > 0 AND NOT isnan({_quoted(df)}) THEN {p} END")


def t_critical(df: str, level: float = 0.95) -> Column:
    """Half width, in standard errors, of the two-sided interval: the t with probability 1 - level beyond it.

    Found by halving the range of t / (1 + t), from 0 to 1.
    """
    def halved(r: str) -> str:
        def half(middle: str) -> str:
            p = bound(f"{middle} / (1 - {middle})", lambda t: _two_sided_sql(t, f"{r}.df", f"{r}.lb"))
            return f"if({p} > {1 - level!r}D, named_struct('low', {middle}, 'high', s.high), named_struct('low', s.low, 'high', {middle}))"

        body = bound("(s.low + s.high) / 2", half)
        return f"aggregate(sequence(1, {HALVINGS}), named_struct('low', 0D, 'high', 1D), (s, k) -> if(s.high - s.low < 1e-17D, s, {body}), s -> s.low / (1 - s.low))"

    t = bound(f"named_struct('df', {_quoted(df)}, 'lb', {log_beta_sql(_quoted(df))})", halved)
    return F.expr(f"CASE WHEN {_quoted(df)} > 0 AND NOT isnan({_quoted(df)}) THEN {t} END")
