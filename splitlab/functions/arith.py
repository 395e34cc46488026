"""Ratio helpers that follow pandas arithmetic while staying legal under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` with x/0 = +-Inf and 0/0 (or any missing side) = NULL.

    NULL plays the part pandas gives to NaN: Spark aggregates skip NULL but propagate NaN.
    """
    return (
        F.when(den != 0, num / den)
        .when(den.isNull(), F.lit(None))
        .when(num > 0, F.lit(INF))
        .when(num < 0, F.lit(-INF))
    )


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def mean_defined(col: Column) -> Column:
    """Average over defined values; mixed infinities are undefined, as in pandas."""
    return nan_to_null(F.avg(col))


def mean_if_all_defined(col: Column) -> Column:
    """Average that one undefined value makes undefined, as in R."""
    return F.when(F.count(col) == F.count("*"), nan_to_null(F.avg(col)))
