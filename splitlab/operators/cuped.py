"""Variance reduction with the pre-experiment value of a metric (CUPED, Deng et al. 2013)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlab.functions.arith import safe_ratio
from splitlab.functions.dates import minus_days
from splitlab.plans.session import broadcast_if_small, materialize


def shifted_window(start: date | str, end: date | str, weeks: int) -> tuple[date, date]:
    return minus_days(start, 7 * weeks), minus_days(end, 7 * weeks)


def with_adjusted(joined: DataFrame, metrics: Sequence[str], by: Sequence[str] = (), centre: bool = False) -> DataFrame:
    """Add ``cuped_{m} = m - theta * prev_{m}``; theta over all rows, or one for each value of ``by``.

    The sums come from one aggregate for all metrics. Without ``by`` they enter the rows as a
    scalar; with it they have a row per group, NULL a group of its own, and are joined to the rows,
    by broadcast where they were counted to be few.
    """
    def theta(m: str) -> Column:
        return F.coalesce(safe_ratio(F.covar_samp(f"prev_{m}", m), F.var_samp(f"prev_{m}")), F.lit(0.0))

    parts = [c for m in metrics for c in (theta(m).alias(f"theta_{m}"), F.avg(f"prev_{m}").alias(f"mean_{m}"))]
    if by:
        keys = [F.col(c).alias(f"__by_{c}") for c in by]
        groups = broadcast_if_small(materialize(joined.groupBy(*keys).agg(F.struct(*parts).alias("__fitted"))))
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
        rows, fitted = joined.join(groups, same), F.col("__fitted")
    else:
        rows, fitted = joined, joined.select(F.struct(*parts).alias("fitted")).scalar()

    def adjusted(m: str) -> Column:
        shift = fitted.getField(f"mean_{m}") if centre else F.lit(0.0)
        return F.col(m) - fitted.getField(f"theta_{m}") * (F.col(f"prev_{m}") - shift)

    return rows.select(*joined.columns, *[adjusted(m).alias(f"cuped_{m}") for m in metrics])


def cuped_adjust(
    current: DataFrame, previous: DataFrame, metrics: Sequence[str],
    keys: Sequence[str] = ("exp_name", "unit_id"), centre: bool = False, by: Sequence[str] = (),
) -> DataFrame:
    """Left-join the previous values and add ``cuped_{m} = m - theta * prev_{m}``.

    Missing values count as 0. theta is cov(previous, current) / var(previous) over all units, or
    over the units of each value of ``by``. ``centre`` uses the previous value minus its mean,
    which leaves the mean of the metric alone.
    """
    before = previous.select(*keys, *[F.col(m).alias(f"prev_{m}") for m in metrics])
    filled = [c for m in metrics for c in (m, f"prev_{m}")]
    joined = current.select(*keys, *metrics).join(before, list(keys), "left").na.fill(0, subset=filled)
    return with_adjusted(joined, metrics, by, centre)


def cuped_by_unit(
    unit_days: DataFrame, exposures: DataFrame, metrics: Sequence[str], weeks: int,
    exp: str = "exp_name", unit: str = "unit_id", day: str = "day", centre: bool = False,
) -> DataFrame:
    """(exp, unit, m, prev_m, cuped_m): totals of each unit in each experiment, adjusted by its total ``weeks`` weeks before.

    ``exposures`` has (exp, unit, start_date, end_date), both days included, so experiments may
    have windows of their own and share units. A unit listed more than once in an experiment has
    one window, from its first start to its last end. Both windows are sums under a condition
    over one join and one grouping. Units without rows count as 0; rows with a NULL unit belong to
    nobody. Each experiment has its own theta.
    """
    windows = exposures.where(F.col(unit).isNotNull()).groupBy(exp, unit).agg(
        F.min("start_date").alias("__start"), F.max("end_date").alias("__end")
    )
    def within(shift: int) -> Column:
        return F.col(day).between(F.date_sub("__start", shift), F.date_sub("__end", shift))

    sums = [
        F.coalesce(F.sum(F.when(within(shift), F.col(m))), F.lit(0)).alias(name)
        for shift, prefix in ((0, ""), (7 * weeks, "prev_")) for m, name in ((m, prefix + m) for m in metrics)
    ]
    totals = windows.join(unit_days.select(unit, day, *metrics), unit, "left").groupBy(exp, unit).agg(*sums)
    return with_adjusted(totals, metrics, [exp], centre)


def cuped_metrics(
    compute: Callable[[date, date], DataFrame], start: date | str, end: date | str, weeks: int,
    metrics: Sequence[str], keys: Sequence[str], centre: bool = False,
) -> DataFrame:
    """Adjust a metric by its own value ``weeks`` weeks earlier."""
    return cuped_adjust(compute(start, end), compute(*shifted_window(start, end, weeks)), metrics, keys, centre)
