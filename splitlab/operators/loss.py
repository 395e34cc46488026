"""Loss of a salt: how different test and control look over the days before an experiment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlab.functions.arith import nan_to_null, safe_ratio
from splitlab.operators.groups import group_days
from splitlab.operators.metrics import UnitSeries
from splitlab.plans.config import SplitConfig
from splitlab.plans.session import BROADCAST_ROWS
from splitlab.sources.salts import SaltSet


def compared_groups(config: SplitConfig) -> list[int]:
    return sorted({*config.control, *config.test})


def salt_days(series: UnitSeries, salts: SaltSet, config: SplitConfig) -> DataFrame:
    """Daily sums of the compared groups under every salt."""
    return group_days(series, salts, config.slots, keep=compared_groups(config))


def compare(days: DataFrame, config: SplitConfig, metrics: Sequence[str], per_unit: bool) -> DataFrame:
    """(salt_id, day, control, test, ratio per metric) for every day the control group has rows.

    Several control groups give one row per control and test group; a test group without rows
    on the day has NULL ratios.
    """
    def value(metric: str, group: int) -> Column:
        v = F.col(f"{metric}__{group}")
        return v / F.col(f"n__{group}") if per_unit else v

    pairs = F.array(*[
        F.struct(
            F.lit(c).alias("control"), F.lit(t).alias("test"),
            F.col(f"{metrics[0]}__{c}").isNotNull().alias("has_control"),
            *[safe_ratio(value(m, t), value(m, c)).alias(m) for m in metrics],
        )
        for c in config.control
        for t in config.test
    ])
    return days.select("salt_id", "day", F.inline(pairs)).where("has_control").drop("has_control")


def _absolute(m: str) -> Column:
    return F.coalesce(F.sum(F.abs(F.abs(F.col(m)) - 1)), F.lit(0.0))


def _inverse_variance(m: str) -> Column:
    error = F.col(m) - 1
    return safe_ratio(F.coalesce(F.sum(F.abs(error)), F.lit(0.0)), nan_to_null(F.var_pop(error)))


def _total(parts: Sequence[Column]) -> Column:
    """Sum of the defined parts, NULL when none is defined."""
    known = F.filter(F.array(*parts), lambda v: v.isNotNull())
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda acc, v: acc + v))


def salt_loss(days: DataFrame, salts: SaltSet, config: SplitConfig, metrics: Sequence[str], version: int = 1) -> DataFrame:
    """(salt_id, salt, pae) for every salt.

    Version 1 sums the absolute relative differences per unit over metrics, days and pairs, and
    divides by days and number of groups; version 2 divides by days only. Version 3 divides the
    sum of each metric by the population variance of its relative differences (so a noisier
    split scores *lower*) and then by days. The divisor is the configured period, whatever days
    have data. A salt with nothing to compare scores 0 in versions 1 and 2 and NULL in 3.
    """
    errors = compare(days, config, metrics, per_unit=True)
    if version in (1, 2):
        divisor = config.period * (len(config.exp_groups) if version == 1 else 1)
        parts = [_absolute(m) for m in metrics]
    elif version == 3:
        divisor = config.period
        parts = [_inverse_variance(m) for m in metrics]
    else:
        raise ValueError(f"no loss version {version}")
    by_salt = errors.groupBy("salt_id").agg(*[p.alias(f"p{j}") for j, p in enumerate(parts)])
    names = [F.col(f"p{j}") for j in range(len(parts))]
    total = sum(names[1:], names[0]) if version < 3 else _total(names)
    scored = by_salt.select("salt_id", (total / divisor).alias("pae"))
    if salts.n <= BROADCAST_ROWS:  # one row per salt at most
        scored = F.broadcast(scored)
    joined = salts.df.select("salt_id", "salt").join(scored, "salt_id", "left")
    return joined.na.fill(0.0, subset=["pae"]) if version < 3 else joined
