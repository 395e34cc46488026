"""Unit-by-day metric tables and their one-row-per-unit form."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.functions.dates import as_date, in_days
from splitlab.plans.session import materialize_counted


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def outer_merge(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join, on ``keys``, of frames that hold different columns and one row per key.

    Written as a union and one grouped sum, so any number of frames costs one shuffle and raw,
    not yet grouped frames may be passed as well. As in a join, NULL keys match nothing: rows
    with a NULL key meet only rows of their own frame.
    """
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    sided = [f.withColumn("__side", F.when(null_key, F.lit(i))) for i, f in enumerate(frames)]
    stacked = _stacked(sided)
    values = [c for c in stacked.columns if c not in (*keys, "__side")]
    return stacked.groupBy(*keys, "__side").agg(*[F.sum(v).alias(v) for v in values]).drop("__side")


def unit_day_metrics(
    frames: Sequence[DataFrame], metrics: Sequence[str], unit: str = "unit_id", day: str = "day"
) -> DataFrame:
    """(unit, day, metrics): missing metrics are 0, rows with no nonzero metric are dropped.

    Rows without a unit id or without a day are dropped too, since they belong to no group or no
    period. What is left has whole keys, so the union needs no column for its side and is dealt
    by unit and day alone; a later grouping by both, as in ``unit_series``, exchanges nothing.
    """
    known = [f.where(F.col(unit).isNotNull() & F.col(day).isNotNull()) for f in frames]
    merged = _stacked(known).groupBy(unit, day).agg(*[F.sum(m).alias(m) for m in metrics])
    nonzero = reduce(lambda a, b: a | b, [F.col(m) != 0 for m in metrics])
    return merged.na.fill(0, subset=list(metrics)).where(nonzero)


@dataclass(frozen=True)
class UnitSeries:
    """One row per unit: (unit_id, days), with an array of (offset, v0, v1, ...) per unit.

    ``offset`` counts days from ``start``, ``v{j}`` is the value of metric j; days without a row
    are left out. ``n_units`` is the number of rows where it is known.
    """

    df: DataFrame
    metrics: tuple[str, ...]
    start: date
    period: int
    n_units: int | None = None


def unit_series(
    unit_days: DataFrame, metrics: Sequence[str], start: date | str, period: int,
    unit: str = "unit_id", day: str = "day",
) -> UnitSeries:
    """Gather the ``period`` days from ``start`` on per unit; several rows of a unit and day are added up.

    Units are hashed and regrouped under every salt, so their days travel with them as one row.
    A unit holds at most ``period`` entries, whatever its share of the raw data.
    """
    start = as_date(start)
    inside = unit_days.where(in_days(F.col(day), start, start + timedelta(days=period - 1)))
    # Plain columns stay plain, so days already grouped by unit and day are not exchanged for this again.
    once = inside.groupBy(F.col(unit).cast("bigint").alias("unit_id"), F.col(day).cast("date").alias("day")).agg(
        *[F.sum(F.col(m).cast("double")).alias(f"v{j}") for j, m in enumerate(metrics)]
    )
    entry = F.struct(F.datediff("day", F.lit(start)).alias("offset"), *[f"v{j}" for j in range(len(metrics))])
    gathered = once.groupBy("unit_id").agg(F.collect_list(entry).alias("days"))
    return UnitSeries(gathered, tuple(metrics), start, period)


def prepared(series: UnitSeries) -> UnitSeries:
    """The same series, materialised and counted: read by many jobs, spread by its size."""
    df, n_units = materialize_counted(series.df)
    return replace(series, df=df, n_units=n_units)
