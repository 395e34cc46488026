"""Stationarity of the test-to-control ratio before an experiment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.functions.series import kpss_pvalue, testable, with_dickey_fuller, with_kpss
from splitlab.functions.unitroot import with_adf
from splitlab.operators.loss import compare
from splitlab.plans.config import SplitConfig

LEVEL = 0.05


def ratio_series(days: DataFrame, config: SplitConfig, metrics: Sequence[str]) -> DataFrame:
    """(salt_id, test, metric, series): daily ratios of sums, ordered by day and control group.

    ``days`` holds the daily group sums of the compared groups. A series is as long as the
    period times the number of control groups, whatever the size of the data.
    """
    ratios = compare(days, config, metrics, per_unit=False)
    points = F.sort_array(F.collect_list(F.struct("day", "control", *metrics)))
    grouped = ratios.groupBy("salt_id", "test").agg(points.alias("points"))
    per_metric = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col("points").getField(m).alias("series")) for m in metrics
    ])
    return grouped.select("salt_id", "test", F.inline(per_metric))


def kpss_stats(series: DataFrame) -> DataFrame:
    tested = with_kpss(series, "series").withColumn("kpss_pvalue", kpss_pvalue(F.col("kpss")))
    return tested


def dickey_fuller_stats(series: DataFrame) -> DataFrame:
    return with_dickey_fuller(series, "series")


def adf_stats(series: DataFrame) -> DataFrame:
    """Add ``adf``, ``adf_pvalue`` and ``adf_lags``: constant, lags by AIC."""
    return with_adf(series, "series")


def stationarity(days: DataFrame, config: SplitConfig, metrics: Sequence[str]) -> DataFrame:
    """(salt_id, stat_result, reason) for every salt with control rows.

    Stationary when, for every metric and test group, the unit-root test rejects and the level
    test does not. Series with missing or infinite ratios or under eight points do not pass.
    """
    tested = adf_stats(kpss_stats(ratio_series(days, config, metrics)))
    undefined = ~testable(F.col("series")) | F.col("adf_pvalue").isNull() | F.col("kpss").isNull()
    passed = ~undefined & (F.col("adf_pvalue") < LEVEL) & (F.col("kpss_pvalue") > LEVEL)
    # No salt_id shuffle: the series keep the partitioning of the compared days.
    return tested.groupBy("salt_id").agg(
        F.bool_and(F.coalesce(passed, F.lit(False))).alias("stat_result"),
        F.when(F.bool_or(undefined), F.lit("undefined ratio"))
        .when(F.bool_or(F.col("adf_pvalue") >= LEVEL), F.lit("unit root"))
        .when(F.bool_or(F.col("kpss_pvalue") <= LEVEL), F.lit("level shift"))
        .alias("reason"),
    )
