"""Plans and skew: what must hold when the data grows."""

import re

import pytest
from pyspark.sql import functions as F

from splitlab.operators import accounts, loss
from splitlab.operators.bootstrap import bootstrap_rdiff
from splitlab.operators.metrics import unit_day_metrics, unit_series
from splitlab.plans.session import broadcast_if_small
from splitlab.sources.salts import generate_salts
from test_loss_bootstrap import M, config


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def events(spark, n=30_000, hot=0):
    """``hot`` of every 3 events belong to unit 1."""
    unit = F.when(F.col("id") % 3 < hot, 1).otherwise(F.col("id") % 200)
    return spark.range(n).select(
        unit.cast("bigint").alias("unit_id"), F.expr("date_add(DATE'2024-01-01', int(id % 14))").alias("day"),
        F.lit(1).alias("m1"), (F.col("id") % 11 + 1).cast("double").alias("m2"),
    )


def test_a_hot_unit_is_combined_before_the_shuffle(spark):
    days = unit_day_metrics([events(spark, hot=1)], M)
    assert days.agg(F.sum("m1")).first()[0] == 30_000
    text = plan(days)
    assert text.count("Exchange") == 1 and "partial_sum" in text
    (hot,) = unit_series(days, M, "2024-01-01", 14).df.where("unit_id = 1").collect()
    assert len(hot.days) == 14 and sum(d.v0 for d in hot.days) > 10_000


def test_regrouping_shuffles_once_after_the_product(spark):
    cfg = config()
    salts = generate_salts(spark, "B", cfg.run_date, 12)
    days = loss.salt_days(unit_series(unit_day_metrics([events(spark)], M), M, cfg.start_date, 14), salts, cfg)
    text = plan(loss.salt_loss(days, salts, cfg, M))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert text.count("MapInArrow") == 1, "comparing groups must not regroup the units again"
    # unit and day, unit, cells, salts
    assert len(re.findall(r"(?<!Broadcast)Exchange ", text)) == 4
    boot = plan(bootstrap_rdiff(unit_series(unit_day_metrics([events(spark)], M), M, "2024-01-01", 14), salts, 14))
    assert boot.count("MapInArrow") == 1 and "SortMergeJoin" not in boot and "CartesianProduct" not in boot


def test_day_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.sql("SELECT id AS unit_id, TIMESTAMP_NTZ'2024-01-05 03:00:00' AS ts, 1D AS m, 'x' AS unused FROM range(10)").write.parquet(path)
    rows = spark.read.parquet(path).select("unit_id", F.to_date("ts").alias("day"), "m")
    text = unit_series(unit_day_metrics([rows], ["m"]), ["m"], "2024-01-01", 14).df._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in text and "unused" not in text.split("ReadSchema")[-1]


def test_reports_join_no_facts(spark):
    """Cost, revenue and cancellations meet in one grouped sum, not in outer joins."""
    a = spark.sql("SELECT 1 AS hotel_id, DATE'2024-01-01' AS yyyy_mm_dd, 2D AS cost")
    b = spark.sql("SELECT 1 AS hotel_id, DATE'2024-01-01' AS yyyy_mm_dd, 3D AS gain")
    text = plan(accounts.outer_merge([a, b], ["hotel_id", "yyyy_mm_dd"]))
    assert "Join" not in text and text.count("Exchange") == 1


@pytest.mark.parametrize("rows,hinted", [(5, True), (6, False)])
def test_broadcast_only_behind_a_size_check(spark, rows, hinted):
    df = broadcast_if_small(spark.range(rows), 5)
    assert ("broadcast" in df._jdf.queryExecution().logical().toString().lower()) == hinted
