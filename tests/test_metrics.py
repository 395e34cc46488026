import datetime as dt

from pyspark.sql import functions as F

from splitlab.functions.dates import lookback
from splitlab.operators.metrics import outer_merge, prepared, unit_day_metrics, unit_series

D = dt.date(2024, 1, 2)


def test_lookback_is_inclusive():
    assert lookback("2024-01-30", 28) == (dt.date(2024, 1, 2), dt.date(2024, 1, 29))


def test_missing_metrics_are_zero_and_empty_rows_go(spark):
    a = spark.createDataFrame([(1, D, 2.0), (2, D, 0.0), (None, D, 9.0)], "unit_id long, day date, m1 double")
    b = spark.createDataFrame([(1, D, float("nan")), (3, D, 4.0), (2, D, 0.0)], "unit_id long, day date, m2 double")
    rows = {tuple(r) for r in unit_day_metrics([a, b], ["m1", "m2"]).collect()}
    assert rows == {(1, D, 2.0, 0.0), (3, D, 0.0, 4.0)}


def test_outer_merge_equals_a_full_join_with_null_keys(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "x", 2.0), (None, "x", 3.0)], "k long, p string, u double")
    b = spark.createDataFrame([(1, "x", 5.0), (3, "x", 6.0), (None, "x", 7.0)], "k long, p string, v double")
    merged = {tuple(r) for r in outer_merge([a, b], ["k", "p"]).collect()}
    joined = {tuple(r) for r in a.join(b, ["k", "p"], "outer").collect()}
    assert merged == joined and len(merged) == 5


def test_series_hold_the_period_only(spark):
    days = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), 1.0), (1, D, 2.0), (1, dt.date(2024, 1, 4), 4.0), (2, dt.date(2024, 1, 5), 8.0)],
        "unit_id long, day date, m double",
    )
    series = prepared(unit_series(days, ["m"], "2024-01-02", 3))
    assert series.n_units == 1
    (row,) = series.df.select("unit_id", F.sort_array("days").alias("days")).collect()
    assert [tuple(d) for d in row.days] == [(0, 2.0), (2, 4.0)]
