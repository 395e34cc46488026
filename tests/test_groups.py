import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from splitlab.operators import groups
from splitlab.operators.groups import assign_units, group_days, group_rows, work_grid
from splitlab.operators.metrics import unit_series
from splitlab.sources.salts import generate_salts


def unit_days(spark, units=60, days=9, seed=1, keep=0.6):
    rng = np.random.default_rng(seed)
    rows = [
        (int(u), pd.Timestamp("2024-01-01").date() + pd.Timedelta(days=int(d)), float(rng.integers(1, 9)), float(rng.normal(20, 5)))
        for u in range(units) for d in range(days) if rng.random() < keep
    ]
    frame = pd.DataFrame(rows, columns=["unit_id", "day", "m1", "m2"])
    return frame, spark.createDataFrame(frame, "unit_id long, day date, m1 double, m2 double")


@pytest.mark.parametrize("n_units", [None, 1, 10**9])
def test_group_days_equal_a_join_and_group(spark, n_units):
    _, df = unit_days(spark)
    salts = generate_salts(spark, "B", "2024-01-10", 30)
    slots = [0, 0, 1, 2, 2]
    series = unit_series(df, ["m1", "m2"], "2024-01-01", 9)
    object.__setattr__(series, "n_units", n_units)
    got = group_rows(group_days(series, salts, slots), [0, 1, 2], ["m1", "m2"])

    assigned = assign_units(df.select("unit_id").distinct(), salts, [2, 1, 2])
    joined = df.join(assigned, "unit_id")
    sizes = joined.groupBy("salt_id", "bucket").agg(F.count_distinct("unit_id").alias("n_units"))
    want = joined.groupBy("salt_id", "bucket", "day").agg(F.sum("m1").alias("m1"), F.sum("m2").alias("m2")).join(
        sizes, ["salt_id", "bucket"]
    ).withColumnRenamed("bucket", "grp")
    keys = ["salt_id", "grp", "day"]
    left = got.toPandas().sort_values(keys).reset_index(drop=True)
    right = want.toPandas()[left.columns].sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(left, right, check_dtype=False)


def test_kept_groups_and_missing_days(spark):
    df = spark.sql("SELECT 7L AS unit_id, DATE'2024-01-02' AS day, 3D AS m1")
    salts = generate_salts(spark, "B", "2024-01-10", 1)
    days = group_days(unit_series(df, ["m1"], "2024-01-01", 3), salts, [4, 9], keep=[4, 9])
    rows = days.orderBy("day").collect()
    home = 4 if rows[1]["m1__4"] is not None else 9
    other = 13 - home
    assert [r[f"m1__{home}"] for r in rows] == [None, 3.0, None]
    assert all(r[f"m1__{other}"] is None and r[f"n__{other}"] == 0 and r[f"n__{home}"] == 1 for r in rows)


def test_infinite_metrics_stay_in_their_group(spark):
    df = spark.createDataFrame([(u, float("inf") if u == 3 else 1.0) for u in range(40)], "unit_id long, m1 double")
    df = df.withColumn("day", F.lit("2024-01-01").cast("date"))
    salts = generate_salts(spark, "B", "2024-01-10", 5)
    rows = group_days(unit_series(df, ["m1"], "2024-01-01", 1), salts, [0, 1]).collect()
    assert all(sorted([r["m1__0"] == float("inf"), r["m1__1"] == float("inf")]) == [False, True] for r in rows)


def test_many_small_batches(spark, monkeypatch):
    """Results do not depend on batch sizes or on how the product is cut."""
    frame, df = unit_days(spark, units=50)
    salts = generate_salts(spark, "B", "2024-01-10", 23)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def total():
        days = group_days(unit_series(df, ["m1", "m2"], "2024-01-01", 9), salts, [0, 1])
        return days.agg(F.sum("m1__0"), F.sum("m1__1"), F.sum("n__0"), F.count("*")).first()

    whole = total()
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        assert total() == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert whole[0] + whole[1] == 23 * frame.m1.sum() and whole[3] == 23 * 9


def test_work_grid_balances_copies_and_partial_results():
    assert work_grid(24, 3, 91, 8000, n_units=10**9) == (1, 8000)
    blocks, chunks = work_grid(10_000, 20, 91, 16, n_units=1_500)
    assert blocks == 16 and chunks == 1
    blocks, _ = work_grid(10_000, 20, 91, 4000, n_units=10**6)
    assert blocks * groups.SUMS_PER_TASK >= 10_000 * 20 * 91
    assert work_grid(1, 1, 31, 16)[0] == 1


def test_repeated_unit_days_add_up(spark):
    rows = [(1, "2024-01-01", 5.0), (1, "2024-01-01", 7.0), (1, "2024-01-02", 1.0), (1, "2024-01-02", None)]
    df = spark.createDataFrame(rows, "unit_id long, day string, m1 double").withColumn("day", F.to_date("day"))
    days = group_days(unit_series(df, ["m1"], "2024-01-01", 3), generate_salts(spark, "B", "2024-01-10", 2), [0])
    got = {(r.salt_id, str(r.day)): (r.m1, r.n_units) for r in group_rows(days, [0], ["m1"]).collect()}
    assert len(got) == 4 and all(v == ((12.0, 1) if d == "2024-01-01" else (1.0, 1)) for (_, d), v in got.items())


def test_more_salts_than_one_broadcast(spark, monkeypatch):
    _, df = unit_days(spark, units=9, days=2, keep=1.0)
    salts = generate_salts(spark, "B", "2024-01-15", 37)
    units = df.select("unit_id").distinct()
    whole = sorted(map(tuple, assign_units(units, salts, [2, 1, 2]).collect()))
    monkeypatch.setattr(groups, "BROADCAST_ROWS", 10)
    assert sorted(map(tuple, assign_units(units, salts, [2, 1, 2]).collect())) == whole and len(whole) == 9 * 37
