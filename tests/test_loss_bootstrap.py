import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import twins
from splitlab.operators.bootstrap import bootstrap_ci, bootstrap_rdiff, compare_ci
from splitlab.operators.loss import salt_days, salt_loss
from splitlab.operators.metrics import unit_series
from splitlab.operators.quantiles import exact_quantiles
from splitlab.plans.config import SplitConfig
from splitlab.sources.salts import SaltSet, generate_salts
from test_groups import unit_days

M = ["m1", "m2"]


def config(**change):
    base = dict(run_date="2024-01-15", exp_groups=[2, 3, 5], control=2, test=[0, 1], exp_weights=[1] * 10, period=14, ntrials=12)
    return SplitConfig(**(base | change))


def losses(spark, df, cfg, version, metrics=M):
    salts = generate_salts(spark, cfg.base_salt, cfg.run_date, cfg.ntrials)
    days = salt_days(unit_series(df, metrics, cfg.start_date, cfg.period), salts, cfg)
    return {r.salt: r.pae for r in salt_loss(days, salts, cfg, metrics, version).collect()}


@pytest.mark.parametrize("version", [1, 2, 3])
@pytest.mark.parametrize("control,test", [(2, [0, 1]), ([0, 2], [1]), (0, 0)])
def test_loss_equals_the_definition(spark, version, control, test):
    if version == 3 and control == 0:
        pytest.skip("a group against itself has no variance")
    frame, df = unit_days(spark, units=40, days=14)
    cfg = config(control=control, test=test)
    got = losses(spark, df, cfg, version)
    assert len(got) == 12
    for salt, pae in got.items():
        assert pae == pytest.approx(twins.loss(frame, salt, cfg, M, version), rel=1e-9, abs=1e-12)


def test_version_two_is_version_one_times_groups(spark):
    _, df = unit_days(spark, units=30, days=14)
    one, two = losses(spark, df, config(), 1), losses(spark, df, config(), 2)
    assert all(two[s] == pytest.approx(3 * one[s]) for s in one)


def test_period_divides_and_constant_ratio_has_no_version_three(spark):
    rows = [(u, dt.date(2024, 1, d), 1.0) for u in range(60) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, "unit_id long, day date, m1 double")
    assert set(losses(spark, df, config(), 1, ["m1"]).values()) == {0.0}
    assert set(losses(spark, df, config(), 3, ["m1"]).values()) == {None}


def test_zero_control_is_infinite_and_zero_over_zero_is_skipped(spark):
    df = spark.sql("SELECT id AS unit_id, DATE'2024-01-01' AS day, IF(id % 2 = 0, 1D, 1D) AS m1, 0D AS m2 FROM range(40)")
    cfg = config(exp_groups=[1, 1], exp_weights=[1, 1], control=1, test=0)
    assert all(not math.isinf(v) for v in losses(spark, df, cfg, 1).values())
    # One unit with a value: control sums to zero when the unit is in the test group.
    one = df.withColumn("m1", F.when(F.col("unit_id") == 3, 5.0).otherwise(0.0))
    got = losses(spark, one, cfg, 1)
    for salt, pae in got.items():
        assert math.isinf(pae) if twins.slot(3, salt, 2) == 0 else pae == pytest.approx(1 / 14 / 2)


def test_config_checks_groups():
    with pytest.raises(ValueError):
        config(exp_groups=[2, 3])
    with pytest.raises(ValueError):
        config(test=[3])


SCHEMES = [[1] * 6, [2] * 3, [3] * 2]


@pytest.mark.parametrize("units,keep", [(40, 0.6), (9, 0.3)])
def test_bootstrap_equals_the_definition(spark, units, keep):
    """Nine sparse units leave groups empty and days without rows."""
    frame, df = unit_days(spark, units=units, days=15, keep=keep, seed=4)
    salts = generate_salts(spark, "B", "2024-01-16", 6)
    got = bootstrap_rdiff(unit_series(df, M, "2024-01-01", 15), salts, 15, [1] * 6, SCHEMES).collect()
    mine = {(r.salt, r.paired_groups, r.num_days, r.num_groups): (r.rdiff_m1, r.rdiff_m2) for r in got}
    want = {
        (s, p, d, g): tuple(values)
        for s in {r.salt for r in salts.df.collect()}
        for p, d, g, *values in twins.bootstrap(frame, s, 15, [1] * 6, SCHEMES, M)
    }
    assert mine.keys() == want.keys() and len(mine) == len(got)
    for key, values in want.items():
        got_values = tuple(np.nan if v is None else v for v in mine[key])
        assert got_values == pytest.approx(values, rel=1e-9, abs=1e-12, nan_ok=True), key
    if units == 40:
        assert len(got) == 6 * (15 + 3 + 1) * 2


def test_equal_groups_differ_by_nothing(spark):
    df = spark.sql("SELECT id AS unit_id, DATE'2024-01-01' AS day, 1D AS m1 FROM range(1)")
    stacked = df.unionByName(df.withColumn("unit_id", F.lit(1).cast("bigint")))
    salts = generate_salts(spark, "B", "2024-01-16", 20)
    rows = bootstrap_rdiff(unit_series(stacked, ["m1"], "2024-01-01", 7), salts, 7, [1, 1], [[1, 1]]).collect()
    assert {r.rdiff_m1 for r in rows} <= {0.0, None}


@pytest.mark.parametrize("case", ["normal", "ties", "one value in three", "signs and zeros", "single"])
def test_quantiles_are_exact(spark, case):
    rng = np.random.default_rng(5)
    values = {
        "normal": rng.normal(0, 1, 5000), "ties": rng.integers(0, 5, 4000).astype(float),
        "one value in three": np.where(rng.random(3000) < 0.34, 0.5, rng.normal(0, 9, 3000)),
        "signs and zeros": np.concatenate([np.zeros(10), rng.normal(0, 1e-12, 500), -(10.0 ** rng.uniform(-300, 300, 501))]),
        "single": np.array([3.25]),
    }[case]
    probs = [0.0, 0.025, 0.5, 0.975, 1.0]
    df = spark.createDataFrame(pd.DataFrame({"g": 1, "x": values, "y": -values}))
    got = {r.prob: (r.x, r.y) for r in exact_quantiles(df, ["g"], ["x", "y"], probs).collect()}
    for p in probs:
        assert got[p][0] == pytest.approx(np.quantile(values, p), rel=1e-12)
        assert got[p][1] == pytest.approx(np.quantile(-values, p), rel=1e-12)


def test_interval_table_rounds_and_names(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"paired_groups": "0_1", "num_days": 7, "num_groups": 2, "rdiff_a": rng.normal(1, 1, 300)})
    df = spark.createDataFrame(frame)
    rows = {r.confidence_interval: r.eb_a for r in bootstrap_ci(df, ["a"]).collect()}
    centred = frame.rdiff_a - frame.rdiff_a.mean()
    assert rows == {"2.5%": round(centred.quantile(0.025), 3), "97.5%": round(centred.quantile(0.975), 3)}
    both = compare_ci({"p": bootstrap_ci(df, ["a"]), "q": bootstrap_ci(df, ["a"])}, ["a"])
    assert both.columns == ["confidence_interval", "num_groups", "num_days", "p_a", "q_a"] and both.count() == 2


def test_repeated_salts_are_kept_apart(spark):
    frame, df = unit_days(spark, units=20, days=14)
    twice = SaltSet(spark.createDataFrame([(0, "S"), (1, "S")], "salt_id long, salt string"), 2)
    rows = bootstrap_rdiff(unit_series(df, M, "2024-01-01", 14), twice, 14, [1, 1], [[1, 1]]).collect()
    assert len(rows) == 4 and len({(r.num_days, r.rdiff_m1) for r in rows}) == 2
