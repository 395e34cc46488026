import numpy as np
import pytest
from pyspark.sql import functions as F

import plain_statistics
import twins
from splitlab.functions import unitroot
from splitlab.functions.series import kpss_pvalue, short_lags
from splitlab.operators import select, stationarity
from splitlab.operators.metrics import unit_series
from splitlab.sources.salts import generate_salts
from test_groups import unit_days
from test_loss_bootstrap import M, config


def walks(n, count, seed, unit_root):
    noise = np.random.default_rng(seed).normal(size=(count, n))
    return noise.cumsum(axis=1) if unit_root else 5 + noise


def adf_of(spark, x, test=unitroot.with_adf):
    """Statistics, p-values (NaN where undefined) and lags of the rows of ``x`` by expressions."""
    df = spark.createDataFrame([(i, list(map(float, row))) for i, row in enumerate(x)], "i int, s array<double>").repartition(8)
    rows = sorted(test(df, "s").collect(), key=lambda r: r.i)
    number = lambda v: np.nan if v is None else v
    return np.array([number(r.adf) for r in rows]), np.array([number(r.adf_pvalue) for r in rows]), [getattr(r, "adf_lags", None) for r in rows]


def test_adf_equals_one_regression_per_lag(spark):
    for n in (8, 12, 28, 42, 90):
        x = np.concatenate([walks(n, 12, n, True), walks(n, 12, n, False)])
        stat, p, lags = adf_of(spark, x)
        plain = plain_statistics.adf_aic(x)
        assert p == pytest.approx(plain[1], rel=1e-7, abs=1e-12)
        for i, row in enumerate(x):
            want, lag = twins.adf(row)
            assert lags[i] == plain[2][i] == lag and stat[i] == pytest.approx(want, rel=1e-7) and plain[0][i] == pytest.approx(want, rel=1e-7)


def test_adf_trend_equals_least_squares(spark):
    x = walks(30, 5, 3, True)
    stat, p, _ = adf_of(spark, x, unitroot.with_adf_trend)
    plain = plain_statistics.adf_trend(x)
    assert set(plain[2]) == {3} and p == pytest.approx(plain[1], rel=1e-9)
    for i, row in enumerate(x):
        dx = np.diff(row)
        y = dx[3:]
        cols = [np.ones(len(y)), np.arange(len(y), dtype=float), row[3:-1], dx[2:-1], dx[1:-2], dx[:-3]]
        assert stat[i] == pytest.approx(twins.regress(y, cols)[1][2], rel=1e-8)


def test_adf_size_and_power(spark):
    p_root = plain_statistics.adf_aic(walks(250, 1500, 7, True))[1]
    assert abs((p_root < 0.05).mean() - 0.058) < 0.02
    p_noise = adf_of(spark, walks(42, 800, 8, False))[1]
    assert (p_noise < 0.05).mean() > 0.85
    assert adf_of(spark, walks(250, 1500, 7, True)[:60])[1] == pytest.approx(p_root[:60], rel=1e-7, abs=1e-12)


def test_pvalues_at_published_critical_values(spark):
    t = spark.createDataFrame([(i, v) for i, v in enumerate([-3.43, -2.86, -2.57, 3.0, -19.0, None])], "i int, __t double")
    p = [r["__p"] for r in unitroot._constant_pvalue(t).orderBy("i").collect()]
    assert p[:3] == pytest.approx([0.01, 0.05, 0.10], abs=1e-3)
    assert p[3] == 1 and p[4] == 0 and p[5] is None
    t = spark.createDataFrame([(i, v, [0.0] * 25) for i, v in enumerate([-3.60, -9.0, 9.0])], "i int, __t double, __d array<double>")
    assert [r["__p"] for r in unitroot._trend_pvalue(t).orderBy("i").collect()] == pytest.approx([0.05, 0.01, 0.99])


def test_constant_series_has_no_statistic(spark):
    stat, p, _ = adf_of(spark, np.ones((2, 30)))
    assert np.isnan(stat).all() and np.isnan(p).all()


def test_native_statistics(spark):
    series = [list(map(float, row)) for n in (8, 28, 42) for row in walks(n, 4, n, n == 28)]
    odd = [[1.0] * 7, [1.0] * 20, [1.0, None] * 10, [float("inf")] + [1.0] * 20]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(series + odd)], "i int, series array<double>")
    tested = stationarity.adf_stats(stationarity.kpss_stats(stationarity.dickey_fuller_stats(df)))
    rows = sorted(tested.collect(), key=lambda r: r.i)
    for row, x in zip(rows, map(np.array, series)):
        assert row.kpss == pytest.approx(twins.kpss(x), rel=1e-9)
        dx = np.diff(x)
        assert row.df_stat == pytest.approx(twins.regress(dx, [np.ones(len(dx)), x[:-1]])[1][1], rel=1e-9)
        assert row.adf == pytest.approx(twins.adf(x)[0], rel=1e-7)
    assert all(r.kpss is None and r.adf is None and r.df_stat is None for r in rows[len(series):])
    lags = spark.range(1).select(short_lags(F.lit(30)).alias("l"), kpss_pvalue(F.lit(0.463)).alias("p")).first()
    assert lags.l == 2 and lags.p == pytest.approx(0.05)


def expected_stationarity(frame, salt, cfg):
    merged = twins.pairs(frame, salt, cfg, M, per_unit=False)
    for test in cfg.test:
        rows = merged[(merged.grp_t == test)]
        for m in M:
            x = rows[m].to_numpy()
            n_control = sum(len(g) for _, g in merged.drop_duplicates(["day", "grp_c"]).groupby("day"))
            if len(x) != n_control or len(x) < 8 or not np.isfinite(x).all():
                return False
            p = plain_statistics._constant_pvalue(np.array([twins.adf(x)[0]]))[0]
            if not (p < 0.05 and twins.kpss(x) < 0.463):
                return False
    return True


@pytest.mark.parametrize("control", [2, [1, 2]])
def test_stationarity_of_salts(spark, control):
    frame, df = unit_days(spark, units=30, days=14, keep=0.5, seed=9)
    cfg = config(control=control, test=[0], ntrials=25)
    salts = generate_salts(spark, "B", cfg.run_date, 25)
    days = select.salt_days(unit_series(df, M, cfg.start_date, cfg.period), salts, cfg)
    tested = stationarity.stationarity(days, cfg, M).join(salts.df, "salt_id").collect()
    got = {r.salt: r.stat_result for r in tested}
    want = {r.salt: expected_stationarity(frame, r.salt, cfg) for r in salts.df.collect()}
    assert {s: v for s, v in got.items() if v} == {s: v for s, v in want.items() if v}
    assert any(want.values()) and not all(want.values())


@pytest.fixture
def walked(spark, monkeypatch):
    """A walk over 700 salts whose stationary ones, by rank, the test chooses."""
    _, df = unit_days(spark, units=12, days=14)
    cfg = config(ntrials=700)
    salts = generate_salts(spark, "B", cfg.run_date, 700)
    series = unit_series(df, M, cfg.start_date, cfg.period)

    def build(passing, **options):
        walk = select.SaltWalk(series, salts, cfg, **options)
        ids = [r.salt_id for r in walk.ranked.where(F.col("index").isin(passing)).collect()]

        def fake(days, config, metrics):
            return days.select("salt_id").distinct().withColumn("stat_result", F.col("salt_id").isin(ids))

        monkeypatch.setattr(select, "stationarity", fake)
        return walk

    return build


def test_remainder_is_tested_unless_left_out(walked):
    walk = walked([600], test_remainder=False)
    row = select.smart_salt(walk).first()
    assert row["index"] == 0 and row.stat_result is False
    assert select.smart_salt_table(walk).count() == 0
    full = walked([600])
    assert select.smart_salt(full).first()["index"] == 600


def test_lowest_loss_of_the_first_batch_wins(walked):
    walk = walked([340, 130, 610], batch_size=100)
    row = select.smart_salt(walk).first()
    assert row["index"] == 130 and row.stat_result is True


def test_table_is_one_batch_or_cumulative(walked):
    walk = walked([1, 2, 101, 102, 103, 205, 650], batch_size=100)
    index = lambda t: sorted(r["index"] for r in t.collect())
    assert index(select.smart_salt_table(walk, 3)) == [101, 102, 103]
    assert index(select.smart_salt_table(walk, 4)) == [1, 2, 101, 102, 103, 205, 650]
    assert index(select.smart_salt_table(walk, 4, cumulative=True)) == [1, 2, 101, 102, 103]


def test_fewer_salts_than_a_batch(walked):
    walk = walked([3], batch_size=1000)
    assert select.smart_salt(walk).first()["index"] == 3
    assert [r["index"] for r in select.smart_salt_table(walk).collect()] == [3]


def test_statistics_of_short_series(spark):
    rows = [(n, [float(v) for v in walks(n, 1, n, False)[0]]) for n in range(8)]
    df = spark.createDataFrame(rows, "n int, series array<double>")
    got = {r.n: r for r in stationarity.dickey_fuller_stats(stationarity.kpss_stats(df)).collect()}
    for n, row in rows:
        assert (got[n].kpss is None) == (n < 2) and (got[n].df_stat is None) == (n < 4)
        x = np.array(row)
        if n >= 4:
            assert got[n].df_stat == pytest.approx(twins.regress(np.diff(x), [np.ones(n - 1), x[:-1]])[1][1], rel=1e-8)
        if n >= 2:
            e, lags = x - x.mean(), int(np.ceil(12 * (n / 100) ** 0.25))
            variance = (e @ e + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, min(lags, n - 1) + 1))) / n
            assert got[n].kpss == pytest.approx((e.cumsum() ** 2).sum() / n**2 / variance)
