import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import plain_statistics as student
import twins
from splitlab.functions import probability
from splitlab.operators import analysis
from splitlab.operators.cuped import cuped_adjust, cuped_by_unit, cuped_metrics

START = dt.date(2024, 1, 1)


@pytest.fixture
def frame():
    rng = np.random.default_rng(3)
    rows = []
    for role in ("control", "test"):
        for num in (1, 2):
            for d in range(40):
                phase = "pre" if d < 20 else "post"
                value = 50 + 10 * np.sin(d / 3) + rng.normal(0, 2) + (6 if role == "test" and phase == "post" else 0)
                rows.append((START + dt.timedelta(days=d), f"{role}-{num}-{phase}", num, f"{role}{num}", role, float(value)))
    return pd.DataFrame(rows, columns=["date", "group", "group_num", "logic", "test_control_group", "value"])


SCHEMA = "date date, group string, group_num int, logic string, test_control_group string, value double"


def series(spark, frame, numbered=True):
    df = spark.createDataFrame(frame, SCHEMA)
    return df if numbered else df.withColumn("group_num", F.lit(None).cast("int"))


def test_student_t_against_tables():
    assert student.two_sided_p(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert student.two_sided_p(12.706205, 1) == pytest.approx(0.05, abs=1e-6)
    assert student.two_sided_p(1.959964, 1e7) == pytest.approx(0.05, abs=1e-5)
    assert student.two_sided_p(0.0, 5) == 1 and student.two_sided_p(1.0, 1) == pytest.approx(0.5)
    assert student.t_quantile(0.05, 10) == pytest.approx(2.228139, abs=1e-6)


def test_probability_expressions(spark):
    rows = [(t, df) for t in (0.0, 0.3, 1.0, 1.96, 2.5, 7.0, -3.1, 40.0) for df in (0.7, 1.0, 2.5, 10.0, 55.4, 300.0)]
    odd = [(float("inf"), 3.0), (float("nan"), 3.0), (None, 3.0), (1.0, None), (1.0, 0.0), (1.96, 1e9), (1.0, 1e7)]
    frame = spark.createDataFrame(rows + odd, "t double, df double")
    got = frame.select("t", "df", probability.t_pvalue("t", "df").alias("p"), probability.t_critical("df").alias("q"), probability.normal_cdf("t").alias("z")).collect()
    for r in got[: len(rows)]:
        assert r.p == pytest.approx(student.two_sided_p(r.t, r.df), rel=1e-9, abs=1e-13)
        assert r.q == pytest.approx(student.t_quantile(0.05, r.df), rel=1e-9)
        assert r.z == pytest.approx(0.5 * math.erfc(-r.t / math.sqrt(2)), abs=1e-14)
    assert [r.p for r in got[len(rows) : len(rows) + 5]] == [0.0, None, None, None, None]
    assert got[-2].p == pytest.approx(0.0499957903, abs=1e-10)
    assert got[-1].p == pytest.approx(0.3173105320599, abs=1e-12), "the series in 1/df, where gamma functions would cancel"


@pytest.mark.parametrize("t,df", [(0.3, 2.5), (2.0, 4.7), (7.0, 2.5), (3.1, 55.4), (9.0, 30.0)])
def test_student_t_against_the_integral_of_its_density(t, df):
    at = np.linspace(0, t, 200_001)
    scale = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    inside = 2 * np.trapezoid(scale * (1 + at * at / df) ** (-(df + 1) / 2), at)
    assert student.two_sided_p(t, df) == pytest.approx(1 - inside, abs=1e-10)
    assert student.t_quantile(student.two_sided_p(t, df), df) == pytest.approx(t, rel=1e-9)


def test_pairs_match_on_number_only_when_all_have_one(spark, frame):
    assert analysis.pair_days(series(spark, frame)).count() == 80
    assert analysis.pair_days(series(spark, frame, False)).count() == 160
    mixed = series(spark, frame).withColumn("group_num", F.when(F.col("date") > START, F.col("group_num")))
    assert analysis.pair_days(mixed).count() == 160


def test_welch(spark, frame):
    rows = {r.comparison: r for r in analysis.welch_ttest(series(spark, frame)).collect()}
    x = frame[frame.logic == "control1"].value.to_numpy()
    y = frame[frame.logic == "test1"].value.to_numpy()
    vx, vy, n = x.var(ddof=1) / 40, y.var(ddof=1) / 40, 40
    t = (y.mean() - x.mean()) / np.sqrt(vx + vy)
    df = (vx + vy) ** 2 / ((vx**2 + vy**2) / (n - 1))
    row = rows["control-1 X test-1"]
    assert row.t_stat == pytest.approx(t) and row.df == pytest.approx(df)
    assert row.p_value == pytest.approx(student.two_sided_p(t, df))
    half = student.t_quantile(0.05, df) * np.sqrt(vx + vy)
    assert (row.ci_from, row.ci_to) == pytest.approx((y.mean() - x.mean() - half, y.mean() - x.mean() + half))
    assert row.relative_diff == pytest.approx(((x / y).mean() - 1) * 100) and row.mean_abs_diff == pytest.approx((x - y).mean())
    assert row.significant == (row.p_value < 0.05)


def test_single_day_is_marked(spark, frame):
    row = analysis.welch_ttest(series(spark, frame[frame.date == START])).first()
    assert (row.t_stat, row.df, row.ci_from, row.ci_to, row.p_value) == (-99.0,) * 5
    assert row.relative_diff is not None and row.significant is False


def test_did_equals_least_squares(spark, frame):
    rows = {r.comparison: r for r in analysis.did(series(spark, frame)).collect()}
    part = frame[frame.logic.isin(["control2", "test2"])]
    treat = (part.test_control_group == "test").to_numpy(float)
    after = (~part.group.str.contains("pre")).to_numpy(float)
    beta, t, _ = twins.regress(part.value.to_numpy(), [np.ones(len(part)), treat, after, treat * after])
    row = rows["control2 X test2"]
    assert row.estimate == pytest.approx(beta[3]) and row.t_value == pytest.approx(t[3])
    assert row.p_value == pytest.approx(student.two_sided_p(t[3], len(part) - 4))
    assert row.significant == (row.p_value < 0.05)


def test_missing_values_count_on_no_side(spark, frame):
    gap = (F.col("group") == "control-2-pre") & (F.col("date") == START)
    holes = series(spark, frame).withColumn("value", F.when(~gap, F.col("value")))
    row = {r.comparison: r for r in analysis.did(holes).collect()}["control2 X test2"]
    assert row.df == 80 - 1 - 4
    welch = {r.logic + r.comparison: r for r in analysis.welch_ttest(holes).collect()}
    x = frame[frame.logic == "control2"].value.to_numpy()[1:]
    y = frame[frame.logic == "test2"].value.to_numpy()
    ex, ey = x.var(ddof=1) / 39, y.var(ddof=1) / 40
    t, df = (y.mean() - x.mean()) / np.sqrt(ex + ey), (ex + ey) ** 2 / (ex**2 / 38 + ey**2 / 39)
    assert any((r.t_stat, r.df) == pytest.approx((t, df)) for r in welch.values()), (t, df, welch)
    no_cell = {r.comparison: r for r in analysis.did(series(spark, frame[frame.group != "test-2-post"])).collect()}
    assert no_cell["control2 X test2"].estimate is None and no_cell["control1 X test1"].estimate is not None


@pytest.mark.parametrize("season", [None, 7])
def test_counterfactual_finds_the_effect(spark, frame, season):
    rows = analysis.counterfactual_effect(series(spark, frame), season).where("comparison = 'control-1 X test-1'")
    got = rows.orderBy("date").collect()
    assert len(got) == 20
    assert np.mean([r.effect for r in got]) == pytest.approx(6, abs=2.5)
    assert got[-1].cumulative_effect == pytest.approx(sum(r.effect for r in got))
    if season is None:
        wide = frame[frame.logic.isin(["control1", "test1"])].pivot(index="date", columns="test_control_group", values="value")
        pre = wide.iloc[:20]
        beta, *_ = twins.regress(pre.test.to_numpy(), [np.ones(20), pre.control.to_numpy()])
        assert got[0].predicted == pytest.approx(beta[0] + beta[1] * wide.control.iloc[20])


def test_counterfactual_keeps_weekdays_without_pre_days(spark, frame):
    short = frame[frame.date >= START + dt.timedelta(days=17)]  # 3 pre and 20 post days
    got = analysis.counterfactual_effect(series(spark, short), 7).where("comparison = 'control-1 X test-1'").orderBy("date").collect()
    assert len(got) == 20 and all(r.effect is not None for r in got)
    y = short[(short.logic == "test1")].value.to_numpy()
    assert got[0].date.weekday() not in [(START + dt.timedelta(days=d)).weekday() for d in (17, 18, 19)]
    assert got[0].predicted == pytest.approx(y[:3].mean())  # one day per weekday leaves no slope


def test_descriptives_and_pre_period(spark, frame):
    x, y = (frame[frame.logic == k].value.to_numpy() for k in ("control1", "test1"))
    ratio = {r.comparison: r.rel_diff for r in analysis.reldiff_descriptives(series(spark, frame)).collect()}
    assert ratio["control-1 X test-1"] == pytest.approx((x / y).mean() * 100)
    diff = {r.comparison: r.absolute_difference for r in analysis.abs_diff_descriptives(series(spark, frame)).collect()}
    assert diff["control-1 X test-1"] == pytest.approx((y.mean() - x.mean()) * 100)
    pre = series(spark, frame[frame.group.str.endswith("pre")])
    rows = analysis.pre_stationarity(pre).collect()
    assert [r.adf_pvalue for r in rows] == sorted(r.adf_pvalue for r in rows)
    by = {r.comparison: r for r in rows}
    assert by["control1 X test1"].rmse == pytest.approx(np.sqrt(((y - x)[:20] ** 2).mean()))
    assert {r.comparison for r in analysis.pre_rmse(pre).collect()} == set(by)


def test_undefined_ratio_makes_the_mean_undefined(spark):
    rows = [(START + dt.timedelta(days=d), f"{r}-1-pre", 1, r, r, 0.0 if d == 0 else 2.0) for d in range(3) for r in ("control", "test")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert analysis.reldiff_descriptives(df).first().rel_diff is None
    assert analysis.abs_diff_descriptives(df).first().absolute_difference == 0


def test_cuped(spark):
    rng = np.random.default_rng(11)
    pre = rng.normal(10, 3, 400)
    post = 2 + 0.8 * pre + rng.normal(0, 1, 400)
    current = spark.createDataFrame([("e", i, float(v)) for i, v in enumerate(post)], "exp_name string, unit_id long, m double")
    before = spark.createDataFrame([("e", i, float(v)) for i, v in enumerate(pre) if i % 10], "exp_name string, unit_id long, m double")
    filled = np.where(np.arange(400) % 10 == 0, 0.0, pre)
    theta = np.cov(filled, post)[0, 1] / filled.var(ddof=1)
    rows = sorted(cuped_adjust(current, before, ["m"]).collect(), key=lambda r: r.unit_id)
    assert [r.cuped_m for r in rows] == pytest.approx(list(post - theta * filled))
    centred = [r.cuped_m for r in cuped_adjust(current, before, ["m"], centre=True).collect()]
    assert np.mean(centred) == pytest.approx(post.mean()) and np.var(centred) < post.var()
    seen = []
    cuped_metrics(lambda a, b: seen.append((a, b)) or current, "2024-01-15", "2024-01-28", 2, ["m"], ["exp_name", "unit_id"])
    assert seen[1] == (dt.date(2024, 1, 1), dt.date(2024, 1, 14))


def test_cuped_by_unit_has_a_theta_for_each_experiment(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame(
        [(u, START + dt.timedelta(days=d), 5 + u % 7 + rng.normal()) for u in range(60) for d in range(28) if u % 9 or d > 20],
        columns=["unit_id", "day", "m"],
    )
    listed = [("a", u, 14, 27) for u in range(0, 60, 2)] + [("b", u, 17, 23) for u in range(0, 60, 3)] + [(None, 1, 14, 27), (None, 7, 14, 20), ("a", None, 14, 27)]
    listed += [("a", 0, 14, 20), ("b", 999, 17, 23)]  # listed twice; without rows
    exposures = spark.createDataFrame(
        [(e, u, START + dt.timedelta(days=s), START + dt.timedelta(days=t)) for e, u, s, t in listed],
        "exp_name string, unit_id long, start_date date, end_date date",
    )
    rows = cuped_by_unit(spark.createDataFrame(frame), exposures, ["m"], 2).collect()
    expected = {}
    for e, u, s, t in listed:
        if u is not None and (e, u) not in expected:
            mine = frame[frame.unit_id == u]
            at = mine.day.map(lambda x: (x - START).days)
            expected[e, u] = (mine.m[at.between(s, t)].sum(), mine.m[at.between(s - 14, t - 14)].sum())
    assert len(rows) == len(expected) and {(r.exp_name, r.unit_id) for r in rows} == expected.keys()
    for name in ("a", "b", None):
        now, before = np.array([v for (e, _), v in expected.items() if e == name]).T
        theta = np.cov(before, now)[0, 1] / before.var(ddof=1)
        found = {r.unit_id: (r.m, r.prev_m, r.cuped_m) for r in rows if r.exp_name == name}
        for (e, u), (m, prev) in expected.items():
            if e == name:
                assert found[u] == pytest.approx((m, prev, m - theta * prev))


def test_cuped_by_unit_of_nobody(spark):
    days = spark.createDataFrame([], "unit_id long, day date, m double")
    exposures = spark.createDataFrame([], "exp_name string, unit_id long, start_date date, end_date date")
    assert cuped_by_unit(days, exposures, ["m"], 2).collect() == []
