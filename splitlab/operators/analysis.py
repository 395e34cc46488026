"""Reading an experiment: tests and effect sizes on daily series of control and test groups.

Input series have one row per day and group: (date, group, group_num, logic,
test_control_group, value). ``x`` stands for control, ``y`` for test. Days are paired by date,
and by ``group_num`` too when every row has one. Such a table is small but costly to derive and
is read several times, so pass it materialised.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splitlab.functions.arith import mean_if_all_defined, safe_ratio
from splitlab.functions.probability import t_critical, t_pvalue
from splitlab.functions.series import kpss_pvalue, short_lags, with_kpss
from splitlab.functions.unitroot import with_adf_trend

SINGLE_DAY = -99.0
FIELDS = ["group", "logic", "value"]


def short_group(group: Column) -> Column:
    """The first two dash-separated tokens of a group name."""
    return F.regexp_replace(group, "^([^-]*-[^-]*).*", "$1")


def pair_days(series: DataFrame, role: str = "test_control_group", dimension: Sequence[str] = ()) -> DataFrame:
    """Control rows joined with test rows of the same day: date, x_* and y_* columns.

    All control and test groups of a day meet, or only those with the same ``group_num`` when no
    row lacks one. Series are daily totals, so the pairs of a day are groups squared.
    """
    numbered = series.where(F.col("group_num").isNull()).limit(1).count() == 0
    keys = ["date", *(["group_num"] if numbered else []), *dimension]

    def side(name: str, prefix: str) -> DataFrame:
        rows = series.where(F.col(role).contains(name))
        return rows.select(*keys, *[F.col(f).alias(f"{prefix}_{f}") for f in FIELDS])

    return side("control", "x").join(side("test", "y"), keys)


def _logic(sep: str = " X ") -> Column:
    return F.concat("x_logic", F.lit(sep), "y_logic")


def _comparison() -> Column:
    return F.concat(short_group(F.col("x_group")), F.lit(" X "), short_group(F.col("y_group")))


def pre_rmse(series: DataFrame) -> DataFrame:
    """Root mean squared difference between test and control per comparison."""
    pairs = pair_days(series, role="group").withColumn("comparison", _logic())
    return pairs.groupBy("comparison").agg(
        F.sqrt(F.avg(F.pow(F.col("y_value") - F.col("x_value"), 2))).alias("rmse")
    )


def pre_stationarity(series: DataFrame) -> DataFrame:
    """RMSE and the KPSS-level and ADF (constant and trend) p-values of test over control.

    Sorted by ADF p ascending, KPSS p descending, RMSE ascending.
    """
    pairs = pair_days(series, role="group").withColumn("comparison", _logic())
    ratio = safe_ratio(F.col("y_value"), F.col("x_value"))
    points = F.sort_array(F.collect_list(F.struct("date", "x_group", "y_group", ratio.alias("ratio"))))
    grouped = pairs.groupBy("comparison").agg(
        F.sqrt(F.avg(F.pow(F.col("y_value") - F.col("x_value"), 2))).alias("rmse"),
        points.getField("ratio").alias("series"),
    )
    tested = with_adf_trend(with_kpss(grouped, "series", lags=short_lags), "series")
    return tested.select(
        "comparison", "rmse", kpss_pvalue(F.col("kpss")).alias("kpss_pvalue"), "adf_pvalue"
    ).orderBy(F.asc_nulls_last("adf_pvalue"), F.desc_nulls_last("kpss_pvalue"), "rmse")


def welch_ttest(series: DataFrame, dimension: Sequence[str] = (), pvalues: bool = True) -> DataFrame:
    """Welch test of test against control per comparison.

    t, df and the confidence interval are for test minus control, the differences for control
    against test. A missing value counts on neither its own side's n nor its variance; ``n`` is
    the number of days. With a single value on a side t, interval and p are -99.
    """
    pairs = pair_days(series, dimension=dimension).withColumns({"comparison": _comparison(), "pair_logic": _logic()})
    keys = ["comparison", "pair_logic", *dimension]
    stats = pairs.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count("x_value").alias("nx"), F.count("y_value").alias("ny"),
        F.avg("x_value").alias("mx"), F.avg("y_value").alias("my"),
        F.var_samp("x_value").alias("vx"), F.var_samp("y_value").alias("vy"),
        mean_if_all_defined(safe_ratio(F.col("x_value"), F.col("y_value"))).alias("ratio"),
        F.avg(F.col("x_value") - F.col("y_value")).alias("mean_abs_diff"),
    )
    ex, ey, single = safe_ratio(F.col("vx"), F.col("nx")), safe_ratio(F.col("vy"), F.col("ny")), F.least("nx", "ny") == 1
    freedom = safe_ratio(F.pow(ex + ey, 2), safe_ratio(ex * ex, F.col("nx") - 1) + safe_ratio(ey * ey, F.col("ny") - 1))
    stats = stats.withColumns({"se": F.sqrt(ex + ey), "df": F.when(~single, freedom)})
    stats = stats.withColumn("t", safe_ratio(F.col("my") - F.col("mx"), F.col("se")))

    def unless_single(value: Column) -> Column:
        return F.when(single, F.lit(SINGLE_DAY)).otherwise(value)

    columns = [
        *keys[2:], "comparison", F.col("pair_logic").alias("logic"), "n",
        unless_single(F.col("t")).alias("t_stat"), unless_single(F.col("df")).alias("df"),
        ((F.col("ratio") - 1) * 100).alias("relative_diff"), "mean_abs_diff",
    ]
    if pvalues:
        half = t_critical("df") * F.col("se")
        columns += [
            unless_single(F.col("my") - F.col("mx") - half).alias("ci_from"),
            unless_single(F.col("my") - F.col("mx") + half).alias("ci_to"),
            unless_single(t_pvalue("t", "df")).alias("p_value"),
        ]
    result = stats.select(*columns)
    if pvalues:
        result = result.withColumn("significant", (F.col("p_value") >= 0) & (F.col("p_value") < 0.05))
    return result.orderBy("logic", "comparison")


def did(series: DataFrame, pvalues: bool = True) -> DataFrame:
    """Difference in differences per comparison: the interaction of treatment and period.

    Least squares with two binary factors and their interaction fits the four cell means, so
    the estimate and its error follow from counts, means and squared deviations of the cells.
    Missing values do not count. A comparison without values in one of the cells has NULL estimates.
    """
    pairs = pair_days(series).withColumn("comparison", _logic())

    def side(prefix: str, treat: int) -> Column:
        before = F.col(f"{prefix}_group").contains("pre")
        return F.struct(
            F.lit(treat).alias("treat"), F.when(before, 0).otherwise(1).alias("after"),
            F.col(f"{prefix}_value").alias("value"),
        )

    rows = pairs.select("comparison", F.inline(F.array(side("x", 0), side("y", 1))))
    cells = rows.groupBy("comparison", "treat", "after").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("ss")
    )
    sign = F.when(F.col("treat") == F.col("after"), 1).otherwise(-1)
    total = cells.groupBy("comparison").agg(
        F.count("mean").alias("cells"), F.sum("n").alias("n"), F.sum(sign * F.col("mean")).alias("estimate"),
        F.sum("ss").alias("sse"), F.sum(F.when(F.col("n") > 0, 1 / F.col("n"))).alias("inverse"),
    )
    whole = F.col("cells") == 4
    total = total.withColumns({"estimate": F.when(whole, F.col("estimate")), "sse": F.when(whole, F.col("sse"))})
    df = F.when(whole, F.col("n") - 4)
    fitted = total.select(
        "comparison", "estimate", F.sqrt(safe_ratio(F.col("sse"), df) * F.col("inverse")).alias("std_error"), df.alias("df")
    ).withColumn("t_value", safe_ratio(F.col("estimate"), F.col("std_error")))
    if not pvalues:
        return fitted
    return fitted.withColumn("p_value", t_pvalue("t_value", "df")).withColumn(
        "significant", F.col("p_value") < 0.05
    )


def counterfactual_effect(series: DataFrame, season_days: int | None = None, level: float = 0.95) -> DataFrame:
    """Effect per day after the start: test minus what control predicts for it, with its bounds.

    Test is regressed on control over the pre days and predicted for the post days.
    ``season_days`` (7 for weeks) takes out the pre-period mean of each day of the cycle first,
    or the mean of the whole pre period where that day of the cycle has none.
    Window bounds come from the dates of groups named pre and post.

    Bounds hold with probability ``level`` if days vary around the regression independently and
    alike. A predicted day varies by the day itself, by the estimated mean of its day of the cycle
    and by the estimated slope; a sum of days by all of these, where errors of means and slope are
    shared between days. ``p_value`` is two-sided, for no effect over the days up to this one.
    Days without a value on either side are not used; a post day without one has no effect and
    leaves the sums as they were; ``days`` counts those with one. With too few pre days for a residual, bounds and p are NULL.
    """
    pairs = pair_days(series).withColumn("comparison", _comparison())
    period = F.when(F.col("y_group").contains("pre"), "pre").when(F.col("y_group").contains("post"), "post")
    daily = pairs.withColumn("period", period).where(F.col("period").isNotNull())
    season = F.pmod(F.datediff("date", F.lit("1970-01-01").cast("date")), F.lit(season_days or 1))
    daily = daily.withColumn("season", season)

    keys = ["comparison", "season"]
    pre = daily.where((F.col("period") == "pre") & F.col("x_value").isNotNull() & F.col("y_value").isNotNull())
    means = pre.groupBy(*keys).agg(F.avg("x_value").alias("base_x"), F.avg("y_value").alias("base_y"), F.count("*").alias("base_n"))
    overall = pre.groupBy("comparison").agg(
        F.avg("x_value").alias("mean_x"), F.avg("y_value").alias("mean_y"), F.count("*").alias("n"), F.count_distinct("season").alias("seasons")
    )

    def level_of(rows: DataFrame) -> DataFrame:
        based = rows.join(means, keys, "left").join(overall, "comparison").withColumns({
            "base_x": F.coalesce("base_x", "mean_x"), "base_y": F.coalesce("base_y", "mean_y"), "base_n": F.coalesce("base_n", "n"),
        })
        return based.withColumns({"dx": F.col("x_value") - F.col("base_x"), "dy": F.col("y_value") - F.col("base_y")})

    sums = level_of(pre).groupBy("comparison").agg(
        F.sum(F.col("dx") * F.col("dx")).alias("xx"), F.sum(F.col("dx") * F.col("dy")).alias("xy"), F.sum(F.col("dy") * F.col("dy")).alias("yy"),
        F.first("n").alias("n"), F.first("seasons").alias("seasons"),
    )
    slope = F.coalesce(safe_ratio(F.col("xy"), F.col("xx")), F.lit(0.0))
    df = F.col("n") - F.col("seasons") - F.when(F.col("xx") > 0, 1).otherwise(0)
    fit = sums.withColumns({"slope": slope, "df": F.when(df > 0, df)})
    fit = fit.withColumn("error", F.sqrt(F.greatest(F.col("yy") - F.col("slope") * F.col("xy"), F.lit(0.0)) / F.col("df")))
    fit = fit.select("comparison", "slope", "xx", "df", "error", t_critical("df", level).alias("reach"))
    post = level_of(daily.where(F.col("period") == "post")).join(fit, "comparison")
    predicted = F.col("base_y") + F.col("slope") * F.col("dx")
    # A comparison has one row per day and pair of groups: bounded windows.
    order = Window.partitionBy("comparison").orderBy("date", "x_group", "y_group")
    in_season = Window.partitionBy("comparison", "season").orderBy("date", "x_group", "y_group")
    rows = post.withColumn("predicted", predicted).withColumn("effect", F.col("y_value") - F.col("predicted"))
    known = F.col("effect").isNotNull()
    # T days of a cycle day with n pre days add T^2 / n to the variance of a sum, the T-th of them (2 T - 1) / n.
    rows = rows.withColumn("shared", F.when(known, (2 * F.sum(known.cast("int")).over(in_season) - 1) / F.col("base_n")))
    lean = F.coalesce(safe_ratio(F.pow("dx", F.lit(2)), F.col("xx")), F.lit(0.0))
    rows = rows.withColumns({
        "cumulative_effect": F.sum("effect").over(order), "days": F.sum(known.cast("int")).over(order),
        "cumulative_shared": F.sum("shared").over(order), "cumulative_dx": F.sum(F.when(known, F.col("dx"))).over(order),
    })
    cumulative_lean = F.coalesce(safe_ratio(F.pow("cumulative_dx", F.lit(2)), F.col("xx")), F.lit(0.0))
    rows = rows.withColumns({
        "half": F.col("reach") * F.col("error") * F.sqrt(1 + 1 / F.col("base_n") + lean),
        "cumulative_error": F.col("error") * F.sqrt(F.col("days") + F.col("cumulative_shared") + cumulative_lean),
    })
    rows = rows.withColumns({
        "cumulative_half": F.col("reach") * F.col("cumulative_error"), "t": safe_ratio(F.col("cumulative_effect"), F.col("cumulative_error")),
    })
    bounds = [(F.col(c) + sign * F.col(h)).alias(f"{c}_{end}") for c, h in
              (("predicted", "half"), ("effect", "half"), ("cumulative_effect", "cumulative_half")) for end, sign in (("low", -1), ("high", 1))]
    return rows.select(
        "comparison", "date", "days", F.col("y_value").alias("actual"), "predicted", "effect", "cumulative_effect", *bounds,
        t_pvalue("t", "df").alias("p_value"),
    )


def counterfactual_summary(effects: DataFrame, level: float = 0.95) -> DataFrame:
    """One row per comparison of ``counterfactual_effect`` (of the same ``level``): the whole time after the start.

    Means per day of actual and predicted values, the effect as their difference, in total and in
    percent of the prediction, each with bounds, and the p-value of no effect.
    """
    names = ["cumulative_effect", "cumulative_effect_low", "cumulative_effect_high"]
    known = effects.where(F.col("effect").isNotNull())
    total = known.groupBy("comparison").agg(
        F.count("*").alias("days"), F.avg("actual").alias("actual"), F.avg("predicted").alias("predicted"),
        F.max_by(F.struct(*names, "p_value"), "days").alias("last"),
    )
    parts = {"effect": names[0], "effect_low": names[1], "effect_high": names[2]}
    return total.select(
        "comparison", "days", "actual", "predicted",
        *[(F.col("last")[c] / F.col("days")).alias(f"average_{n}") for n, c in parts.items()],
        *[F.col("last")[c].alias(c) for c in names],
        *[(100 * safe_ratio(F.col("last")[c] / F.col("days"), F.col("predicted"))).alias(f"relative_{n}") for n, c in parts.items()],
        F.col("last.p_value").alias("p_value"), (F.col("last.p_value") < 1 - level).alias("significant"),
    )


def reldiff_descriptives(series: DataFrame) -> DataFrame:
    """Mean ratio of control to test per comparison, in percent."""
    pairs = pair_days(series).select(
        _logic().alias("logic"), _comparison().alias("comparison"),
        safe_ratio(F.col("x_value"), F.col("y_value")).alias("ratio"),
    )
    return pairs.groupBy("logic", "comparison").agg((mean_if_all_defined(F.col("ratio")) * 100).alias("rel_diff")).orderBy(
        "logic", "comparison"
    )


def abs_diff_descriptives(series: DataFrame) -> DataFrame:
    """Mean of test minus mean of control per comparison, times 100."""
    pairs = pair_days(series).select(_logic().alias("logic"), _comparison().alias("comparison"), "x_value", "y_value")
    difference = (F.avg("y_value") - F.avg("x_value")) * 100
    return pairs.groupBy("logic", "comparison").agg(difference.alias("absolute_difference")).orderBy("logic", "comparison")
