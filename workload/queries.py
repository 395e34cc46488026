"""The registered queries: each runs one operator over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlab.functions import labels
from splitlab.functions.dates import calendar
from splitlab.functions.hashing import salt_text
from splitlab.operators import accounts, analysis, bootstrap, cuped, loss, metrics, select, stationarity
from splitlab.operators.groups import assign_units, group_days, group_rows
from splitlab.plans.config import SplitConfig
from splitlab.plans.session import materialize
from splitlab.sources.salts import SaltSet, generate_salts, loss_order, top_salts
from workload.views import CAP, END, EXPERIMENT_START, PARTNERS, PERIOD, RUN_DATE, START, load, view

Query = Callable[[SparkSession, str], DataFrame]

M = ["m1", "m2"]
GROUPS, CONTROL, TEST, WEIGHTS = [2, 3, 5], 2, [0, 1], [1] * 10
# Candidate salts: several blocks of them, and a walk whose last batch is not full. A salt has 7,260
# rows of pairs a month, so that query has fewer salts.
TRIALS, PAIR_TRIALS, WALK_TRIALS, TOP = 200, 24, 1200, 50
DASHBOARD_SALT = "X0116"


def config(ntrials: int = TRIALS, run_date: str = RUN_DATE, period: int = PERIOD) -> SplitConfig:
    return SplitConfig(run_date, GROUPS, CONTROL, TEST, WEIGHTS, period, "B", ntrials)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """m1 = number of events, m2 = their value, by user and day; a row per event."""
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("unit_id"), F.to_date("ts").alias("day"), F.lit(1).alias("m1"), F.col("value").alias("m2")
    )


def unit_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of ``events`` per user and day."""
    return metrics.unit_day_metrics([events(spark, sf_dir)], M)


def series_of(rows: DataFrame, cfg: SplitConfig) -> metrics.UnitSeries:
    """One row per unit, from events or unit-days, counted so that tasks are sized by it."""
    return metrics.prepared(metrics.unit_series(metrics.unit_day_metrics([rows], M), M, cfg.start_date, cfg.period))


def salts(spark: SparkSession, cfg: SplitConfig) -> SaltSet:
    return generate_salts(spark, cfg.base_salt, cfg.run_date, cfg.ntrials)


def losses(days: DataFrame, cfg: SplitConfig, version: int = 1) -> DataFrame:
    candidates = salts(days.sparkSession, cfg)
    grouped = loss.salt_days(series_of(days, cfg), candidates, cfg)
    return loss.salt_loss(grouped, candidates, cfg, M, version)


def stored_salts(days: DataFrame, n: int = TOP) -> SaltSet:
    """The best salts of the first half of the data, as a stored table would hold them."""
    before = config(run_date=EXPERIMENT_START, period=15)
    return top_salts(materialize(losses(days, before).select("salt", "pae")), n)


# Digits kept: amounts are summed in any order, ratios are close to 1.
AMOUNT, RATIO, DENSITY = 6, 9, 5


def rounded(df: DataFrame, digits: int = AMOUNT) -> DataFrame:
    """Doubles rounded, without negative zeros.

    Quotients of amounts often end in an exact 5 one digit further on, where the last bit of a sum
    would decide; the nudge moves such ties off the boundary.
    """
    nudge = F.lit(3 * 10.0 ** -(digits + 2))
    doubles = {c for c, t in df.dtypes if t == "double"}
    return df.select(*[
        (F.round(F.col(c) + nudge, digits) + F.lit(0.0)).alias(c) if c in doubles else F.col(c) for c in df.columns
    ])


# Salts, calendars, assignment, metrics.


def salt_table(spark, sf_dir):
    """Salts of every day as run date, as many as there are active users on the day."""
    days = load(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("run_date")).agg(
        F.count_distinct("user_id").alias("ntrials")
    )
    trial = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("ntrials") - 1))
    rows = days.withColumn("trial", trial)
    return rows.select("run_date", "trial", salt_text(F.lit("B"), F.col("run_date"), F.col("trial"), F.col("ntrials")).alias("salt"))


def calendar_days(spark, sf_dir):
    """Every calendar day between the first and the last event of each user."""
    bounds = load(spark, sf_dir, "events").groupBy(F.col("user_id").alias("unit_id")).agg(
        F.to_date(F.min("ts")).alias("first_day"), F.to_date(F.max("ts")).alias("last_day")
    )
    return calendar(bounds, "first_day", "last_day").select("unit_id", "day")


def assign_groups(spark, sf_dir):
    users = load(spark, sf_dir, "events").select(F.col("user_id").alias("unit_id")).distinct()
    return assign_units(users, salts(spark, config()), [2, 3, 5]).select("unit_id", "salt", "bucket")


def unit_day_metrics(spark, sf_dir):
    """Two metrics from different sources: bookings and click cost."""
    ev = view(spark, sf_dir, "ev").select(F.col("user_id").alias("unit_id"), "day", "event_type", "value")
    booked = ev.where(F.col("event_type") == "purchase").select("unit_id", "day", F.lit(1).alias("bookings"))
    clicked = ev.where(F.col("event_type").isin("click", "view")).select("unit_id", "day", (F.col("value") / 10).alias("cost"))
    return rounded(metrics.unit_day_metrics([booked, clicked], ["bookings", "cost"]))


# Losses.


def salt_loss(version: int) -> Query:
    def run(spark, sf_dir):
        return rounded(losses(events(spark, sf_dir), config(), version).select("salt", "pae"), RATIO)

    return run


def random_salt_perf(spark, sf_dir):
    cfg = config()
    return rounded(select.loss_report(series_of(events(spark, sf_dir), cfg), salts(spark, cfg), cfg, M), RATIO)


def stored_salts_top_n(spark, sf_dir):
    return rounded(stored_salts(events(spark, sf_dir)).df, RATIO)


def smart_salt_perf(spark, sf_dir):
    cfg, days = config(), materialize(unit_days(spark, sf_dir))
    return rounded(select.loss_report(series_of(days, cfg), stored_salts(days), cfg, M), RATIO)


# Bootstrap.


def rdiffs(days: DataFrame, candidates: SaltSet | None = None, **options) -> DataFrame:
    cfg = config()
    return bootstrap.bootstrap_rdiff(series_of(days, cfg), candidates or salts(days.sparkSession, cfg), PERIOD, **options)


def bootstrap_pairs(spark, sf_dir):
    cfg = config(PAIR_TRIALS)
    days = bootstrap.scheme_days(series_of(events(spark, sf_dir), cfg), salts(spark, cfg))
    return rounded(bootstrap.paired_days(days, M).drop("scheme"), RATIO)


def bootstrap_rdiff(spark, sf_dir):
    return rounded(rdiffs(events(spark, sf_dir)).drop("salt_id"), RATIO)


def bootstrap_smart_salts(spark, sf_dir):
    days = materialize(unit_days(spark, sf_dir))
    return rounded(rdiffs(days, stored_salts(days), weights=WEIGHTS, schemes=[GROUPS]).drop("salt_id"), RATIO)


def bootstrap_ci(spark, sf_dir):
    table = materialize(rdiffs(events(spark, sf_dir), pair=(0, 1)))
    return rounded(bootstrap.bootstrap_ci(table, M, digits=None), RATIO)


def bootstrap_ci_trimmed(spark, sf_dir):
    """All pairs of groups, without relative differences of 5 and more."""
    table = materialize(rdiffs(events(spark, sf_dir)))
    return rounded(bootstrap.bootstrap_ci(table, M, pair=None, cut_on="m2", cut=5.0, digits=None), RATIO)


def ci_comparison(spark, sf_dir):
    """Intervals of random salts beside those of stored salts with the lowest loss."""
    days = materialize(unit_days(spark, sf_dir))
    variants = {"random": salts(spark, config()), "smart": stored_salts(days)}
    tables = {
        name: bootstrap.bootstrap_ci(materialize(rdiffs(days, candidates, pair=(0, 1))), M, digits=None)
        for name, candidates in variants.items()
    }
    return rounded(bootstrap.compare_ci(tables, M), RATIO)


def bootstrap_density(spark, sf_dir):
    halves = materialize(rdiffs(events(spark, sf_dir), schemes=[[10, 10]]))
    # Bins fine enough for the digits kept.
    return rounded(bootstrap.bootstrap_density(halves, "m2", bins_per_bandwidth=100_000), DENSITY)


# Stationarity and selection.


def series(spark, sf_dir, cfg: SplitConfig | None = None) -> DataFrame:
    cfg = cfg or config()
    candidates = salts(spark, cfg)
    named = stationarity.ratio_series(loss.salt_days(series_of(events(spark, sf_dir), cfg), candidates, cfg), cfg, M)
    return named.join(F.broadcast(candidates.df), "salt_id").drop("salt_id")


def kpss_stat(spark, sf_dir):
    return rounded(stationarity.kpss_stats(series(spark, sf_dir)).drop("series"))


def df_stat_lag0(spark, sf_dir):
    return rounded(stationarity.dickey_fuller_stats(series(spark, sf_dir)).drop("series"))


def adf_aic(spark, sf_dir):
    return rounded(stationarity.adf_stats(series(spark, sf_dir)).drop("series"))


def salt_stationarity(spark, sf_dir):
    cfg = config()
    candidates = salts(spark, cfg)
    days = loss.salt_days(series_of(events(spark, sf_dir), cfg), candidates, cfg)
    tested = stationarity.stationarity(days, cfg, M)
    return candidates.df.join(F.broadcast(tested), "salt_id", "left").drop("salt_id")


def walk(spark, sf_dir, version: int = 1) -> select.SaltWalk:
    cfg = config(WALK_TRIALS)
    return select.SaltWalk(series_of(events(spark, sf_dir), cfg), salts(spark, cfg), cfg, version)


def smart_salt(spark, sf_dir):
    return rounded(select.smart_salt(walk(spark, sf_dir)).drop("salt_id"))


def smart_salt_table(version: int) -> Query:
    def run(spark, sf_dir):
        return rounded(select.smart_salt_table(walk(spark, sf_dir, version)).drop("salt_id"))

    return run


# Account reports.

SOURCES = {
    "two_sided": {
        "web_costs_table": "web_cost", "mobile_costs_table": "mobile_cost", "reservation_table": "reservation",
        "affiliate_table": "affiliate", "nits_score_table": "score", "nits_postbook_table": "postbook",
    },
    "placement": {
        "costs_table": "click_cost", "reservation_table": "reservation", "affiliate_table": "affiliate",
        "nits_score_table": "score", "nits_postbook_table": "postbook",
    },
    "simple": {"performance_table": "performance", "reservation_table": "reservation", "affiliate_table": "flat_affiliate"},
    "campaign": {
        "booking_report": "report", "stats_report": "report", "campaign_table": "campaign", "country_campaigns": "country",
        "device_classes": "device_class", "reservation_table": "reservation", "affiliate_table": "affiliate",
    },
}
KINDS = {
    "two_sided": accounts.TwoSidedAccount, "placement": accounts.PlacementAccount,
    "simple": accounts.SimpleAccount, "campaign": accounts.CampaignAccount,
}


def account(spark, sf_dir, kind: str, **options) -> accounts.Account:
    sources = {arg: view(spark, sf_dir, name) for arg, name in SOURCES[kind].items()}
    return KINDS[kind](START, END, max_rpb=CAP, partner_id=PARTNERS[kind], **sources, **options)


def report(kind: str, method: str, **options) -> Query:
    def run(spark, sf_dir):
        return rounded(getattr(account(spark, sf_dir, kind, **options), method)())

    return run


def reservations_clean(spark, sf_dir):
    """Valid reservations of the two-sided account with unit, locale and device."""
    a = account(spark, sf_dir, "two_sided")
    return a.bookings(labels.NAME_CORE, True, {
        "locale": labels.locale_of(F.col("label")), "device": labels.device_of(F.col("label"), F.col("affiliate_name")),
    })


def nits_adjusted_revenue(spark, sf_dir):
    a = account(spark, sf_dir, "two_sided")
    measures = ["gross_bookings", "gross_commission", "nits_bookings", "nits_commission", "roomnights"]
    return rounded(accounts.grouped_sums(a.revenue_rows(), a.dimensions, measures))


def clicks_union_devices(spark, sf_dir):
    a = account(spark, sf_dir, "two_sided")
    return rounded(accounts.grouped_sums(a.click_rows(), a.dimensions, ["clicks", "cost"]))


def click_cost_by_placement(spark, sf_dir):
    rows = account(spark, sf_dir, "placement").click_rows()
    keys = [accounts.UNIT, "distribution", "placement", accounts.DAY]
    return rounded(accounts.grouped_sums(rows, keys, ["clicks", "cost", "length_of_stay"]))


def cancellations_labelled(spark, sf_dir):
    rows = account(spark, sf_dir, "campaign").labelled_cancellations()
    return rows.select("id", accounts.DAY, accounts.UNIT, "campaign_id", "cancelled_commission", "cancelled_roomnights")


def label_fields(spark, sf_dir):
    """Entries of the label map of every reservation."""
    rows = view(spark, sf_dir, "reservation").select("id", labels.label_map(F.col("label")).alias("info"))
    return rows.select("id", *[F.element_at("info", k).alias(k) for k in ("cid", "ucc", "placement", "hotel_id")])


def affiliate_fields(spark, sf_dir):
    """Reservations per country, placement and device of the affiliate's name."""
    name = F.col("name")
    rows = view(spark, sf_dir, "reservation").join(view(spark, sf_dir, "affiliate").withColumnRenamed("id", "affiliate_id"), "affiliate_id")
    parts = [labels.affiliate_info(name, kind).alias(kind) for kind in ("cc", "placement", "device")]
    return rows.groupBy(*parts).agg(F.count("*").alias("n"))


# Reading an experiment.


def dashboard(spark, sf_dir, numbered: bool) -> DataFrame:
    """Daily value per unit of two control and two test groups, before and after the start.

    A row per day and group, stored once: the analyses read it several times.
    """
    cfg = config()
    one_salt = SaltSet(spark.range(1).select(F.col("id").alias("salt_id"), F.lit(DASHBOARD_SALT).alias("salt")), 1)
    days = group_rows(group_days(series_of(events(spark, sf_dir), cfg), one_salt, [0, 1, 2, 3]), range(4), M)
    role = F.when(F.col("grp") % 2 == 0, "control").otherwise("test")
    number = (F.floor(F.col("grp") / 2) + 1).cast("int")
    phase = F.when(F.col("day") < EXPERIMENT_START, "pre").otherwise("post")
    part = F.when(F.dayofweek("day").isin(1, 7), "weekend").otherwise("week")
    return materialize(days.select(
        F.col("day").alias("date"),
        F.concat_ws("-", role, number.cast("string"), phase).alias("group"),
        (number if numbered else F.lit(None).cast("int")).alias("group_num"),
        F.concat(role, number.cast("string")).alias("logic"),
        role.alias("test_control_group"),
        part.alias("part"), phase.alias("phase"),
        (F.col("m2") / F.col("n_units")).alias("value"),
    ))


def before_start(df: DataFrame) -> DataFrame:
    return df.where(F.col("phase") == "pre")


def pre_rmse(spark, sf_dir):
    return rounded(analysis.pre_rmse(before_start(dashboard(spark, sf_dir, True))))


def pre_stationarity(spark, sf_dir):
    return rounded(analysis.pre_stationarity(before_start(dashboard(spark, sf_dir, False))))


def welch_ttest(spark, sf_dir):
    return rounded(analysis.welch_ttest(dashboard(spark, sf_dir, False), pvalues=False))


def welch_by_dimension(spark, sf_dir):
    return rounded(analysis.welch_ttest(dashboard(spark, sf_dir, True), ["part"], pvalues=False))


def welch_pvalue(spark, sf_dir):
    return rounded(analysis.welch_ttest(dashboard(spark, sf_dir, True)))


def did(spark, sf_dir):
    return rounded(analysis.did(dashboard(spark, sf_dir, False), pvalues=False))


def did_pvalue(spark, sf_dir):
    return rounded(analysis.did(dashboard(spark, sf_dir, True)))


def counterfactual_effect(season_days: int | None) -> Query:
    def run(spark, sf_dir):
        return rounded(analysis.counterfactual_effect(dashboard(spark, sf_dir, True), season_days))

    return run


def counterfactual_summary(spark, sf_dir):
    return rounded(analysis.counterfactual_summary(analysis.counterfactual_effect(dashboard(spark, sf_dir, True), 7)))


def reldiff_descriptives(spark, sf_dir):
    return rounded(analysis.reldiff_descriptives(dashboard(spark, sf_dir, False)))


def abs_diff_descriptives(spark, sf_dir):
    return rounded(analysis.abs_diff_descriptives(dashboard(spark, sf_dir, False)))


def cuped_adjusted(spark, sf_dir):
    """Two weeks after the start, adjusted by the two weeks before; two experiments."""
    days = materialize(unit_days(spark, sf_dir))
    name = F.concat(F.lit("exp"), (F.col("unit_id") % 2).cast("string")).alias("exp_name")

    def compute(start, end):
        window = days.where(F.col("day").between(F.lit(start), F.lit(end)))
        return window.groupBy(name, "unit_id").agg(F.sum("m1").alias("m1"), F.sum("m2").alias("m2"))

    return rounded(cuped.cuped_metrics(compute, EXPERIMENT_START, "2024-01-29", 2, M, ["exp_name", "unit_id"]))


def cuped_unit_level(spark, sf_dir):
    """Two experiments of different windows that share every third user; a theta for each."""
    days = materialize(unit_days(spark, sf_dir))
    units = days.select("unit_id").distinct()

    def listed(name: str, start: str, who: str) -> DataFrame:
        return units.where(who).select(F.lit(name).alias("exp_name"), "unit_id", F.lit(start).cast("date").alias("start_date"),
                                       F.lit("2024-01-29").cast("date").alias("end_date"))

    exposures = listed("exp0", EXPERIMENT_START, "unit_id % 2 = 0").union(listed("exp1", "2024-01-19", "unit_id % 2 = 1 OR unit_id % 3 = 0"))
    return rounded(cuped.cuped_by_unit(days, exposures, M, 2))


QUERIES: dict[str, Query] = {
    "salt_table": salt_table,
    "calendar_days": calendar_days,
    "assign_groups": assign_groups,
    "unit_day_metrics": unit_day_metrics,
    "salt_loss_v1": salt_loss(1),
    "salt_loss_v2": salt_loss(2),
    "salt_loss_v3": salt_loss(3),
    "random_salt_perf": random_salt_perf,
    "stored_salts_top_n": stored_salts_top_n,
    "smart_salt_perf": smart_salt_perf,
    "bootstrap_pairs": bootstrap_pairs,
    "bootstrap_rdiff": bootstrap_rdiff,
    "bootstrap_smart_salts": bootstrap_smart_salts,
    "bootstrap_ci": bootstrap_ci,
    "bootstrap_ci_trimmed": bootstrap_ci_trimmed,
    "ci_comparison": ci_comparison,
    "bootstrap_density": bootstrap_density,
    "kpss_stat": kpss_stat,
    "df_stat_lag0": df_stat_lag0,
    "adf_aic": adf_aic,
    "salt_stationarity": salt_stationarity,
    "smart_salt": smart_salt,
    "smart_salt_table_v1": smart_salt_table(1),
    "smart_salt_table_v2": smart_salt_table(2),
    "smart_salt_table_v3": smart_salt_table(3),
    "reservations_clean": reservations_clean,
    "nits_adjusted_revenue": nits_adjusted_revenue,
    "clicks_union_devices": clicks_union_devices,
    "click_cost_by_placement": click_cost_by_placement,
    "cost_revenue_outer": report("two_sided", "get_cost_and_revenue"),
    "perf_summary_two_sided": report("two_sided", "get_stats_summary"),
    "perf_summary_placement": report("placement", "get_stats_summary"),
    "perf_summary_simple": report("simple", "get_stats_summary"),
    "perf_pos_filtered": report("simple", "get_stats_summary", pos=["US", "GB", "US"]),
    "perf_summary_campaign": report("campaign", "get_stats_summary", pos=["US", "JP", "IT"]),
    "booking_summary_campaign": report("campaign", "get_booking_summary_extended"),
    "cancellations_labelled": cancellations_labelled,
    "cancellations_campaign": report("campaign", "get_cancellations"),
    "cancellations_agg": report("two_sided", "get_cancellations"),
    "cancellations_placement": report("placement", "get_cancellations", pos=["US"]),
    "cancellations_simple": report("simple", "get_cancellations", pos=["US", "DE"]),
    "agg_stats": report("two_sided", "get_agg_stats"),
    "agg_stats_placement": report("placement", "get_agg_stats"),
    "agg_stats_simple": report("simple", "get_agg_stats", null_as_zero=True),
    "agg_stats_campaign": report("campaign", "get_agg_stats"),
    "label_fields": label_fields,
    "affiliate_fields": affiliate_fields,
    "cuped_adjusted": cuped_adjusted,
    "cuped_unit_level": cuped_unit_level,
    "pre_rmse": pre_rmse,
    "pre_stationarity": pre_stationarity,
    "welch_ttest": welch_ttest,
    "welch_by_dimension": welch_by_dimension,
    "welch_pvalue": welch_pvalue,
    "did": did,
    "did_pvalue": did_pvalue,
    "counterfactual_effect": counterfactual_effect(None),
    "counterfactual_weekly": counterfactual_effect(7),
    "counterfactual_summary": counterfactual_summary,
    "reldiff_descriptives": reldiff_descriptives,
    "abs_diff_descriptives": abs_diff_descriptives,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate salts by loss, best first."""
    return losses(unit_days(spark, sf_dir), config(50)).select("salt", "pae").orderBy(*loss_order())
