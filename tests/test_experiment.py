import datetime as dt

import pytest
from pyspark.sql import functions as F

from splitlab.operators import accounts
from splitlab.plans import jobs
from splitlab.plans.config import SplitConfig
from splitlab.plans.experiment import Experiment, Metric
from splitlab.sources.tables import export_csv, latest_table, replace_table, table_name
from test_accounts import performance
from test_groups import unit_days

M = ["m1", "m2"]
START_DAY = dt.date(2024, 1, 3)


@pytest.fixture(scope="module")
def experiment(spark):
    _, df = unit_days(spark, units=50, days=14, seed=2)
    config = SplitConfig("2024-01-15", [2, 3, 5], 2, [0, 1], [1] * 10, 14, "B", 60)
    return Experiment(config, df, M, "unit_id", "day", batch_size=20, min_salts=2)


def test_smart_salt_is_in_the_loss_report(experiment):
    salt, percent = experiment.get_smart_salt()
    losses = {r.salt: r.pae for r in experiment.get_random_salt_performance().collect()}
    assert len(losses) == 60 and losses[salt] * 100 == pytest.approx(percent)


def test_jobs_write_named_tables(spark, experiment):
    stored = jobs.smart_salt_table_job(experiment, "acct", "25percent", version=3)
    assert stored == "acct_smart_salt_table_v3_20240115_ntrials_60_group_size_25percent"
    assert spark.table(stored).columns == ["salt", "pae", "index", "stat_result"]
    random = jobs.random_salt_perf_job(experiment, "acct", "25percent")
    assert random == "acct_random_salt_perf_20240115_ntrials_60_group_size_25percent"
    boot = jobs.bootstrap_job(experiment, "acct", [1] * 20)
    assert boot == "acct_bootstrapping_20240115_nsalt_60"
    assert spark.table(boot).columns == ["salt", "paired_groups", "num_days", "num_groups", "rdiff_m1", "rdiff_m2"]
    smart = jobs.bootstrapped_smart_salt_job(experiment, "acct", random, "25percent", 4, version=2, exp_weights=[1] * 10)
    assert smart == "acct_smart_salt_bootstrapping_v2_20240115_25percent_salt_numbers_4_period_14"
    rows = spark.table(smart)
    assert rows.count() == 4 * 3 * 2 and rows.select("salt").distinct().count() == 4
    perf = jobs.smart_salt_perf_job(experiment, "acct", random, 4)
    best = [r.salt for r in spark.table(random).orderBy("pae", "salt").limit(4).collect()]
    assert perf == "acct_smart_salt_perf_20240115"
    assert [r.salt for r in spark.table(perf).orderBy("pae", "salt").collect()] == best
    assert latest_table(spark, "acct_bootstrapping_*") == boot


def test_versions_give_tables(experiment):
    assert experiment.get_smart_salt_table_v2().columns == experiment.get_smart_salt_table().columns


def test_account_experiment_reads_the_report_once(spark):
    rows = [
        (u, d, "US", 1, 1.0 + u % 3, 1, 5.0 + u % 7, 6.0, 2.0, 1)
        for u in range(40) for d in [r.d for r in spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-14')) AS d").collect()]
    ]
    config = SplitConfig("2024-01-15", [5, 5], 1, 0, [1] * 10, 14, "B", 8, pos="US")
    experiment = Experiment.from_account(
        config, accounts.SimpleAccount, performance_table=performance(spark, rows), max_rpb=100.0
    )
    losses = experiment.get_random_salt_performance().collect()
    assert len(losses) == 8 and all(r.pae is not None for r in losses)


def test_metrics_with_and_without_adjustment(spark):
    _, df = unit_days(spark, units=20, days=21, seed=6)
    config = SplitConfig("2024-01-22", [1, 1], 1, 0, [1, 1], 14, "B", 5)

    def compute(start, end):
        return df.where(F.col("day").between(F.lit(start), F.lit(end)))

    metrics = [Metric("m1", compute), Metric("m2", compute, cuped_weeks=1)]
    experiment = Experiment.from_metrics(config, metrics, "unit_id", "day")
    plain = Experiment.from_metrics(config, [Metric("m1", compute), Metric("m2", compute)], "unit_id", "day")
    adjusted = {(r.unit_id, r.day): (r.m1, r.m2) for r in experiment.unit_days.collect()}
    raw = {(r.unit_id, r.day): (r.m1, r.m2) for r in plain.unit_days.collect()}
    assert adjusted.keys() == raw.keys()
    assert all(adjusted[k][0] == raw[k][0] for k in raw) and any(adjusted[k][1] != raw[k][1] for k in raw)


def test_tables_are_replaced_and_exported(spark, tmp_path):
    for n in (3, 2):
        replace_table(spark.range(n).toDF("v"), "replaced_once")
    assert spark.table("replaced_once").count() == 2
    export_csv(spark.range(4).toDF("v"), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 4
    assert table_name("a", "kind", "2019-03-01", "nsalt", 5) == "a_kind_20190301_nsalt_5"
    with pytest.raises(LookupError):
        latest_table(spark, "no_such_table_*")


def test_a_failed_write_leaves_the_old_table(spark):
    replace_table(spark.range(5).toDF("v"), "kept_on_failure")
    broken = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("bigint")).alias("v"))
    with pytest.raises(Exception, match="no"):
        replace_table(broken, "kept_on_failure")
    assert spark.table("kept_on_failure").count() == 5
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_on_failure")] == ["kept_on_failure"]


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark):
    replace_table(spark.range(6).selectExpr("id AS v", "id % 2 AS part"), "replaced_by_itself", ["part"])
    replace_table(spark.table("replaced_by_itself").where("v > 3"), "replaced_by_itself")
    assert sorted(r.v for r in spark.table("replaced_by_itself").collect()) == [4, 5]


def test_account_weights_fill_in(spark):
    rows = [(u, START_DAY, "US", 1, 1.0, 1, 5.0, 6.0, 2.0, 1) for u in range(4)]
    config = SplitConfig("2024-01-15", [10, 10], 1, 0, period=14, ntrials=2, pos="US")
    experiment = Experiment.from_account(
        config, accounts.SimpleAccount, walk={"cumulative": True, "test_remainder": False, "batch_size": 2}, performance_table=performance(spark, rows)
    )
    assert experiment.config.exp_weights == [1] * 20 and experiment.config.slots == [0] * 10 + [1] * 10
    assert experiment.cumulative and not experiment.test_remainder and experiment.batch_size == 2
    with pytest.raises(ValueError, match="weights"):  # this account leaves them to the caller
        Experiment(SplitConfig("2024-01-15", [10, 10], 1, 0), performance(spark, rows), ["clicks"])


def test_walk_options_reach_the_table(spark):
    _, df = unit_days(spark, units=50, days=14, seed=2)
    config = SplitConfig("2024-01-15", [2, 3, 5], 2, [0, 1], [1] * 10, 14, "B", 50)

    def table(**options):
        return {r["index"] for r in Experiment(config, df, M, "unit_id", "day", batch_size=20, **options).get_smart_salt_table().collect()}

    passing = table(min_salts=10**6)
    assert passing and table(min_salts=10**6, test_remainder=False) == {i for i in passing if i < 40}
    firsts = sorted(passing)
    needed = sum(i < 20 for i in firsts) + 1
    if len(firsts) >= needed:
        last = firsts[needed - 1] // 20
        assert table(min_salts=needed, cumulative=True) == {i for i in firsts if i // 20 <= last}
