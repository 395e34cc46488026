"""Batch jobs: each runs one experiment method and writes one named table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from splitlab.operators.bootstrap import DEFAULT_WEIGHTS
from splitlab.plans.experiment import Experiment
from splitlab.sources.tables import replace_table, table_name

VERSIONS = {1: "", 2: "_v2", 3: "_v3"}


def _write(df: DataFrame, name: str, database: str | None) -> str:
    full = f"{database}.{name}" if database else name
    replace_table(df, full)
    return full


def smart_salt_job(experiment: Experiment) -> tuple[str, float]:
    return experiment.get_smart_salt()


def bootstrap_job(
    experiment: Experiment, account: str, exp_weights: Sequence[int] = DEFAULT_WEIGHTS, database: str | None = None
) -> str:
    config = experiment.config
    name = table_name(account, "bootstrapping", config.run_date, "nsalt", config.ntrials)
    return _write(experiment.get_bootstrapped(exp_weights), name, database)


def smart_salt_table_job(
    experiment: Experiment, account: str, group_size: str, version: int = 1, database: str | None = None
) -> str:
    config = experiment.config
    kind = f"smart_salt_table{VERSIONS[version]}"
    name = table_name(account, kind, config.run_date, "ntrials", config.ntrials, "group_size", group_size)
    return _write(experiment.get_smart_salt_table(version), name, database)


def bootstrapped_smart_salt_job(
    experiment: Experiment, account: str, source_table: str, group_size: str, number_of_salts: int = 10,
    version: int = 1, exp_weights: Sequence[int] = DEFAULT_WEIGHTS, database: str | None = None,
) -> str:
    """Versions differ in the name only; that of version 2 ends with the period."""
    config = experiment.config
    period = ["period", config.period] if version == 2 else []
    kind = f"smart_salt_bootstrapping{VERSIONS[version]}"
    name = table_name(account, kind, config.run_date, group_size, "salt_numbers", number_of_salts, *period)
    stored = experiment.get_bootstrapped_smart_salt_performance(exp_weights, source_table, number_of_salts)
    return _write(stored, name, database)


def random_salt_perf_job(experiment: Experiment, account: str, group_size: str, database: str | None = None) -> str:
    config = experiment.config
    name = table_name(account, "random_salt_perf", config.run_date, "ntrials", config.ntrials, "group_size", group_size)
    return _write(experiment.get_random_salt_performance(), name, database)


def smart_salt_perf_job(
    experiment: Experiment, account: str, source_table: str, number_of_salts: int = 100, database: str | None = None
) -> str:
    name = table_name(account, "smart_salt_perf", experiment.config.run_date)
    return _write(experiment.get_smart_salt_performance(source_table, number_of_salts), name, database)
