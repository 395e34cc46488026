"""An experiment over one metric table: the entry points for designing it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.operators.accounts import DAY, UNIT, Account
from splitlab.operators.bootstrap import DEFAULT_SCHEMES, DEFAULT_WEIGHTS, bootstrap_rdiff
from splitlab.operators.cuped import cuped_metrics
from splitlab.operators.metrics import UnitSeries, prepared, unit_day_metrics, unit_series
from splitlab.operators.select import SaltWalk, loss_report, smart_salt, smart_salt_table
from splitlab.plans.config import SplitConfig
from splitlab.sources.salts import SaltSet, generate_salts, read_salts

PERCENT = 100


@dataclass(frozen=True)
class Metric:
    """A metric by name and the frame that holds it: ``compute(start, end)`` -> (unit, day, name).

    With ``cuped_weeks`` the metric is adjusted by its value on the unit and the day that many weeks
    before; ``operators.cuped.cuped_by_unit`` adjusts totals of units.
    """

    name: str
    compute: Callable[[date, date], DataFrame]
    cuped_weeks: int | None = None

    def values(self, start: date, end: date, unit: str = UNIT, day: str = DAY) -> DataFrame:
        if self.cuped_weeks is None:
            return self.compute(start, end).select(unit, day, self.name)
        weeks = self.cuped_weeks

        def shifted(first: date, last: date) -> DataFrame:
            rows = self.compute(first, last).select(unit, day, self.name)
            return rows if first == start else rows.withColumn(day, F.date_add(day, 7 * weeks))

        adjusted = cuped_metrics(shifted, start, end, weeks, [self.name], [unit, day])
        return adjusted.select(unit, day, F.col(f"cuped_{self.name}").alias(self.name))


class Experiment:
    """Salt selection and bootstrap for one configuration.

    ``unit_days`` holds the metrics by unit and day. It is turned into one row per unit once, and
    that table is materialised and counted, since every method regroups it. ``test_remainder`` and
    ``cumulative`` are those of the salt walk and of its table.
    """

    def __init__(
        self, config: SplitConfig, unit_days: DataFrame, metrics: Sequence[str], unit: str = UNIT, day: str = DAY,
        batch_size: int = 500, min_salts: int = 100, test_remainder: bool = True, cumulative: bool = False,
    ):
        config.slots  # needed by every method
        self.config, self.metrics = config, list(metrics)
        self.batch_size, self.min_salts = batch_size, min_salts
        self.test_remainder, self.cumulative = test_remainder, cumulative
        self.unit_days = unit_day_metrics([unit_days.select(unit, day, *metrics)], metrics, unit, day)
        self._unit, self._day = unit, day
        self.spark = unit_days.sparkSession

    @classmethod
    def from_metrics(cls, config: SplitConfig, metrics: Sequence[Metric], unit: str = UNIT, day: str = DAY, **options):
        names = [m.name for m in metrics]
        frames = [m.values(config.start_date, config.end_date, unit, day) for m in metrics]
        return cls(config, unit_day_metrics(frames, names, unit, day), names, unit, day, **options)

    @classmethod
    def from_account(
        cls, config: SplitConfig, account: type[Account],
        metrics: Sequence[str] = ("nits_bookings", "nits_profit"), walk: dict | None = None, **sources,
    ):
        """All metrics come from one run of the account's report.

        A configuration without bucket weights takes the account's; ``walk`` holds options of the
        constructor.
        """
        if config.exp_weights is None:
            config = replace(config, exp_weights=account.weights)
        report = account(config.start_date, config.end_date, pos=config.pos, **sources)
        return cls(config, report.get_metrics(metrics), metrics, **(walk or {}))

    @cached_property
    def series(self) -> UnitSeries:
        config = self.config
        return prepared(unit_series(self.unit_days, self.metrics, config.start_date, config.period, self._unit, self._day))

    @cached_property
    def salts(self) -> SaltSet:
        return generate_salts(self.spark, self.config.base_salt, self.config.run_date, self.config.ntrials)

    def walk(self, version: int = 1, **options) -> SaltWalk:
        options = {"batch_size": self.batch_size, "test_remainder": self.test_remainder} | options
        return SaltWalk(self.series, self.salts, self.config, version, **options)

    def get_smart_salt(self) -> tuple[str, float]:
        """The best stationary salt and its loss in percent."""
        best = smart_salt(self.walk()).first()
        return best["salt"], best["pae"] * PERCENT

    def get_smart_salt_table(self, version: int = 1) -> DataFrame:
        table = smart_salt_table(self.walk(version), self.min_salts, self.cumulative)
        return table.select("salt", "pae", "index", "stat_result")

    def get_smart_salt_table_v2(self) -> DataFrame:
        return self.get_smart_salt_table(2)

    def get_smart_salt_table_v3(self) -> DataFrame:
        return self.get_smart_salt_table(3)

    def get_bootstrapped(self, exp_weights: Sequence[int] = DEFAULT_WEIGHTS) -> DataFrame:
        return bootstrap_rdiff(self.series, self.salts, self.config.period, exp_weights, DEFAULT_SCHEMES).drop("salt_id")

    def get_bootstrapped_smart_salt_performance(
        self, exp_weights: Sequence[int], source_table_name: str, number_of_salts: int
    ) -> DataFrame:
        """Bootstrap of the best stored salts under the experiment's own groups."""
        stored = read_salts(self.spark, source_table_name, number_of_salts)
        schemes = [self.config.exp_groups]
        return bootstrap_rdiff(self.series, stored, self.config.period, exp_weights, schemes).drop("salt_id")

    def get_smart_salt_performance(self, source_table_name: str, number_of_salts: int = 100) -> DataFrame:
        stored = read_salts(self.spark, source_table_name, number_of_salts)
        return loss_report(self.series, stored, self.config, self.metrics)

    def get_random_salt_performance(self) -> DataFrame:
        return loss_report(self.series, self.salts, self.config, self.metrics)
