"""Choosing smart salts: lowest loss among the salts whose ratio series are stationary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.operators.loss import salt_days, salt_loss
from splitlab.operators.metrics import UnitSeries
from splitlab.operators.ranking import with_rank
from splitlab.operators.stationarity import stationarity
from splitlab.plans.config import SplitConfig
from splitlab.plans.session import materialize, parallelism
from splitlab.sources.salts import SaltSet, loss_order

BATCH_SIZE = 500
MIN_SALTS = 100


class SaltWalk:
    """Salts in order of loss, tested for stationarity in batches of that order.

    The regrouping of all units runs once; its result, daily sums of the compared groups under
    every salt, is materialised and read by the losses and by the tests. One job tests the salts
    of all batches; which batch counts is an aggregate over the salts that pass, so the number of
    jobs does not depend on the number of batches.
    """

    def __init__(
        self, series: UnitSeries, salts: SaltSet, config: SplitConfig, version: int = 1,
        batch_size: int = BATCH_SIZE, test_remainder: bool = True,
    ):
        self.config, self.metrics, self.batch_size = config, series.metrics, batch_size
        self.days = materialize(salt_days(series, salts, config))
        losses = salt_loss(self.days, salts, config, series.metrics, version)
        self.ranked = with_rank(losses, loss_order(), "index")
        # Every salt is tested; ``test_remainder=False`` leaves what is over from whole batches untested.
        self.n_batches = -(-salts.n // batch_size) if test_remainder else salts.n // batch_size

    @cached_property
    def passed(self) -> DataFrame:
        """The tested salts that pass: (salt_id, salt, pae, index, stat_result, batch)."""
        in_reach = self.ranked.where(F.col("index") < self.n_batches * self.batch_size)
        # By number: the days are few in bytes, but every series of a salt is tested.
        spread = max(parallelism(self.days.sparkSession), int(self.days.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        tested = stationarity(self.days.repartition(spread, "salt_id"), self.config, self.metrics).where("stat_result")
        batch = F.floor(F.col("index") / self.batch_size).cast("bigint").alias("batch")
        return materialize(in_reach.join(tested.select("salt_id", "stat_result"), "salt_id").select(*self.ranked.columns, "stat_result", batch))

    def best(self) -> DataFrame:
        return self.ranked.orderBy("index").limit(1).withColumn("stat_result", F.lit(False))


def smart_salt(walk: SaltWalk) -> DataFrame:
    """One row: the salt of lowest loss in the first batch with a stationary salt.

    When no tested batch has one, the salt of lowest loss,
    with ``stat_result`` false.
    """
    # The first salt that passes is in the first batch that has one.
    either = walk.passed.drop("batch").unionByName(walk.best())
    return either.orderBy(F.desc("stat_result"), "index").limit(1)


def smart_salt_table(walk: SaltWalk, min_salts: int = MIN_SALTS, cumulative: bool = False) -> DataFrame:
    """The stationary salts of the first batch that has at least ``min_salts`` of them.

    If none has, those of all batches. With ``cumulative`` the batches walked so far
    count together and are returned together.
    """
    passed = walk.passed
    if cumulative:  # up to the batch of the salt that makes the number full
        first = passed.orderBy("index").limit(min_salts)
        chosen = first.agg(F.when(F.count("*") >= min_salts, F.max("batch")).alias("batch")).scalar()
        kept = F.col("batch") <= chosen
    else:
        enough = passed.groupBy("batch").count().where(F.col("count") >= min_salts)
        chosen = enough.agg(F.min("batch").alias("batch")).scalar()
        kept = F.col("batch") == chosen
    return passed.where(chosen.isNull() | kept).drop("batch")


def loss_report(series: UnitSeries, salts: SaltSet, config: SplitConfig, metrics: Sequence[str], version: int = 1) -> DataFrame:
    """(salt, pae) ordered by loss: the performance report of random or of stored salts."""
    losses = salt_loss(salt_days(series, salts, config), salts, config, metrics, version)
    return losses.select("salt", "pae").orderBy(*loss_order())
