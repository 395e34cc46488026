"""Places in a global order, without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlab.plans.session import materialize

# monotonically_increasing_id holds the task above, the place in the task below this bit.
_TASK_BIT = 33


def with_rank(df: DataFrame, order: Sequence[str | Column], name: str = "rank", n_tasks: int | None = None) -> DataFrame:
    """Add ``name``, the row's place from 0 on in ``order``; ties in any order.

    Rows are dealt to tasks by ranges of the order and sorted there. A row's place is its place in
    its task plus the rows of earlier tasks; only one count per task reaches the driver. Rows of
    equal order all go to one task, so end ``order`` with a column that tells them apart.
    """
    spark = df.sparkSession
    n_tasks = n_tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    placed = materialize(df.repartitionByRange(n_tasks, *order).sortWithinPartitions(*order).withColumn(name, at))
    task = F.shiftright(name, _TASK_BIT)
    counts = dict(placed.groupBy(task.cast("int").alias("task")).count().collect())
    before, total = [], 0
    for i in range(max(counts, default=0) + 1):
        before.append(str(total))
        total += counts.get(i, 0)
    # One text literal however many tasks there are; Spark folds it into one array.
    offsets = F.split(F.lit(",".join(before)), ",").cast("array<bigint>")
    inside = F.col(name).bitwiseAND(F.lit((1 << _TASK_BIT) - 1))
    return placed.withColumn(name, inside + F.element_at(offsets, task.cast("int") + 1))
