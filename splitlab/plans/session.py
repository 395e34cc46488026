"""Session helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000


def parallelism(spark: SparkSession) -> int:
    """Tasks to aim for in compute-bound stages; two waves over the cores of the cluster."""
    return max(int(spark.conf.get("spark.splitlab.tasks", "0")), 2 * spark.sparkContext.defaultParallelism)


def checkpoints(spark: SparkSession) -> bool:
    """Whether the session names a folder for checkpoints, which is then the one in use."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            return False
        sc.setCheckpointDir(folder)
    return True


def materialize(df: DataFrame) -> DataFrame:
    """Keep a frame that several jobs read.

    Where the session names a checkpoint folder, the frame is written there, which cuts its
    lineage. Where it names none, in every mode, the frame is persisted: it keeps its lineage,
    by which Spark recomputes what lost executors held.
    """
    return df.checkpoint() if checkpoints(df.sparkSession) else df.persist()


def materialize_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``materialize`` and the number of rows, counted by the job that writes or fills the storage."""
    if not checkpoints(df.sparkSession):
        kept = df.persist()
        return kept, kept.count()
    seen = Observation()
    # Only the checkpoint is read later, so the rows are counted once.
    kept = df.observe(seen, F.count(F.lit(1)).alias("n")).checkpoint()
    return kept, seen.get["n"]


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast hint when the frame is seen to hold at most ``max_rows`` rows; else no hint."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
