"""Salt sets: generated candidates, and stored salts read back from a result table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splitlab.functions.dates import as_date
from splitlab.functions.hashing import salt_text, salts_collide


@dataclass(frozen=True)
class SaltSet:
    """``df`` holds (salt_id, salt) with ids 0..n-1; ``n`` is the number of rows, or a bound on it."""

    df: DataFrame
    n: int


def generate_salts(
    spark: SparkSession, base_salt: str, run_date: date | str, ntrials: int, allow_duplicates: bool = False
) -> SaltSet:
    """``ntrials`` candidate salts. Cut texts that collide raise unless duplicates are allowed."""
    if salts_collide(base_salt, ntrials) and not allow_duplicates:
        raise ValueError(f"{ntrials} trials under base salt {base_salt!r} give repeated salts")
    salt = salt_text(F.lit(base_salt), F.lit(as_date(run_date)), F.col("id"), F.lit(ntrials))
    return SaltSet(spark.range(ntrials).select(F.col("id").alias("salt_id"), salt.alias("salt")), ntrials)


def top_salts(losses: DataFrame, n: int) -> SaltSet:
    """The ``n`` stored salts of lowest loss (undefined loss last, ties by salt text)."""
    best = losses.orderBy(*loss_order()).limit(n)
    # The rank runs over at most n rows.
    ranked = best.withColumn("salt_id", F.row_number().over(Window.orderBy(*loss_order())).cast("bigint") - 1)
    return SaltSet(ranked.select("salt_id", "salt", "pae"), n)


def read_salts(spark: SparkSession, table: str, n: int) -> SaltSet:
    return top_salts(spark.table(table), n)


def loss_order() -> list[Column]:
    return [F.col("pae").asc_nulls_last(), F.col("salt").asc()]
