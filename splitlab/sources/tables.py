"""Result tables: names, replace-and-write, discovery of the latest, database sources."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlab.functions.dates import as_date


def table_name(account: str, kind: str, run_date: date | str, *parts: object) -> str:
    """account_kind_yyyymmdd_part_part..."""
    return "_".join([account, kind, as_date(run_date).strftime("%Y%m%d"), *map(str, parts)])


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Write a frame as a table in place of any table of that name.

    The rows go to a table of a name of its own first. Only when they are all written do names
    change: the old table steps aside, the new one takes its name, the old one is dropped. A failed
    write leaves the old table as it was, and a frame may be read from the table that it replaces.
    The rebalance hint lets adaptive execution write files of the advisory size, and split a
    partition that holds most of the rows.
    """
    spark = df.sparkSession
    written, aside = (f"{name}__{kind}_{uuid.uuid4().hex[:12]}" for kind in ("new", "old"))
    columns = [F.col(c) for c in partition_by]
    writer = df.hint("rebalance", *columns).write.format("parquet")
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(written)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {written}")
        raise
    replaced = spark.catalog.tableExists(name)
    if replaced:
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {written} RENAME TO {name}")
    if partition_by:  # the catalog may still know the partitions by their folders of before
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    if replaced:
        spark.sql(f"DROP TABLE {aside}")


def latest_table(spark: SparkSession, pattern: str, database: str | None = None) -> str:
    """The last table name, in text order, that matches ``pattern`` (``*`` as wildcard)."""
    names = [t.name for t in spark.catalog.listTables(database, pattern) if not t.isTemporary]
    if not names:
        raise LookupError(f"no table matches {pattern!r}")
    return max(names)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_jdbc(
    spark: SparkSession, url: str, query: str, partition_column: str | None = None,
    bounds: tuple[object, object] | None = None, num_partitions: int = 16, **options: str,
) -> DataFrame:
    """A query on a relational database; with a partition column it is read in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("query", query).load()
    low, high = bounds
    return (
        reader.option("dbtable", f"({query}) source")
        .option("partitionColumn", partition_column).option("lowerBound", str(low)).option("upperBound", str(high))
        .option("numPartitions", num_partitions).load()
    )
