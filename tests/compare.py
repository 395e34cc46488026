"""Row-by-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES.split():
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)) if v is None else "", str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def differences(spark_df, con, sql: str) -> list[str]:
    """Differences as text; columns are matched by name, rows as sorted multisets."""
    mine = spark_df.toArrow().to_pylist()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    order = sorted(names)
    left = sorted((tuple(row[n] for n in order) for row in mine), key=_key)
    right = sorted((tuple(row[names.index(n)] for n in order) for row in theirs), key=_key)
    if len(left) != len(right):
        return [f"{len(left)} rows against {len(right)}"]
    found = []
    for a, b in zip(left, right):
        if not all(map(_same, a, b)):
            found.append(f"{dict(zip(order, a))}\n   against {dict(zip(order, b))}")
    return found
