"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. ``--compare`` also times the
formulation the library replaces: one Python UDF call per salt over a collected unit-day frame.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import time
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from splitlab.operators import bootstrap  # noqa: E402
from workload import queries as q  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def salt_loss(n: int):
    return lambda spark: q.losses(q.events(spark, SF_DIR), q.config(n))


def bootstrap_rdiff(n: int):
    def run(spark: SparkSession) -> DataFrame:
        cfg = q.config(n)
        return bootstrap.bootstrap_rdiff(q.series_of(q.events(spark, SF_DIR), cfg), q.salts(spark, cfg), cfg.period)

    return run


def registered(name: str):
    return lambda spark: q.QUERIES[name](spark, SF_DIR)


HEADLINES = {
    "salt_loss_v1_100": salt_loss(100),
    "salt_loss_v1_1000": salt_loss(1000),
    "salt_loss_v1_10000": salt_loss(10_000),
    "bootstrap_rdiff_100": bootstrap_rdiff(100),
    "bootstrap_rdiff_1000": bootstrap_rdiff(1000),
    "smart_salt_1000": registered("smart_salt"),
    "smart_salt_table_v1_1000": registered("smart_salt_table_v1"),
    "agg_stats": registered("agg_stats"),
    "agg_stats_placement": registered("agg_stats_placement"),
    "agg_stats_campaign": registered("agg_stats_campaign"),
    "bootstrap_ci": registered("bootstrap_ci"),
    "cuped_adjusted": registered("cuped_adjusted"),
    "did": registered("did"),
}


def udf_loss(n: int):
    """Version 1 loss by one Python UDF call per salt."""
    def run(spark: SparkSession) -> DataFrame:
        cfg = q.config(n)
        frame = q.unit_days(spark, SF_DIR).toPandas()
        slots, groups, period = cfg.slots, len(cfg.exp_groups), cfg.period
        control, test = cfg.control, cfg.test

        def score(salt: str) -> float:
            units = frame["unit_id"].unique()
            of = {u: slots[int(hashlib.md5(f"{u}{salt}".encode()).hexdigest()[28:32], 16) % len(slots)] for u in units}
            rows = frame.assign(grp=frame["unit_id"].map(of))
            sizes = rows.groupby("grp")["unit_id"].nunique()
            daily = rows.groupby(["grp", "day"])[q.M].sum()
            daily = daily.div(sizes, axis=0, level="grp").reset_index()
            pairs = daily[daily.grp.isin(control)].merge(daily[daily.grp.isin(test)], on="day", how="left", suffixes=("_c", "_t"))
            errors = [np.abs(np.abs(pairs[f"{m}_t"] / pairs[f"{m}_c"]) - 1).sum() for m in q.M]
            return float(sum(errors) / period / groups)

        salts = q.salts(spark, cfg).df.repartition(int(CPUS))
        return salts.select("salt", F.udf(score, "double")("salt").alias("pae"))

    return run


def seconds(spark: SparkSession, run) -> float:
    start = time.perf_counter()
    run(spark).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = session()
    seconds(spark, salt_loss(10))  # start-up of the JVM and of the Python workers, not timed
    timings = {name: seconds(spark, run) for name, run in HEADLINES.items()}
    line = {"metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": SF_DIR}
    if "--compare" in sys.argv:
        line["udf_per_salt"] = {f"salt_loss_v1_{n}": seconds(spark, udf_loss(n)) for n in (100, 1000, 10_000)}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
