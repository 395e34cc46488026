"""Daily group sums of every salt: the table that loss, stationarity and bootstrap all read."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.functions.hashing import assign_group
from splitlab.operators.metrics import UnitSeries
from splitlab.plans.session import BROADCAST_ROWS, parallelism
from splitlab.sources.salts import SaltSet

# Bounds of a task: numbers in its table of group sums (64 MB) and in one membership matrix.
SUMS_PER_TASK = 8_000_000
MEMBERSHIP = 2_000_000
# Units assumed where they were not counted.
UNKNOWN_UNITS = 100_000
# Units times salts of a task, where units were counted: well under a minute of hashing.
PAIRS_PER_TASK = 20_000_000


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def work_grid(n_salts: int, n_groups: int, per_group: int, tasks: int, n_units: int | None = None) -> tuple[int, int]:
    """(salt blocks, unit chunks): a task regroups one chunk of units under one block of salts.

    Every block costs one copy of the unit rows, every chunk one partial result per salt and
    group; the split makes the two about equal. Blocks also bound the sums a task holds.
    """
    results = n_salts * n_groups
    even = math.sqrt(tasks * results / max(n_units or UNKNOWN_UNITS, 1))
    least = -(-results * per_group // SUMS_PER_TASK)
    blocks = min(max(math.ceil(even), least, 1), max(least, min(n_salts, tasks)))
    return blocks, max(1, -(-tasks // blocks))


def cells(units: DataFrame, salts: SaltSet, blocks: int, chunks: int) -> DataFrame:
    """Units and salts laid out so that partition ``block * chunks + chunk`` holds the salts of
    its block, first, and the units of its chunk.

    Partitions are placed by number: the rows are few in bytes and heavy in compute, so adaptive
    coalescing by size would put the whole product into a handful of tasks.
    """
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    placed_units = units.withColumn("block", block).withColumn(
        "cell", F.col("block") * chunks + F.pmod(F.xxhash64("unit_id"), F.lit(chunks)).cast("int")
    )
    placed_salts = salts.df.select("salt_id", "salt").withColumn("chunk", chunk).withColumn(
        "cell", F.pmod(F.col("salt_id"), F.lit(blocks)).cast("int") * chunks + F.col("chunk")
    )
    both = placed_salts.drop("chunk").unionByName(placed_units.drop("block"), allowMissingColumns=True)
    placed = both.repartitionById(blocks * chunks, F.col("cell")).drop("cell")
    return placed.sortWithinPartitions(F.col("salt_id").asc_nulls_last())


def _day_matrix(batch: pa.RecordBatch, period: int, n_metrics: int) -> np.ndarray:
    """A row per unit: values by metric and day, presence by day, and a 1 to count units with."""
    days = batch.column("days")
    unit = np.repeat(np.arange(len(days)), np.diff(days.offsets.to_numpy()))
    entries = days.flatten()
    offset = entries.field("offset").to_numpy()
    out = np.zeros((len(days), (n_metrics + 1) * period + 1))
    for j in range(n_metrics):
        out[unit, j * period + offset] = entries.field(f"v{j}").to_numpy(zero_copy_only=False)
    out[unit, n_metrics * period + offset] = 1
    out[:, -1] = 1
    return out


def _slots(texts: Sequence[bytes], salt: bytes, n_slots: int) -> np.ndarray:
    """Hash slot of every unit: the last two bytes of the digest, as in ``hash_slot``."""
    digests = np.frombuffer(b"".join([md5(t + salt).digest() for t in texts]), np.uint8).reshape(-1, 16)
    return (digests[:, 14].astype(np.int64) * 256 + digests[:, 15]) % n_slots


def _add_units(sums: np.ndarray, salts: Sequence[bytes], batch: pa.RecordBatch, lookup: np.ndarray, shape: tuple) -> None:
    """Add the units of a batch to the sums of every salt, by membership matrix products."""
    period, n_metrics, n_groups = shape
    texts = [str(u).encode() for u in batch.column("unit_id").to_pylist()]
    values = _day_matrix(batch, period, n_metrics)
    finite = np.isfinite(values).all()
    step = max(1, MEMBERSHIP // max(1, n_groups * len(texts)))
    for at in range(0, len(salts), step):
        groups = np.stack([lookup[_slots(texts, s, len(lookup))] for s in salts[at : at + step]])
        member = groups[:, None, :] == np.arange(n_groups)[None, :, None]
        if finite:
            added = (member.reshape(-1, len(texts)).astype(float) @ values).reshape(len(groups), n_groups, -1)
        else:  # in a product an infinite value would reach the groups it is not in
            added = np.array([[values[m].sum(axis=0) for m in of_salt] for of_salt in member])
        sums[at : at + step] += added


def _result(ids: Sequence[int], sums: np.ndarray, shape: tuple) -> pa.RecordBatch:
    """(salt_id, offset, one column per metric and group, one count per group)."""
    period, n_metrics, n_groups = shape
    flat = [pa.array(np.repeat(ids, period)), pa.array(np.tile(np.arange(period, dtype=np.int32), len(ids)))]
    missing = sums[:, :, n_metrics * period : -1] == 0
    for j in range(n_metrics):
        for g in range(n_groups):
            value = sums[:, g, j * period : (j + 1) * period]
            flat.append(pa.array(value.ravel(), mask=missing[:, g].ravel()))
    flat += [pa.array(np.repeat(sums[:, g, -1].astype(np.int64), period)) for g in range(n_groups)]
    return pa.RecordBatch.from_arrays(flat, names=[str(i) for i in range(len(flat))])


def _regroup(lookup: np.ndarray, shape: tuple, names: Sequence[str]):
    """The work of one cell, for ``mapInArrow``: salts arrive first, then units batch by batch."""
    period, n_metrics, n_groups = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, salts, sums = [], [], None
        for batch in batches:
            n = len(batch) - batch.column("salt_id").null_count
            ids += batch.column("salt_id")[:n].to_pylist()
            salts += [s.encode() for s in batch.column("salt")[:n].to_pylist()]
            if n < len(batch) and salts:
                if sums is None:
                    sums = np.zeros((len(salts), n_groups, (n_metrics + 1) * period + 1))
                _add_units(sums, salts, batch.slice(n), lookup, shape)
        if sums is not None:
            step = max(1, 50_000 // period)
            for at in range(0, len(ids), step):
                yield _result(ids[at : at + step], sums[at : at + step], shape).rename_columns(names)

    return run


def group_days(series: UnitSeries, salts: SaltSet, slots: Sequence[int], keep: Sequence[int] | None = None) -> DataFrame:
    """(salt_id, day, ``{metric}__{group}`` ..., ``n__{group}`` ...) for every salt and day.

    ``slots`` gives the group of every hash slot; ``keep`` limits the groups. A sum is NULL on
    days on which the group has no rows; ``n__{group}`` counts its distinct units over the whole
    period. Spark spreads units and salts over the tasks and adds up their partial sums; inside
    a task the product runs on Arrow batches. Rows of a salt share a partition afterwards, and
    hold all groups, so comparing groups needs neither a shuffle nor a self join.
    """
    groups = sorted(set(slots) if keep is None else set(keep) & set(slots))
    lookup = np.array([groups.index(g) if g in groups else -1 for g in slots])
    shape = (series.period, len(series.metrics), len(groups))
    per_group = (len(series.metrics) + 1) * series.period + 1
    tasks = max(parallelism(series.df.sparkSession), -(-(series.n_units or 0) * salts.n // PAIRS_PER_TASK))
    layout = cells(series.df, salts, *work_grid(salts.n, len(groups), per_group, tasks, series.n_units))

    values = [f"{m}__{g}" for m in series.metrics for g in groups]
    counts = [f"n__{g}" for g in groups]
    schema = ", ".join(
        ["salt_id bigint", "offset int", *[f"{quoted(v)} double" for v in values], *[f"{c} bigint" for c in counts]]
    )
    partial = layout.mapInArrow(_regroup(lookup, shape, ["salt_id", "offset", *values, *counts]), schema)
    day = F.date_add(F.lit(series.start), F.col("offset")).alias("day")
    # Few bytes, but what reads them computes on every series: by number, so that they are not coalesced by size.
    spread = max(int(series.df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(parallelism(series.df.sparkSession), salts.n))
    return partial.repartition(spread, "salt_id").groupBy("salt_id", day).agg(
        *[F.expr(f"sum({quoted(c)}) AS {quoted(c)}") for c in values + counts]
    )


def group_rows(days: DataFrame, groups: Sequence[int], metrics: Sequence[str]) -> DataFrame:
    """(salt_id, grp, n_units, day, metrics): a row per group and day that has rows."""
    rows = F.array(*[
        F.struct(F.lit(g).alias("grp"), F.col(f"n__{g}").alias("n_units"), *[F.col(f"{m}__{g}").alias(m) for m in metrics])
        for g in groups
    ])
    long = days.select("salt_id", "day", F.inline(rows))
    return long.where(F.col(metrics[0]).isNotNull()).select("salt_id", "grp", "n_units", "day", *metrics)


def assign_units(units: DataFrame, salts: SaltSet, weights: Sequence[int], unit: str = "unit_id") -> DataFrame:
    """(unit_id, salt_id, salt, bucket) for every unit under every salt.

    The salts of a block ride along in one array per block, so each unit row expands by itself. More
    than BROADCAST_ROWS salts are broadcast in as many parts, each within that bound.
    """
    ids = units.where(F.col(unit).isNotNull()).select(F.col(unit).cast("bigint").alias("unit_id"))
    blocks, chunks = work_grid(salts.n, 1, 1, parallelism(units.sparkSession))
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    cell = F.col("block") * chunks + F.pmod(F.xxhash64("unit_id"), F.lit(chunks)).cast("int")
    placed = ids.withColumn("block", block).repartitionById(blocks * chunks, cell)
    parts = max(1, -(-salts.n // BROADCAST_ROWS))

    def under(part: int) -> DataFrame:
        some = salts.df.where(F.pmod(F.floor(F.col("salt_id") / blocks), F.lit(parts)) == part) if parts > 1 else salts.df
        listed = some.groupBy(F.pmod(F.col("salt_id"), F.lit(blocks)).cast("int").alias("block")).agg(
            F.collect_list(F.struct("salt_id", "salt")).alias("salts")
        )
        return placed.join(F.broadcast(listed), "block").select("unit_id", F.inline("salts"))

    expanded = reduce(DataFrame.union, map(under, range(parts)))
    return expanded.withColumn("bucket", assign_group(F.col("unit_id"), F.col("salt"), weights))
