"""Text helpers shared by the operators of this subpackage: Arrow slices, word hashes, storage."""

from __future__ import annotations

import gc
import hashlib
import pickle
import sys
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Text handled at a time inside a task; a longer document is a piece of its own.
PIECE_BYTES = 2 << 20
# Text per task after a regrouping.
SLICE_BYTES = 16 << 20
SHINGLE = 5

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SLOTS = [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]


def process_cache(operator: str) -> dict:
    """A dict of an operator that lives in the worker process, over its tasks, until another operator's tasks come.

    Workers are kept from stage to stage: what one operator remembers would else stay in memory while the next ones work.
    """
    caches = sys.modules.setdefault("_splitlab_llm_cache", type(sys)("_splitlab_llm_cache")).__dict__.setdefault("operators", {})
    if operator not in caches:
        if caches:
            caches.clear()
            gc.collect()
        caches[operator] = {}
    return caches[operator]


def share(spark: SparkSession, value: Any, operator: str) -> Callable[[], Any]:
    """Broadcast a value of bounded size, its classes included; the result gives it back inside the operator's tasks.

    A worker holds the operator's value that it was asked for last.
    """
    content = cloudpickle.dumps(value)
    sent, key = spark.sparkContext.broadcast(content), hashlib.sha256(content).hexdigest()

    def get() -> Any:
        cache = process_cache(operator)
        if cache.get("shared", ("",))[0] != key:
            cache["shared"] = key, pickle.loads(sent.value)
        return cache["shared"][1]

    return get


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that long texts travel in; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several jobs read: it is written as Parquet below the shared folder and read again.

    The shared folder is that of spark.checkpoint.dir; where the session names none, the frame is
    persisted, which Spark recomputes after a loss. A checkpoint would compute the frame twice and be
    read in as many tasks as wrote it; small files of Parquet are read many to a task, so what is
    derived from a small table leaves few shuffle files. Its rows are counted from the files' footers.
    """
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df.persist()
    path = f"{folder.rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of two numbers that may be broadcast: 16 MB.
BROADCAST_ROWS = 1_000_000


def broadcast_if_few(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a frame counted to have few rows; a larger one is joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def slices(df: DataFrame, text: str = "text", least: int = 1) -> int:
    """Partitions for a regrouping of a table by its text: about SLICE_BYTES of text each."""
    spark = df.sparkSession
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SLICE_BYTES))


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about ``limit`` bytes of text each."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, n = 0, batch.num_rows
        while at < n:
            to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right"))
            to = min(n, max(at + 1, to))
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the n + 1 offsets of its rows; NULL is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64, in place."""
    h ^= h >> U(30)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


# Text whose words are hashed at a time.
HASHED_BYTES = 1 << 16


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, n at least; those for longer words are not kept."""
    kept = sys.modules.setdefault("_splitlab_llm_cache", type(sys)("_splitlab_llm_cache")).__dict__.setdefault("powers", [])
    if kept and n <= len(kept[0]):
        return kept[0], kept[1]
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(max(n, HASHED_BYTES), base, U)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=U))
    if n <= HASHED_BYTES:
        kept[:] = made
    return made[0], made[1]


def _word_hashes(room: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the lower-cased words of a text, about HASHED_BYTES of it at a time; they do not depend on their place."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    hashes = np.empty(len(starts), U)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + HASHED_BYTES, "right")))
        a, b = int(starts[at]), int(ends[to - 1])
        up, down = _powers(b - a)
        sums = np.zeros(b - a + 1, U)
        np.cumsum((lower[room[a:b]].astype(U) + U(1)) * up[: b - a], out=sums[1:])
        first, last = starts[at:to] - a, ends[at:to] - a
        hashes[at:to] = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(U))
        at = to
    return hashes


class Words:
    """Lower-cased (A-Z) words of a column of texts, split at ASCII white space.

    ``hashes`` of all words, ``starts`` and ``ends`` as byte places in the row, ``first`` and
    ``last`` word of each row as places in these arrays.
    """

    def __init__(self, column: pa.Array):
        data, offsets = utf8(column)
        n = len(offsets) - 1
        room = np.full(len(data) + n, 32, np.uint8)
        for i in range(n):  # one space after each row
            room[offsets[i] + i : offsets[i + 1] + i] = data[offsets[i] : offsets[i + 1]]
        solid = np.ones(256, bool)
        solid[[9, 10, 11, 12, 13, 32]] = False
        inside = np.zeros(len(room) + 1, np.int8)
        inside[1:] = solid[room]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        rows = offsets + np.arange(n + 1)
        self.hashes = _word_hashes(room, starts, ends)
        self.first, self.last = np.searchsorted(starts, rows[:-1]), np.searchsorted(starts, rows[1:])
        shift = np.repeat(rows[:-1], self.last - self.first)
        self.starts, self.ends = starts - shift, ends - shift
        self.room, self.base = room, rows

    def shingles(self, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of n-word shingles in text order, and the first and last place of each row.

        A row of fewer words has its whole sequence as one shingle, a row without words none.
        """
        w = self.hashes
        run = np.zeros(max(len(w) - n + 1, 0), U)
        for j in range(n):
            run += w[j : j + len(run)] * U(_SLOTS[j])
        run = mix(run)
        count = self.last - self.first
        sizes = np.where(count >= n, count - n + 1, np.minimum(count, 1))
        ends = np.cumsum(sizes)
        begins = ends - sizes
        out = np.zeros(int(ends[-1]) if len(ends) else 0, U)
        long = np.flatnonzero(count >= n)
        for i in long:
            out[begins[i] : ends[i]] = run[self.first[i] : self.first[i] + sizes[i]]
        for i in np.flatnonzero((count > 0) & (count < n)):
            few = w[self.first[i] : self.last[i]]
            with np.errstate(over="ignore"):
                out[begins[i]] = mix(np.array([(few * np.array(_SLOTS[: len(few)], U)).sum(dtype=U) + U(len(few))], U))[0]
        return out, begins, ends


def list_column(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the end of each row."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


BUCKETS_PER_TASK = 8


def packed(key: np.ndarray, n_buckets: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per bucket of the keys, each column a byte string of its values; a column may be empty throughout.

    So a shuffle moves arrays of numbers instead of one row per number.
    """
    bucket = (mix(key.astype(U, copy=True)) % U(n_buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    held, begins = np.unique(bucket[order], return_index=True)
    begins = np.r_[begins, len(order)]
    arrays = [pa.array(held, pa.int32())]
    for values in columns.values():
        values = np.ascontiguousarray(values[order]) if len(values) else values
        offsets = pa.py_buffer((begins * (values.itemsize if len(values) else 0)).astype(np.int64).tobytes())
        arrays.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(held), [None, offsets, pa.py_buffer(values.tobytes())]).cast(pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, ["bucket", *columns])


def unpacked(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> dict[str, np.ndarray] | None:
    """All values of a task's buckets, joined; None if there are none."""
    found: dict[str, list[np.ndarray]] = {name: [] for name in kinds}
    for batch in batches:
        for name, kind in kinds.items():
            column = batch.column(name).cast(pa.large_binary())
            if not len(column):
                continue
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            raw = column.buffers()[2]
            if raw is not None and offsets[-1] > offsets[0]:
                found[name].append(np.frombuffer(raw.to_pybytes()[offsets[0] : offsets[-1]], kind))
    if not any(found.values()):
        return None
    return {name: np.concatenate(parts) if parts else np.zeros(0, kinds[name]) for name, parts in found.items()}


SIX = np.dtype((np.void, 6))


def six_bytes(keys: np.ndarray) -> np.ndarray:
    """The low 48 bits of keys, to travel in a shuffle; good for a filter, where a rare clash costs only work."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).view(SIX).ravel()


def from_six_bytes(packed_keys: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(packed_keys), 8), np.uint8)
    wide[:, :6] = packed_keys.view(np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel().astype(U)


def dealt(df: DataFrame, n_tasks: int) -> DataFrame:
    """Rows of ``packed`` to the tasks of their buckets."""
    return df.repartition(n_tasks, "bucket")


def packed_schema(*names: str) -> str:
    return "bucket int, " + ", ".join(f"{n} binary" for n in names)


def groups(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and sizes of runs of equal keys."""
    begins = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.zeros(0, np.int64)
    return begins, np.diff(np.r_[begins, len(sorted_keys)])


def near_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces whose ids lie within 32 bits of each other."""
    for batch in pieces(batches):
        ids = batch.column("doc_id").to_numpy()
        if len(ids) and float(ids.max()) - float(ids.min()) < 2**32:
            yield batch
        else:
            yield from (batch.slice(i, 1) for i in range(len(ids)))


def with_base(sent: pa.RecordBatch, base: int) -> pa.RecordBatch:
    """Packed rows whose ``doc`` counts from ``base``."""
    return sent.append_column("base", pa.array(np.full(sent.num_rows, base, np.int64)))


def unpacked_docs(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> dict[str, np.ndarray] | None:
    """unpacked, with the 32-bit ``doc`` raised by each row's base."""
    parts = []
    for batch in batches:
        if batch.num_rows:
            found = unpacked([batch], kinds)
            if found and len(found["doc"]):
                sizes = np.array([len(x) // 4 for x in batch.column("doc").to_pylist()])
                found["doc"] = found["doc"].astype(np.int64) + np.repeat(batch.column("base").to_numpy(), sizes)
            if found:
                parts.append(found)
    return {name: np.concatenate([p[name] for p in parts]) for name in kinds} if parts else None


def keyed_by_text(docs: DataFrame, text: str, id: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Rows (doc_id, text, digest) dealt by id; per id the digests of texts it is the first to have; rows without id.

    The dealing is one exchange that all steps of a plan share: neither filters nor columns differ below it.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # A plain column stays a plain column: an alias would keep Spark from seeing that two exchanges are the same.
    key = F.col(id) if id == "doc_id" and docs.schema[id].dataType.simpleString() == "bigint" else F.col(f"`{id}`").cast("bigint").alias("doc_id")
    source = docs.select(key, value.alias("text"))
    n_tasks = slices(source)
    whole = source.where("doc_id is not null").select("doc_id", "text", F.coalesce(F.sha2("text", 256), F.lit("")).alias("digest"))
    firsts = whole.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).groupBy("doc_id").agg(F.collect_list("digest").alias("firsts"))
    return whole.repartition(n_tasks, "doc_id"), firsts, source.where("doc_id is null"), n_tasks
