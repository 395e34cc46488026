"""Hard negatives by exact integer inner products in a residue number system.

Components become integers floor(scale * x). A product of integer matrices is taken modulo several
primes in float32: residues in -(p-1)/2 .. (p-1)/2 keep every sum below 2^24, where float32 is
exact, and as many primes are used as the largest possible score needs. Mixed-radix digits
(Chinese remaindering) give back the signed scores. Anchors and rows meet in cells of a block of
anchors and a shard of rows, so a task holds a bounded matrix; windows over the few rows that each
cell sends on make the final choice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splitlab.llm.common import broadcast_if_few, stored

SCALE = 256
SHARD_ROWS = 32768
ANCHOR_BLOCK = 8192
# Scores held at a time inside a task.
SCORES = 1 << 22
# Residues stay below half of it, so that products of 64 components are exact in float32.
LARGEST_PRIME = 1021
# Rows of a larger squared length take no part: their scores need not fit a long.
MOST_SQUARED = 2.0**56


def _primes(product: int) -> list[int]:
    """Primes from LARGEST_PRIME down until their product exceeds ``product``."""
    found, total, n = [], 1, LARGEST_PRIME
    while total <= product:
        if all(n % d for d in range(2, int(n**0.5) + 1)):
            found.append(n)
            total *= n
        n -= 1
    return found


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of least absolute value."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r)


class Residues:
    """Integer rows as centred residues in float32, one matrix per prime."""

    def __init__(self, rows: np.ndarray, primes: list[int]):
        self.parts = [_centred(rows, p).astype(np.float32) for p in primes]

    def __getitem__(self, at) -> list[np.ndarray]:
        return [part[at] for part in self.parts]


def product(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact a @ b.T as int64, for scores below half the product of the primes in absolute value."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        step = (1 << 24) // (p // 2) ** 2  # components whose products surely add up exactly
        r = np.zeros((len(a[k]), len(b[k])), np.int64)
        for at in range(0, a[k].shape[1], step):
            r += (a[k][:, at : at + step] @ b[k][:, at : at + step].T).astype(np.int64)
        # Garner's digits: the score is d0 + p0 (d1 + p1 (d2 + ...)), centred digits give its sign.
        for d, q in zip(digits, primes):
            r = (r - d) % p * pow(q, -1, p)
        digits.append(_centred(r, p))
    score = digits[-1]
    for d, q in zip(digits[-2::-1], primes[len(digits) - 2 :: -1]):
        score = score * q + d
    return score


def _first(order: tuple[np.ndarray, ...], group: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` entries of each group, groups in order, by the keys of ``order`` (last one first)."""
    by = np.lexsort((*order, group))
    sorted_group = group[by]
    begin = np.searchsorted(sorted_group, sorted_group)
    return by[np.arange(len(by)) - begin < n]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _chunks(n: int, per_row: int) -> list[tuple[int, int]]:
    step = max(1, SCORES // max(per_row, 1))
    return [(at, min(at + step, n)) for at in range(0, n, step)]


def _cells(rows: DataFrame, shards: Column, blocks: Column, anchor: bool) -> DataFrame:
    """Rows of one shard meet every block, anchors of one block every shard."""
    def one(n: Column) -> Column:
        return F.pmod(F.xxhash64("id"), n).cast("int")

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))

    if anchor:
        return rows.withColumn("block", one(blocks)).withColumn("shard", every(shards))
    return rows.withColumn("shard", one(shards)).withColumn("block", every(blocks))


def _several(n: Column, size: int) -> Column:
    return F.greatest(F.ceil(n / size), F.lit(1)).cast("int")


def sound(df: DataFrame, id: str, vector: str, label: Column, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part, v as integers; see ``hard_negatives``."""
    x = F.transform(f"`{vector}`", lambda c: c.cast("double"))
    rows = df.select(F.col(f"`{id}`").cast("bigint").alias("id"), label.cast("bigint").alias("label"), x.alias("x")).where(
        "id is not null and label is not null and size(x) > 0 and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))"
    )
    whole = F.transform("x", lambda c: F.floor(c * scale))
    size = F.aggregate("x", F.lit(0.0), lambda s, c: s + (F.abs(c) * scale + 1) * (F.abs(c) * scale + 1))
    held = rows.where(size < MOST_SQUARED).select("id", "label", whole.cast("array<int>").alias("v"))
    return held.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def hard_negatives(
    vectors: DataFrame, anchors: Column, *, id: str = "vec_id", vector: str = "embedding", label: Column | None = None, positives: int = 5,
    negatives: int = 3, lowest: int = 50, highest: int = 95, scale: int = SCALE, shard_rows: int = SHARD_ROWS, anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on column ``id`` of this name, ``label`` an expression over the
    input (its column ``label`` if not given). An anchor's positives are the ``positives`` other rows of its label with
    the largest integer inner product, its negatives for each the first ``negatives`` rows of other
    labels whose score lies between ``lowest`` and ``highest`` percent of the positive's, both
    included; ties go to smaller ids. A positive score below 0 has no such window, one of 0 admits scores of 0.
    Rows with a NULL id, label, vector, or a NULL or non-finite component take no part, nor do empty vectors, vectors
    of another length than the most common one, and vectors so long that a score need not fit a long
    (|scale x| from about 2^28). Rows repeated under one id count once (smallest label and
    vector). Other columns are ignored. Without anchors or partners the result is empty.
    """
    spark = vectors.sparkSession
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    all_rows = stored(sound(vectors, id, vector, label if label is not None else F.col("label"), scale).withColumn("anchor", F.coalesce(anchors, F.lit(False))))
    squared = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    facts = (
        all_rows.groupBy(F.size("v").alias("d"))
        .agg(F.count("*").alias("n"), F.sum(F.col("anchor").cast("int")).alias("a"), F.max(squared).alias("m")).orderBy(F.desc("n"), "d").first()
    )
    if facts is None or not facts["a"]:
        return spark.createDataFrame([], schema)
    width = facts["d"]
    rows = all_rows.where(F.size("v") == width)
    primes = _primes(2 * int(facts["m"] * 1.001) + 2)

    def split(table: pa.Table) -> tuple[pa.Table, pa.Table]:
        asked = table["anchor"].to_numpy()
        return table.filter(pa.array(asked)), table.filter(pa.array(~asked)).sort_by("id")

    def nearest_of_label(table: pa.Table) -> pa.Table:
        a, b = split(table)
        a_ids, b_ids = a["id"].to_numpy(), b["id"].to_numpy()
        left, right = Residues(_matrix(a["v"], width), primes), Residues(_matrix(b["v"], width), primes)
        found: list[tuple] = []
        for lo, hi in _chunks(len(a_ids), len(b_ids)):
            if not len(b_ids):
                break
            score = product(left[lo:hi], right[:], primes)
            n = min(positives + 1, len(b_ids))  # one for the anchor itself
            edge = np.partition(score, len(b_ids) - n, axis=1)[:, len(b_ids) - n]
            i, j = np.nonzero(score >= edge[:, None])
            other = a_ids[lo:hi][i] != b_ids[j]
            i, j = i[other], j[other]
            s = score[i, j]
            best = _first((j, -s), i, positives)  # rows are in id order
            found.append((a_ids[lo:hi][i[best]], b_ids[j[best]], s[best]))
        return _table(found, ["anchor_id", "positive_id", "positive_score"])

    def in_window(table: pa.Table) -> pa.Table:
        a, b = split(table)
        a_ids, b_ids = a["id"].to_numpy(), b["id"].to_numpy()
        a_label, b_label = a["label"].to_numpy(), b["label"].to_numpy()
        left, right = Residues(_matrix(a["v"], width), primes), Residues(_matrix(b["v"], width), primes)
        of = np.repeat(np.arange(len(a_ids)), [len(p) for p in a["positives"]])
        flat = a["positives"].combine_chunks().flatten()
        p_ids, p_scores = flat.field("positive_id").to_numpy(), flat.field("positive_score").to_numpy()
        floor, top = -(-lowest * p_scores // 100), highest * p_scores // 100
        found: list[tuple] = []
        for lo, hi in _chunks(len(a_ids), len(b_ids)):
            mine = np.flatnonzero((of >= lo) & (of < hi))
            if not len(b_ids) or not len(mine):
                continue
            score = product(left[lo:hi], right[:], primes)
            differ = a_label[lo:hi, None] != b_label[None, :]
            for nth in range(positives):  # the nth positive of every anchor at once
                begin = np.searchsorted(of, np.arange(lo, hi))
                at = begin + nth
                held = (at < len(of)) & (of[np.minimum(at, len(of) - 1)] == np.arange(lo, hi))
                row = np.flatnonzero(held)
                p = at[row]
                part = score[row]
                good = differ[row] & (part >= floor[p][:, None]) & (part <= top[p][:, None])
                i, j = np.nonzero(good)
                s = part[i, j]
                best = _first((j, -s), i, negatives)
                found.append((a_ids[lo + row[i[best]]], p_ids[p[i[best]]], b_ids[j[best]], p_scores[p[i[best]]], s[best]))
        return _table(found, ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    # Positives: cells within a label, as many as its rows need.
    sizes = rows.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("anchor").cast("int")).alias("n_a"))
    sized = rows.join(broadcast_if_few(sizes.where("n_a > 0")), "label")
    grid = (_several(F.col("n"), shard_rows), _several(F.col("n_a"), anchor_block))
    held = _cells(sized.withColumn("anchor", F.lit(False)), *grid, anchor=False)
    posed = _cells(sized.where("anchor"), *grid, anchor=True)
    found = held.unionByName(posed).select("label", "shard", "block", "anchor", "id", "v").groupBy("label", "shard", "block").applyInArrow(
        nearest_of_label, "anchor_id bigint, positive_id bigint, positive_score bigint"
    )
    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= positives)
    per_anchor = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives"))
    asked = rows.where("anchor").join(per_anchor, F.col("id") == F.col("anchor_id")).drop("anchor_id")

    # Negatives: cells over all rows.
    grid = (_several(F.lit(facts["n"]), shard_rows), _several(F.lit(facts["a"]), anchor_block))
    kind = "array<struct<rank:int,positive_id:bigint,positive_score:bigint>>"
    held = _cells(rows.withColumns({"anchor": F.lit(False), "positives": F.lit(None).cast(kind)}), *grid, anchor=False)
    posed = _cells(asked, *grid, anchor=True)
    found = held.unionByName(posed).select("shard", "block", "anchor", "id", "label", "v", "positives").groupBy("shard", "block").applyInArrow(
        in_window, "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint"
    )
    by_score = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score).cast("int")).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _table(found: list[tuple], names: list[str]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * len(names)
    return pa.table(dict(zip(names, (c.astype(np.int64) for c in columns))))
