"""Nearest vectors by inner product: vantage-point trees per shard, with relaxed pruning.

Largest inner product becomes smallest distance by one more component: vector x gets
sqrt(M^2 - |x|^2), with M the largest norm, and a query gets 0. Each shard of the rows builds a
vantage-point tree over its distinct vectors. A query enters a subtree unless the triangle
inequality, its bound multiplied by ``factor``, rules it out: with factor 1 the search is exact,
a larger factor prunes more and may miss neighbours. Queries travel in blocks and descend the
tree together; scores are inner products of the original vectors in double precision.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192
QUERY_BLOCK = 2048
LEAF = 256


class Tree:
    """A vantage-point tree over rows of ``x``; nodes split at the median distance."""

    def __init__(self, x: np.ndarray, rows: np.ndarray | None = None, leaf: int = LEAF):
        rows = np.arange(len(x)) if rows is None else rows
        self.rows, self.point = rows, None
        if len(rows) <= leaf:
            return
        centre = x[rows].mean(0)
        self.point = x[rows[np.argmax(((x[rows] - centre) ** 2).sum(1))]]  # an outlying vantage point spreads distances best
        d = np.sqrt(((x[rows] - self.point) ** 2).sum(1))
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        self.inner, self.outer = d[order[half - 1]], d[order[half]]
        self.near, self.far = Tree(x, rows[order[:half]], leaf), Tree(x, rows[order[half:]], leaf)
        self.rows = None


class Search:
    """The k best rows of a tree for a block of queries."""

    def __init__(self, vectors: np.ndarray, queries: np.ndarray, k: int, factor: float, most: float):
        self.vectors, self.queries, self.k, self.factor = vectors, queries, k, factor
        self.norms = (queries**2).sum(1)
        self.top = most  # squared length of every lifted row
        self.scale = np.sqrt(most * max(self.norms.max(), 1e-300))
        self.found = np.full((len(queries), k), -np.inf)
        self.where = np.full((len(queries), k), -1)

    def radius(self, q: np.ndarray) -> np.ndarray:
        """Distance of the k-th best so far."""
        return np.sqrt(np.maximum(self.top + self.norms[q] - 2 * self.found[q].min(1), 0))

    def visit(self, tree: Tree, q: np.ndarray) -> None:
        if not len(q):
            return
        if tree.point is None:
            score = np.round(self.queries[q] @ self.vectors[tree.rows].T / self.scale, 12) * self.scale  # rounding noise is no rank
            both = np.concatenate([self.found[q], score], 1)
            where = np.concatenate([self.where[q], np.broadcast_to(tree.rows, score.shape)], 1)
            best = np.argpartition(-both, self.k - 1, axis=1)[:, : self.k]
            edge = np.take_along_axis(both, best, 1).min(1)
            tied = np.flatnonzero((both >= edge[:, None]).sum(1) > self.k)  # of equal scores the points of smaller ids stay
            if len(tied):
                best[tied] = np.lexsort((where[tied], -both[tied]), axis=-1)[:, : self.k]
            self.found[q] = np.take_along_axis(both, best, 1)
            self.where[q] = np.take_along_axis(where, best, 1)
            return
        d = np.sqrt(np.maximum(self.norms[q] + (tree.point**2).sum() - 2 * self.queries[q] @ tree.point[: self.queries.shape[1]], 0))
        first = d <= (tree.inner + tree.outer) / 2
        self.visit(tree.near, q[first])
        self.visit(tree.far, q[~first])
        for mine, other, gap in ((first, tree.far, tree.outer - d), (~first, tree.near, d - tree.inner)):
            mine = mine & (np.maximum(gap, 0) * self.factor <= self.radius(q) * (1 + 1e-6) + 1e-9)
            self.visit(other, q[mine])


def nearest(
    vectors: DataFrame, queries: DataFrame, *, id: str = "vec_id", vector: str = "embedding", k: int = 20, factor: float = 1.0,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The ``k`` rows of largest inner product for each query, best first, ties to smaller ids.

    Both frames have the id and the vector column; other columns are ignored. Rows whose id or
    vector is NULL, or whose vector is all zero, empty, or holds NULL or non-finite components take no part;
    nor do vectors of another length than the most common one. A row of the query's id is never its
    neighbour. Rows repeated under one id count once (the smallest vector). With fewer than ``k``
    candidates all are returned; without queries or candidates the result is empty.
    Returns query_id, rank from 1, the neighbour's id as vec_id, score.
    """
    spark = vectors.sparkSession

    def sound(df: DataFrame) -> DataFrame:
        v = F.transform(f"`{vector}`", lambda x: x.cast("double"))
        rows = df.select(F.col(f"`{id}`").cast("bigint").alias("id"), v.alias("v")).where(
            "id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)"
        )
        return rows.groupBy("id").agg(F.min("v").alias("v"))

    rows, asked = sound(vectors), sound(queries)
    facts = (
        rows.groupBy(F.size("v").alias("d"))
        .agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("m")).orderBy(F.desc("n"), "d").first()
    )
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if facts is None:
        return spark.createDataFrame([], schema)
    width, n, most = facts["d"], facts["n"], facts["m"]
    shards = max(1, -(-n // shard_rows))
    n_asked = asked.where(F.size("v") == width).count()
    blocks = max(1, -(-n_asked // QUERY_BLOCK))
    rows = rows.where(F.size("v") == width)
    # Every shard meets every block of queries; the rows of a shard go to each of its cells.
    def cell(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    held = rows.select(cell(shards).alias("shard"), every(blocks).alias("block"), "id", "v", F.lit(False).alias("q"))
    posed = asked.where(F.size("v") == width).select(every(shards).alias("shard"), cell(blocks).alias("block"), "id", "v", F.lit(True).alias("q"))

    def search(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        is_query = table["q"].to_numpy().astype(bool)
        q_ids, q = ids[is_query], flat[is_query]
        ids, x = ids[~is_query], flat[~is_query]
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not len(q_ids) or not len(ids):
            return empty
        # Equal vectors are one point; of their ids the k + 1 smallest can be among the k best.
        _, back = np.unique(np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, 8 * width))).ravel(), return_inverse=True)
        by_point = np.argsort(back, kind="stable")
        begins = np.flatnonzero(np.r_[True, np.diff(back[by_point]) > 0])
        sizes = np.minimum(np.diff(np.r_[begins, len(by_point)]), k + 1)
        in_order = np.argsort(by_point[begins])  # points in the order of their smallest ids
        begins, sizes = begins[in_order], sizes[in_order]
        points = x[by_point[begins]]
        lifted = np.c_[points, np.sqrt(np.maximum(most - (points**2).sum(1), 0))]
        near = min(len(points), k + 2)  # one for the query itself, one for rounding
        hunt = Search(points, q, near, factor, most)
        hunt.visit(Tree(lifted), np.arange(len(q)))
        out_q, out_v, out_s = [], [], []
        for i in range(len(q)):
            own = hunt.where[i][hunt.where[i] >= 0]
            score = (points[own] * q[i]).sum(1)
            members = np.concatenate([by_point[begins[p] : begins[p] + sizes[p]] for p in own])
            score, members = np.repeat(score, sizes[own]), ids[members]
            other = members != q_ids[i]
            score, members = score[other], members[other]
            best = np.lexsort((members, -score))[:k]
            out_q.append(np.full(len(best), q_ids[i])), out_v.append(members[best]), out_s.append(score[best])
        return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})

    found = held.union(posed).groupBy("shard", "block").applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
