"""Merkle manifest of a dataset: hash trees per group, one root, and a proof for each row.

Nodes are labelled by the interval of leaf ranks that they cover. A node of level l covers at most
FAN^l leaves, so its interval lies in one bucket of FAN^(l+1) ranks, the interval of its parent: a
containment join on that bucket attaches the parent. The parent's interval less the node's own is
covered by its siblings, left and right. Paths go down from the roots, so that only leaves, with
one row each, meet a whole path; no row is repeated for its ancestors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlab.llm.common import broadcast_if_few, stored
from splitlab.operators.ranking import with_rank

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEAVES_PER_TASK = 500_000
# Groups that may be broadcast with the path of their subroot, a few kB each.
BROADCAST_GROUPS = 10_000


def sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else UTF-8 byte count, ``:`` and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lowered(text: Column) -> Column:
    """A-Z in lower case, other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _interval(level: int) -> tuple[Column, Column]:
    """The interval of ranks [lo, hi) of the level's node that holds ``rank``, in a group of ``n`` leaves."""
    width = F.lit(FAN**level)
    lo = F.floor(F.col("rank") / width).cast("bigint") * width
    return lo, F.least(lo + width, F.col("n"))


def _nodes(leaves: DataFrame, most: int) -> list[DataFrame]:
    """Levels 1, 2, ... of all trees: (grp, n, level, lo, hi, hash, kids), kids being (lo, hi, hash) in order.

    A level holds the nodes of groups that have several nodes on the level below.
    """
    levels, below = [], leaves.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1})
    width = 1
    while width < most:
        width *= FAN
        bucket = F.floor(F.col("lo") / width).cast("bigint")
        several = below.where(F.col("n") > width // FAN)
        kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "hash")))
        level = several.groupBy("grp", bucket.alias("bucket")).agg(F.min("n").alias("n"), kids.alias("kids"))
        hashes = F.concat_ws("", F.transform("kids", lambda k: k["hash"]))
        level = level.select(
            "grp", "n", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
            F.sha2(hashes, 256).alias("hash"), "kids",
        )
        below = stored(level)
        levels.append(below)
    return levels


def _attach(children: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """Children with ``path``: per ancestor, from the parent up, the hashes left and right of the way.

    ``width`` is the most leaves a parent covers. Children that are roots get an empty path.
    """
    bucket = F.floor(F.col("lo") / width).cast("bigint")
    up = parents.select(
        F.col("grp").alias("p_grp"), bucket.alias("p_bucket"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), "kids", F.col("path").alias("p_path")
    )
    mine = children.withColumn("bucket", bucket)
    held = F.col("grp").eqNullSafe(F.col("p_grp")) & (F.col("bucket") == F.col("p_bucket")) & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
    met = mine.join(up, held, "left")

    def beside(left: bool) -> Column:  # the parent's interval less the own one, on one side
        inside = F.filter("kids", lambda k: k["hi"] <= F.col("lo") if left else k["lo"] >= F.col("hi"))
        return F.concat_ws("", F.transform(inside, lambda k: k["hash"]))

    step = F.array(F.struct(beside(True).alias("left"), beside(False).alias("right")))
    none = F.array().cast("array<struct<left:string,right:string>>")
    path = F.when(F.col("p_lo").isNull(), none).otherwise(F.concat(step, F.col("p_path")))
    return met.withColumn("path", path).drop("bucket", "p_grp", "p_bucket", "p_lo", "p_hi", "kids", "p_path")


def _trees(leaves: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Hash trees over (grp, rank, n, hash, ...): the leaves with their paths, and (grp, n, root) of each tree."""
    levels = _nodes(leaves, most)
    whole = (F.col("lo") == 0) & (F.col("hi") == F.col("n"))
    single = leaves.where("n = 1").select("grp", "n", F.col("hash").alias("root"))
    roots = single
    for level in levels:
        roots = roots.unionByName(level.where(whole).select("grp", "n", F.col("hash").alias("root")))
    none = F.array().cast("array<struct<left:string,right:string>>")
    placed = leaves.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1})
    if not levels:
        return placed.withColumn("path", none).drop("lo", "hi"), roots
    above = levels[-1].withColumn("path", none)
    for i in range(len(levels) - 2, -1, -1):
        kids = levels[i].withColumnRenamed("kids", "own_kids")
        above = _attach(kids, above, FAN ** (i + 2)).withColumnRenamed("own_kids", "kids")
    return _attach(placed, above, FAN).drop("lo", "hi"), roots


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the hashes beside its way give."""
    return F.aggregate(path, leaf, lambda h, step: sha(step["left"], h, step["right"]))


def manifest(
    docs: DataFrame, tampered: Column | None = None, *, fields: Sequence[str] = FIELDS, group: str = "source", id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of ``docs``.

    A leaf hashes ``fields``; per ``group`` leaves ascend by ``id`` (NULL first, equal ids by leaf)
    and every FAN consecutive nodes become one until one remains, the subroot. Subroots in order of
    the group (NULL first) give the root alike. Rows with ``tampered`` true prove a leaf whose
    text has A-Z lower-cased; NULL counts as false. A NULL field hashes as ``-``, an empty text as
    ``0:``. Repeated rows are leaves of their own. An empty table gives an empty result. Other
    columns are ignored, whatever their names; a missing one raises.
    """
    changed = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    parts = {f: F.col(f"`{f}`") for f in fields}
    other = {f: lowered(c.cast("string")) if f == text else c for f, c in parts.items()}
    read = docs.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{group}`").alias("grp"), sha(*map(field, parts.values())).alias("hash"),
        F.when(changed, sha(*map(field, other.values()))).alias("tampered"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"),  # so that no run of equal rows is one range
    )
    leaves = stored(read)
    n_tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), leaves.count() // LEAVES_PER_TASK)
    placed = with_rank(leaves, ["grp", "id", "hash", "tie"], "place", n_tasks)
    sizes = stored(placed.groupBy("grp").agg(F.min("place").alias("first"), F.count("*").alias("n")))
    most, n_groups = sizes.agg(F.max("n"), F.count("*")).first()
    few = sizes.withColumnRenamed("grp", "g")
    ranked = placed.join(broadcast_if_few(few), F.col("grp").eqNullSafe(F.col("g"))).withColumn("rank", F.col("place") - F.col("first"))
    ranked = stored(ranked.select("grp", "id", "rank", "n", "hash", "tampered"))
    leaves, subroots = _trees(ranked, most or 0)
    tops = with_rank(subroots.select("grp", F.col("root").alias("hash")), ["grp"], "rank")
    tops = tops.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "rank", F.lit(n_groups).alias("n"), "hash")
    tops, root = _trees(stored(tops), n_groups)
    tops = tops.join(root.select("grp", "root"), "grp").select("name", F.col("hash").alias("subroot"), "root", F.col("path").alias("top"))
    met = leaves.join(broadcast_if_few(tops, BROADCAST_GROUPS), F.col("grp").eqNullSafe(F.col("name")))
    full = met.withColumn("way", F.concat("path", "top"))
    beside = F.concat_ws("", F.transform("way", lambda s: F.concat(s["left"], s["right"])))
    out = full.select(
        F.col("id").alias(id), F.col("hash").alias("leaf"), "subroot", "root", F.sha2(beside, 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "hash"), F.col("way")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
