"""Connected components of a graph given by its links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: a node's neighbours (the larger, or it and the smaller ones) link to the least of them.

    A large star makes no more links than it is given, some of them twice; the small star after it drops repeats.
    """
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ends = F.array(*(F.struct(F.col(end).alias("a"), F.col("m").alias("b")) for end in "ba"))
    return joined.select(F.inline(ends)).where("a <> b").distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every node either has one link, to a smaller node, or is only linked to: further steps change nothing."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), (F.col("a") < F.col("b")).alias("wrong"))
    ends = ends.union(links.select("b", F.lit(0), F.lit(False)))
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"), F.max("wrong").alias("wrong"))
    return counted.where("wrong or up > 1 or (up = 1 and n > 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), the root being the component's least node.

    Large-star and small-star steps alternate until the links are stars; each round is
    stored, no row goes to the driver but one that shows that a step is missing. A hot node is met by partial minima and by joins
    that adaptive execution can split. An empty table of links gives an empty result.
    """
    now = stored(links.select("a", "b").where("a <> b").distinct())
    while True:
        now = stored(_star(_star(now, True), False))
        if _stars(now):
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
