"""Mixing sources to target weights by thresholds on hashes: built-in expressions only.

A source whose target holds q times its size and a rest takes every document q times, and once
more those whose key, 120 bits of a digest of id and text, lies below the source's threshold. The
threshold comes from histograms: sizes are added up by source and the first bits of the key, the
bucket in which the running sum passes the rest is the boundary, and only its documents are read
for the next bits. Sources nest their own thresholds in one pass. No table is sorted; a window
runs over at most 2^BITS sums of one source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splitlab.llm.common import broadcast_if_few, stored
from splitlab.operators.ranking import with_rank

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BITS = 12
# The key: two words of 60 bits from a digest of the row, and one of 60 bits for rows alike.
WORD_BITS, WORDS = 60, ("h0", "h1", "h2")
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def _hex_word(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, WORD_BITS // 4), 16, 10).cast("bigint")


def keys(id: Column, text: Column) -> dict[str, Column]:
    """The key of a row. Rows alike in id and text differ in ``h2`` only, so which of them is taken shows in no result."""
    value = F.concat(F.coalesce(id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))
    digest = F.md5(value)
    return {
        "h0": _hex_word(digest, 1), "h1": _hex_word(digest, 16),
        "h2": F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << WORD_BITS) - 1)),
    }


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target): shares of the whole by weight, none above ``most`` times the source.

    ``sizes`` is (source, source_size), one row a source. Sources by code point, NULL last, take the
    weights in turn. A source that would be above its limit gets the limit, and the rest is shared by weight again among the
    others. That is done at once: in order of limit over weight, the sources at their limit come first, so each
    source is tried as the last of them, by running sums.
    """
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = with_rank(sizes, [F.col("source").asc_nulls_last()], "turn").withColumn("w", F.element_at(turn, (F.col("turn") % len(weights) + 1).cast("int")))
    # Sources in order of limit over weight, in blocks: sums per block are few, sums in a block need one task each.
    ranked = with_rank(ranked.withColumn("limit", F.col("source_size") * most), [F.col("limit") / F.col("w"), "turn"], "at")
    ranked = ranked.withColumn("block", F.floor(F.col("at") / 4096))
    blocks = ranked.groupBy("block").agg(F.sum("limit").alias("b_limit"), F.sum("w").alias("b_w"), F.sum("source_size").alias("b_size"))
    others = blocks.select(F.col("block").alias("o"), "b_limit", "b_w", "b_size")
    earlier = blocks.select("block").join(F.broadcast(others), F.lit(True)).groupBy("block").agg(
        *[F.coalesce(F.sum(F.when(F.col("o") < F.col("block"), F.col(f"b_{c}"))), F.lit(0)).alias(f"before_{c}") for c in ("limit", "w")],
        F.sum("b_size").alias("total"), F.sum("b_w").alias("all_w"),
    )
    inside = Window.partitionBy("block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    run = ranked.join(earlier, "block").withColumns({
        f"low_{c}": F.col(f"before_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in ("limit", "w")
    })
    # The share of a unit of weight if exactly the sources before this one are at their limit.
    level = (F.col("total") - F.col("low_limit")) / (F.col("all_w") - F.col("low_w"))
    tried = run.withColumn("free", level * F.col("w") <= F.col("limit"))
    facts = tried.agg(F.min(F.when(F.col("free"), F.struct("at", "total", "low_limit", "all_w", "low_w"))).alias("f"))
    facts = facts.select(F.coalesce(F.col("f.at"), F.lit(2**62)).alias("from"), F.col("f.total") - F.col("f.low_limit"), F.col("f.all_w") - F.col("f.low_w")).first()
    first, left, weight = facts
    share = F.lit(float(left or 0)) * F.col("w") / F.lit(float(weight or 1))
    target = F.when(F.col("at") < first, F.col("limit").cast("double")).otherwise(share)
    return ranked.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _bucket(step: int) -> Column:
    """Bits ``step * BITS`` on of the key."""
    word, at = divmod(step * BITS, WORD_BITS)
    return F.shiftright(F.col(WORDS[word]), WORD_BITS - BITS - at).bitwiseAND(F.lit((1 << BITS) - 1))


def thresholds(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, path): the threshold of each source as buckets of BITS bits, first ones first.

    ``docs`` is (source, size, key words), ``plan`` (source, rest): words to take beyond whole repeats. Documents whose
    buckets lie below the path are taken. At the end of the path, where a bucket has one document left, that one is
    taken if more than half of it fits.
    """
    sources = plan.where("rest > 0").select(F.col("source").alias("s"), "rest", F.array().cast("array<bigint>").alias("path"))
    done, open_ = None, sources
    left = docs.where("size > 0")
    for step in range(len(WORDS) * WORD_BITS // BITS):
        # The documents of the boundary buckets, few after the first step.
        met = left.join(broadcast_if_few(open_), F.col("source").eqNullSafe(F.col("s")))
        if step:
            met = met.where(_bucket(step - 1) == F.element_at("path", -1))
            left = met = stored(met.select("source", "size", *WORDS, "s", "rest", "path"))
            left = left.drop("s", "rest", "path")
        sums = met.groupBy("source", _bucket(step).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"), F.first("rest").alias("rest"), F.first("path").alias("path")
        )
        run = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("words").over(run))
        # The boundary is the first bucket whose running sum passes the rest; without one, all is taken.
        chosen = sums.groupBy("source").agg(
            F.min(F.when(F.col("upto") > F.col("rest"), F.struct("bucket", "upto", "words", "n"))).alias("b"), F.first("rest").alias("rest"), F.first("path").alias("path")
        )
        rest = F.col("rest") - (F.col("b.upto") - F.col("b.words"))
        single = F.col("b.n") == 1
        end = F.when(F.col("b").isNull(), F.lit(1 << BITS)).when(single & (rest * 2 > F.col("b.words")), F.col("b.bucket") + 1).otherwise(F.col("b.bucket"))
        chosen = stored(chosen.select(
            F.col("source").alias("s"), rest.alias("rest"), F.concat("path", F.array(end.cast("bigint"))).alias("path"), (F.col("b").isNull() | single).alias("over")
        ))
        ready = chosen.where("over").select("s", "path")
        done = ready if done is None else done.unionByName(ready)
        open_ = chosen.where("not over").select("s", "rest", "path")
        if not open_.take(1):
            break
    else:  # equal keys to the last bit: none of them
        done = done.unionByName(open_.select("s", "path"))
    return done.select(F.col("s").alias("source"), "path")


def _below(path: Column) -> Column:
    """Whether the key lies below a path of buckets; a path ends with its first bucket that differs."""
    buckets = F.array(*[_bucket(i) for i in range(len(WORDS) * WORD_BITS // BITS)])
    own = F.slice(buckets, F.lit(1), F.size(path))
    differing = F.filter(F.zip_with(own, path, lambda a, b: F.signum((a - b).cast("double"))), lambda d: d != 0)
    return F.coalesce(F.get(differing, F.lit(0)) < 0, F.lit(False))


def mixed(
    docs: DataFrame, *, id: str = "doc_id", source: str = "source", text: str = "text", weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS,
) -> DataFrame:
    """(id, size, source_size, target, taken), one row per row of ``docs``.

    ``size`` counts the words of the text (NULL: 0); ``target`` is the source's share of all words, see ``targets``;
    ``taken`` is size times the number of times that the mix takes the document, 0 to ``most``. A source's taken
    words differ from its target by at most half of one document. The choice depends on id and text only, so reruns
    agree; rows repeated in full are taken as often as needed, whichever of them. NULL ids and sources are values like others. An empty table gives an empty
    result. Other columns are ignored.
    """
    if most < 1 or any(w <= 0 for w in weights):
        raise ValueError("weights must be above 0 and repeats at least 1")
    columns = {"id": F.col(f"`{id}`"), "source": F.col(f"`{source}`"), "size": word_count(F.col(f"`{text}`")), **keys(F.col(f"`{id}`"), F.col(f"`{text}`"))}
    rows = stored(docs.select(*[c.alias(n) for n, c in columns.items()]))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = targets(sizes, weights, most)
    # Whole repeats; a target of exactly the limit leaves no rest.
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    plan = stored(shares.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    paths = thresholds(rows, plan).withColumnRenamed("source", "s")
    plan = plan.join(paths, F.col("source").eqNullSafe(F.col("s")), "left").select(F.col("source").alias("p"), "source_size", "target", "whole", "path")
    met = rows.join(broadcast_if_few(plan), F.col("source").eqNullSafe(F.col("p")))
    times = F.col("whole") + F.when(F.col("path").isNotNull() & _below(F.col("path")), 1).otherwise(0)
    return met.select(F.col("id").alias(id), "size", "source_size", "target", (F.col("size") * times).cast("bigint").alias("taken"))
