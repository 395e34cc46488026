"""Exact interpolated quantiles per group, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS_PER_OCTAVE = 64


def _bin(value: Column) -> Column:
    """A monotone bin number: 64 bins per power of two on each side of zero."""
    # Doubles reach down to 2^-1074, so the shifted logarithm is never negative.
    size = F.floor(BINS_PER_OCTAVE * (F.log2(F.abs(value)) + 1080)).cast("int")
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0))


def exact_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys, prob, columns): linear-interpolation quantiles of the finite values of each column.

    Three grouped counts. Values are first counted per bin; the bins that hold the wanted ranks
    are then known exactly, and only their distinct values are ordered. A group of any size
    therefore shrinks to a bounded histogram and to the few bins around its quantiles, and a
    value that fills a third of the rows is one row with a count.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("col"), F.col(c).cast("double").alias("x")) for i, c in enumerate(columns)])
    values = df.select(*keys, F.inline(cells)).where(F.col("x").isNotNull() & (F.abs("x") < float("inf")))
    group = [*keys, "col"]
    counted = values.groupBy(*group, "x").agg(F.count("*").alias("n")).withColumn("bin", _bin(F.col("x")))

    hist = counted.groupBy(*group, "bin").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*group).orderBy("bin"))
    total = F.sum("n").over(Window.partitionBy(*group))
    ranges = hist.select(*group, "bin", (upto - F.col("n")).alias("below"), upto.alias("upto"), total.alias("total"))

    # Position of each quantile among the ordered values, as two neighbouring ranks.
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    at = F.col("prob") * (F.col("total") - 1)
    rank = F.explode(F.array(F.floor(at), F.ceil(at)))
    needed = (
        ranges.withColumn("prob", wanted)
        .select("*", at.alias("at")).select("*", rank.alias("rank"))
        .where((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("upto")))
    )
    bins = needed.select(*group, "bin", "below").distinct()

    ordered = counted.join(bins, [*group, "bin"]).withColumn(
        "end", F.col("below") + F.sum("n").over(Window.partitionBy(*group, "bin").orderBy("x"))
    )
    picks = needed.select(*group, "prob", "at", "rank", "bin").join(
        ordered.select(*group, "bin", "x", "n", "end"), [*group, "bin"]
    ).where((F.col("rank") >= F.col("end") - F.col("n")) & (F.col("rank") < F.col("end")))
    low, high = F.min("x"), F.max("x")
    weight = F.first("at") - F.floor(F.first("at"))
    quantile = picks.groupBy(*group, "prob").agg((low + (high - low) * weight).alias("q"))
    return quantile.groupBy(*keys, "prob").agg(
        *[F.max(F.when(F.col("col") == i, F.col("q"))).alias(c) for i, c in enumerate(columns)]
    )
