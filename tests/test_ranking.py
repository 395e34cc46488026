"""Global ranks against a sort."""

import pytest
from pyspark.sql import functions as F

from splitlab.operators.ranking import with_rank


@pytest.mark.parametrize("rows", [0, 1, 10_000])
def test_rank_equals_sorted_place(spark, rows):
    df = spark.range(rows).select("id", (F.col("id") * 7919 % 101).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("g"))
    got = [(r.g, r.k, r.id) for r in with_rank(df, [F.col("g").asc_nulls_last(), F.desc("k"), "id"]).orderBy("rank").collect()]
    assert got == sorted(got, key=lambda r: (r[0] is None, r[0] or 0, -r[1], r[2])) and len(got) == rows


def test_ranks_are_dense_and_need_no_single_task(spark):
    ranked = with_rank(spark.range(5000).select((F.col("id") % 7).alias("k"), "id"), ["k", "id"], "place", 16)
    assert sorted(r.place for r in ranked.select("place").collect()) == list(range(5000))
    text = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "SinglePartition" not in text
