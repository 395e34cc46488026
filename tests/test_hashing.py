import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from splitlab.functions import hashing
from splitlab.operators.groups import assign_units
from splitlab.sources.salts import generate_salts, top_salts
from twins import slot


def test_bucket_equals_hashlib(spark):
    units = spark.range(500).select((F.col("id") * 7919).alias("unit_id"))
    got = units.select("unit_id", hashing.hash_slot(F.col("unit_id"), F.lit("B0131007"), 20).alias("s")).collect()
    assert all(row.s == slot(row.unit_id, "B0131007", 20) for row in got)


def test_weights_pick_the_first_bucket_above_the_slot():
    assert hashing.bucket_of_slot([2, 0, 3]) == [0, 0, 2, 2, 2]
    assert hashing.group_of_bucket([2, 2, 3]) == [0, 0, 1, 1, 2, 2, 2]
    assert hashing.group_of_slot([1, 2, 1], [1, 2]) == [0, 1, 1, 1]
    with pytest.raises(ValueError):
        hashing.group_of_slot([1] * 10, [2, 3])
    with pytest.raises(ValueError):
        hashing.bucket_of_slot([0, 0])


def test_assignment_ignores_partitioning_and_null_units(spark):
    salts = generate_salts(spark, "B", "2024-01-31", 7)
    units = spark.range(300).select(F.when(F.col("id") != 5, F.col("id")).alias("unit_id"))
    results = [
        {(r.unit_id, r.salt): r.bucket for r in assign_units(units.repartition(n), salts, [2, 3, 5]).collect()}
        for n in (1, 5)
    ]
    assert results[0] == results[1] and len(results[0]) == 299 * 7
    expected = hashing.bucket_of_slot([2, 3, 5])
    assert all(b == expected[slot(u, s, 10)] for (u, s), b in results[0].items())


def test_group_shares_follow_the_weights(spark):
    rows = spark.range(20_000).select(hashing.assign_group(F.col("id"), F.lit("S1"), [2, 3, 5]).alias("b")).collect()
    counts = Counter(r.b for r in rows)
    assert all(abs(counts[b] / 20_000 - w / 10) < 0.02 for b, w in enumerate([2, 3, 5]))


def test_salt_text(spark):
    salts = [r.salt for r in generate_salts(spark, "B", "2019-03-01", 2000).df.orderBy("salt_id").collect()]
    assert salts[0] == "B03010000" and salts[1999] == "B03011999" and len(set(salts)) == 2000


def test_cut_salts_collide(spark):
    with pytest.raises(ValueError):
        generate_salts(spark, "B", "2019-03-01", 100_000)
    salts = generate_salts(spark, "B", "2019-03-01", 100_000, allow_duplicates=True)
    assert salts.df.select("salt").distinct().count() == 10_000
    assert not hashing.salts_collide("B", 99_999)


def test_top_salts_put_undefined_losses_last(spark):
    rows = [("c", 2.0), ("b", 1.0), ("a", 1.0), ("d", None)]
    top = top_salts(spark.createDataFrame(rows, "salt string, pae double"), 4).df.orderBy("salt_id").collect()
    assert [r.salt for r in top] == ["a", "b", "c", "d"]


def test_digest_slice_is_the_last_four_hex_digits():
    digest = hashlib.md5(b"1B").hexdigest()
    assert slot(1, "B", 65536) == int(digest[-4:], 16)
