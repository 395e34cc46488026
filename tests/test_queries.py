"""Every registered query against its oracle, on the smallest data."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    assert not differences(df, con, entry_point.oracle_sql()[name])[:3]


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql())))
def test_query_runs(spark, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    rows = df.collect()
    assert rows or name.startswith("smart_salt_table")
    doubles = [c for c, t in df.dtypes if t == "double"]
    assert not any(r[c] != r[c] for r in rows for c in doubles if r[c] is not None)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 50


def test_oracles_belong_to_queries():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
