"""Every registered query with oracle SQL must equal DuckDB on the same tables."""

import pytest

from conftest import SF0001, SF001
from docketflow.oracle import oracle_queries
from docketflow.plans.registry import BATCH_QUERIES
from oracle_compare import compare

ORACLE = oracle_queries()
BATCH_KEYS = [k for k in BATCH_QUERIES if k in ORACLE]
STREAM_KEYS = [k for k in ORACLE if k not in BATCH_QUERIES]


def test_every_batch_query_has_oracle():
    assert set(BATCH_QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_batch_query_matches_oracle(spark, duck001, key):
    ok, msg = compare(spark, key, SF001, con=duck001)
    assert ok, msg


@pytest.mark.parametrize("key", STREAM_KEYS)
def test_stream_query_matches_oracle(spark, duck0001, key):
    ok, msg = compare(spark, key, SF0001, con=duck0001)
    assert ok, msg


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "matter_id"
