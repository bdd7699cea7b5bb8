"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from noticeflow.plans.catalog import QUERIES

from .conftest import SF_SMALL
from .oracle_harness import compare, duck

# The training-data operators are tested in tests/llm.
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(queries())
    missing = set(KEYS) - set(oracle_sql())
    assert not missing, missing


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "recalling_firm_clean" in df.columns


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, SF_SMALL, key, queries()[key], oracle_sql().get(key))
    assert "error" not in r, r
    assert "type_diff" not in r, r
    assert r["match"], r
