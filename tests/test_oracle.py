"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from shiftlake.plans.catalog import QUERIES
from tests.oracle_harness import compare

SF = "/root/testdata/sf0.001"
KEYS = sorted(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, key):
    r = compare(spark, key, SF, E.queries(), E.oracle_sql())
    assert r.get("values_ok"), r


def test_every_query_has_an_oracle():
    """Every workforce query has SQL; the optional ones without it have their own tests."""
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["month", "active_headcount"]
    assert len(rows) > 0
