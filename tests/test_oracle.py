"""Every registered query against its independent DuckDB SQL at sf0.01."""

import pytest
from data_dirs import SF_ORACLE

from __spark_entry__ import entry, oracle_sql, queries
from tessera.plans.compare import compare, duckdb_connection
from tessera.plans.registry import QUERIES

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_ORACLE), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["cuisine", "restaurant_id", "no_of_orders", "restaurant_rank"]
