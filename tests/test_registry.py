"""Every registered query against its oracle SQL in DuckDB, on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

from lodestream.plans import registry


@pytest.fixture(scope="module")
def oracle(sf):
    c = duckdb.connect()
    for name in os.listdir(sf):
        c.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf}/{name}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES.keys() - registry.ORACLE_SQL.keys()))
def test_query_without_sql(spark, sf, name):
    """These are compared with plain loops in the other tests; here they run and find something."""
    assert registry.QUERIES[name](spark, sf).count() > 0


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query(spark, sf, oracle, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    want = oracle.sql(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE_SQL[name]})")
    assert sorted(oracle.sql(registry.ORACLE_SQL[name]).columns) == columns
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
