"""Every registered query with SQL equals DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import TABLES, normal

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal(df.collect(), df.columns) == normal(result.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
