"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from stratalake.registry import oracles, queries
from tools.check import TABLES, compare

QUERIES = {name: query for name, query in entry.queries().items() if name in queries.registered()}
SQL = oracles.sql_by_query()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    verdict, _ = compare(spark, duck, SF, name, QUERIES[name], SQL[name])
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry.entry(spark).columns == ["Ano", "Categoria", "Produto", "TotalVendas"]
