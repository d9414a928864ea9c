"""Every registered query against its SQL on the same tables."""

import duckdb
import pytest
from shop import DATA

import __spark_entry__ as entry_point
from orderloom.oracle import all_oracles
from orderloom.registry import all_queries

QUERIES = all_queries()
ORACLES = all_oracles()
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def by_name(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in data)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    relation = duck.sql(ORACLES[name])
    types = {c: TYPES.get(t, t.upper()) for c, t in df.dtypes}
    assert types == {c: str(t) for c, t in zip(relation.columns, relation.types)}
    found = by_name(df.columns, [tuple(r) for r in df.collect()])
    assert found == by_name(relation.columns, duck.execute(ORACLES[name]).fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).columns == [
        "Year", "MonthNumber", "MonthName", "MonthlySales", "RunningTotal", "PrevMonthSales", "MoMChange"]
