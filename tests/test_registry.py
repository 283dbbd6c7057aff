"""The registered queries against DuckDB at the smallest scale, and their coverage."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows),
                  key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_sql():
    assert set(driver.QUERIES) == set(driver.oracle_statements())


@pytest.mark.parametrize("name", sorted(driver.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = driver.queries()[name](spark, FOLDER)
    duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in duck.description]
    assert sorted(df.columns) == sorted(columns)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(columns, duck.fetchall())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["order_month", "gross_revenue_brl", "order_count", "avg_order_value_brl"]
    assert df.count() > 0
