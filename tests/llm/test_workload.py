"""The registered queries of the subpackage against their SQL, where they have one."""

import duckdb
import pytest
from test_registry import FOLDER, TABLES, canonical

import __spark_entry__ as driver
from cartwheel.llm.workload import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    duck.execute(ORACLES[name])
    columns = [c[0] for c in duck.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, duck.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_has_its_rows(spark, name):
    rows = QUERIES[name](spark, FOLDER)
    whole = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    if name not in ("op1_benchmark_leaks", "op2_chat_windows", "op13_search"):
        assert rows.count() == whole
    else:
        assert rows.count() > 0
