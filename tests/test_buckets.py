"""Joins of bucketed tables move no rows."""

import pytest
from conftest import rows_of

from cartwheel.plans import orders
from cartwheel.session import scratch_path
from cartwheel.sources.buckets import BucketedTables, buckets_for
from cartwheel.workload import queries
from cartwheel.workload.inputs import Inputs

FOLDER = "/root/testdata/sf0.001"


def test_the_sales_fact_has_no_exchange_by_order(spark):
    inputs = Inputs(spark, FOLDER)
    given = {"enriched": inputs.orders_enriched(), "items": inputs.items_enriched(), "reviews": inputs.stg_reviews()}
    tables = BucketedTables(spark, scratch_path(spark, "buckets"), 6)
    stored = [tables.store(name, df, "order_id") for name, df in given.items()]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = orders.mart_sales(*stored)
        got = rows_of(sales, "order_id")
        plan = sales._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan and plan.count("Bucketed: true") >= 3
    assert "SortMergeJoin" in plan
    assert got == rows_of(inputs.sales(), "order_id")
    tables.drop()
    with pytest.raises(KeyError):
        tables.table("items")


def test_a_table_stored_again(spark):
    tables = BucketedTables(spark, scratch_path(spark, "buckets"), 3)
    first = tables.store("t", spark.range(5), "id")
    tables.store("t", spark.range(5, 9), "id")
    assert sorted(r.id for r in tables.table("t").collect()) == [5, 6, 7, 8]
    assert first.count() == 5
    with pytest.raises(ValueError):
        BucketedTables(spark, "/x", 0)


def test_buckets_grow_with_the_tables(spark, monkeypatch):
    assert buckets_for(1) == buckets_for(100 << 20) == 8
    assert buckets_for(6 << 30) == 192 and buckets_for(12 << 30) == 384
    given = []
    monkeypatch.setattr(Inputs, "size", lambda self, name: 1 << 30)
    monkeypatch.setattr(queries, "BucketedTables", lambda spark, root, buckets: given.append(buckets) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        queries.QUERIES["j3_bucketed_sales"](spark, FOLDER)
    assert given == [160]
