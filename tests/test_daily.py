import os
from datetime import date, datetime

import pytest

from cartwheel.operators import history as H
from cartwheel.operators import quality as Q
from cartwheel.plans.daily import refresh_marts
from cartwheel.session import keep, scratch_path
from cartwheel.sources.catalog import Tables
from cartwheel.workload.inputs import ORDERS_AS_OF, Inputs
from conftest import rows_of
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture
def tables(spark):
    inputs, tables = Inputs(spark, FOLDER), Tables(spark, scratch_path(spark, "daily"))
    for name, df in inputs.raw_csv_tables().items():
        tables.materialize(name, df, "raw")
    return inputs, tables


def load_products(inputs, tables, day):
    drop = inputs.marketplace_drops().where(F.to_date("run_ts") == F.lit(day)).drop("run_ts")
    tables.materialize("marketplace_products", drop, "raw")


def test_two_days_build_all_marts(spark, tables):
    inputs, tables = tables
    load_products(inputs, tables, date(2024, 1, 1))
    report = refresh_marts(tables, datetime(2024, 1, 1), ORDERS_AS_OF)
    assert report.where("status <> 'pass'").count() == 0 and report.count() == 44
    load_products(inputs, tables, date(2024, 1, 2))
    full = keep(tables.table("mart_sales", "marts"), "full")
    refresh_marts(tables, datetime(2024, 1, 2), ORDERS_AS_OF, datetime(2024, 1, 1),
                  incremental_sales=True)
    assert rows_of(tables.table("mart_sales", "marts"), "order_id") == rows_of(full, "order_id")
    history = H.read_history(spark, tables.path("snap_products", "snapshots"),
                             datetime(2024, 1, 2))
    assert history.select("dbt_valid_from").distinct().count() == 2
    assert tables.table("mart_price_history", "marts").count() == history.count()
    assert tables.table("mart_sales", "marts").count() == inputs.sales().count()
    with pytest.raises(ValueError, match="does not follow"):
        refresh_marts(tables, datetime(2024, 1, 2), ORDERS_AS_OF, datetime(2024, 1, 2))
    days = spark.sql("SELECT count(*) AS n FROM mart_sales JOIN dim_date ON order_date = date_day")
    assert days.columns == ["n"]


def test_bad_raw_tables_stop_the_build(spark, tables):
    inputs, tables = tables
    load_products(inputs, tables, date(2024, 1, 1))
    twice = inputs.raw_orders().unionByName(inputs.raw_orders())
    tables.materialize("orders", twice, "raw")
    with pytest.raises(Q.ChecksFailed, match="orders.unique_order_id"):
        refresh_marts(tables, datetime(2024, 1, 1), ORDERS_AS_OF)
    with pytest.raises(Exception):
        tables.table("mart_sales", "marts")


def test_marts_with_versions(spark, tables):
    """Marts as tables with versions: a reader of the first day keeps it through the second."""
    inputs, plain = tables
    versioned = Tables(spark, plain.root, versioned=True)
    load_products(inputs, versioned, date(2024, 1, 1))
    refresh_marts(versioned, datetime(2024, 1, 1), ORDERS_AS_OF)
    sales, prices = (versioned.table(name, "marts") for name in ("mart_sales", "mart_price_history"))
    before = prices.count()
    load_products(inputs, versioned, date(2024, 1, 2))
    refresh_marts(versioned, datetime(2024, 1, 2), ORDERS_AS_OF, datetime(2024, 1, 1), incremental_sales=True)
    assert prices.count() == before < versioned.table("mart_price_history", "marts").count()
    assert rows_of(versioned.table("mart_sales", "marts"), "order_id") == rows_of(sales, "order_id")
    assert versioned.target("mart_sales", "marts").version().number == 2
