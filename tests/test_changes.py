"""What a load changed, and the months it touches."""

from datetime import date, datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from cartwheel.operators import changes
from cartwheel.operators import incremental as I
from cartwheel.plans import orders
from cartwheel.session import scratch_path
from cartwheel.workload.inputs import Inputs
from cartwheel.workload.queries import _staged

FOLDER = "/root/testdata/sf0.001"
ROWS = "k string, v int, _loaded_at timestamp"


def keys(before, after):
    return sorted((r.k for r in changes.changed_keys(before, after, "k").collect()), key=str)


def test_keys_whose_rows_differ(spark, frame):
    one, two = datetime(2024, 1, 1), datetime(2024, 1, 2)
    before = frame(ROWS, ("same", 1, one), ("same", 2, one), ("less", 1, one), ("less", 1, one), ("gone", None, one),
                   ("null", None, one), (None, 1, one), ("swapped", 1, one), ("swapped", 4, one))
    after = frame(ROWS, ("same", 2, two), ("same", 1, two), ("less", 1, two), ("null", 0, two), ("new", 1, two),
                  (None, 2, two), ("swapped", 2, two), ("swapped", 3, two))
    assert keys(before, after) == [None, "gone", "less", "new", "null", "swapped"]
    assert keys(before, before.withColumn("_loaded_at", F.lit(two))) == []
    assert keys(before.limit(0), before.limit(0)) == []
    assert keys(before, after.withColumn("more", F.lit("x"))) == keys(before, after)


@pytest.fixture(scope="module")
def now(spark):
    return {name: df.cache() for name, df in _staged(Inputs(spark, FOLDER)).items()}


def refreshed(spark, before, now):
    """The stored mart after the touched months were made anew, those months, and the untouched folders."""
    table = I.sales_table(spark, scratch_path(spark, "sales"))
    I.write_partitioned(orders.sales_builder(**before)(), table)
    old = table.version()
    months = changes.months_to_refresh(before, now)
    I.refresh_months(orders.sales_builder(**now), table, months)
    new = table.version()
    moved = {name for _, name in set(old.parts) ^ set(new.parts)}
    assert moved <= {f"order_month={m}" for m in months}
    full = rows_of(orders.sales_builder(**now)(), "order_id")
    assert rows_of(table.read().drop("order_month"), "order_id") == full
    return months


def an_order(now, month):
    day = F.to_date("purchased_at")
    return now["orders"].where((F.trunc(day, "month") == F.lit(month)) & (F.col("order_status") == "delivered")
                               & F.col("order_id").isin([r.order_id for r in now["reviews"].select("order_id").collect()])
                               ).orderBy("order_id").first().order_id


def test_a_late_review_changes_only_its_month(spark, now):
    order = an_order(now, date(1995, 6, 1))
    before = {**now, "reviews": now["reviews"].where(F.col("order_id") != order)}
    assert refreshed(spark, before, now) == [date(1995, 6, 1)]


def test_an_order_that_moves_touches_both_months(spark, now):
    order = an_order(now, date(1995, 6, 1))
    moved = F.when(F.col("order_id") == order, F.lit(datetime(1996, 2, 3))).otherwise(F.col("purchased_at"))
    before = {**now, "orders": now["orders"].withColumn("purchased_at", moved)}
    assert refreshed(spark, before, now) == [date(1995, 6, 1), date(1996, 2, 1)]


def test_looked_up_tables_reach_their_orders(spark, now):
    product = now["items"].orderBy("product_id").first().product_id
    before = {**now, "products": now["products"].withColumn("category_name_pt", F.when(
        F.col("product_id") == product, "other").otherwise(F.col("category_name_pt")))}
    expected = {r.order_id for r in now["items"].where(F.col("product_id") == product).collect()}
    assert {r.order_id for r in changes.changed_orders(before, now).collect()} == expected and expected
    refreshed(spark, before, now)
    customer = now["orders"].orderBy("customer_id").first().customer_id
    before = {**now, "customers": now["customers"].where(F.col("customer_id") != customer)}
    expected = {r.order_id for r in now["orders"].where(F.col("customer_id") == customer).collect()}
    assert {r.order_id for r in changes.changed_orders(before, now).collect()} == expected and expected
    name = now["categories"].first().category_name_pt
    before = {**now, "categories": now["categories"].where(F.col("category_name_pt") != name)}
    refreshed(spark, before, now)


def test_nothing_changed(spark, now):
    assert changes.changed_orders(now, now).count() == 0
    stamped = {name: df.withColumn("_loaded_at", F.lit(datetime(2030, 1, 1))) for name, df in now.items()}
    assert changes.months_to_refresh(stamped, now) == []
    I.refresh_months(None, None, [])


def test_states_are_compared_in_one_grouping(frame):
    rows = frame(ROWS, ("a", 1, None), ("a", 1, None), ("b", 2, None))
    plan = changes.changed_keys(rows, rows, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "decimal" not in plan and plan.count("Aggregate") == 1
