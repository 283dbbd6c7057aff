"""The models on copies of the tables in which one key holds a third of the rows."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from test_registry import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

HOT = {
    "orders": "CASE WHEN hash(o_orderkey) % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey",
    "lineitem": """
        CASE WHEN hash(l_orderkey, l_partkey) % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN hash(l_partkey, l_suppkey) % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey,
        CASE WHEN hash(l_suppkey, l_orderkey) % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey""",
    "events": "CASE WHEN hash(event_id) % 3 = 0 THEN 1 ELSE user_id END AS user_id",
}
MODELS = [
    "m1_orders_enriched", "m3_customers_lifetime", "m4_mart_sales", "m5_mart_customers",
    "m6_mart_cohorts", "m7_mart_sellers", "m8_mart_customer_features", "m9_mart_price_history",
    "h1_snapshot_run", "q2_unique", "q9_relationships", "d8_price_gallery", "r4_marketplace_products",
    "i3_incremental_refresh", "n1_global_ntile",
]


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    con = duckdb.connect()
    for name in TABLES:
        replaced = f" REPLACE ({HOT[name]})" if name in HOT else ""
        con.execute(f"COPY (SELECT *{replaced} FROM '{FOLDER}/{name}.parquet') "
                    f"TO '{folder}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return folder, con


@pytest.mark.parametrize("name", MODELS)
def test_hot_keys_change_nothing(spark, hot, name):
    folder, con = hot
    df = driver.queries()[name](spark, folder)
    con.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in con.description]
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(columns, con.fetchall())


def test_hot_product_is_split(spark, hot):
    """The item totals reuse the partitions of the join, and the join is split all the same."""
    folder, _ = hot
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.files.maxPartitionBytes": "16KB",
        "spark.sql.files.openCostInBytes": "1KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        from cartwheel.plans import orders
        from cartwheel.session import keep
        from cartwheel.workload.inputs import Inputs
        inputs = Inputs(spark, folder)
        items = keep(inputs.stg_order_items().repartition(8), "items")
        df = orders.item_totals(orders.order_items_enriched(
            items, inputs.stg_products(), inputs.stg_product_categories()))
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "skew=true" in final
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
