"""One day's refresh: raw tables to histories, staging, marts, with checks between."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame

from cartwheel.operators import history as H
from cartwheel.operators import incremental as I
from cartwheel.operators import quality as Q
from cartwheel.operators import staging as S
from cartwheel.plans import calendar, customers, orders, prices, sellers
from cartwheel.session import in_parallel, scratch_scope, tune
from cartwheel.sources.catalog import Tables


def refresh_marts(tables: Tables, run_ts: datetime, as_of: date,
                  previous_run: datetime | None = None,
                  incremental_sales: bool = False, look_back_months: int = 0) -> DataFrame:
    """Build everything from the raw tables of ``tables`` for one day.

    The sales fact is stored by month. With ``incremental_sales`` it is recomputed
    from its last month on, or from ``look_back_months`` earlier: orders of older months
    that are delivered later, and their late payments and reviews, then wait for a
    backfill or a full build.

    Histories come first, then staging; the raw tables must pass their checks
    before any mart is built, and the marts theirs before this returns. Enriched
    orders and items are stored, as several marts read them; the marts can be asked
    for in ``spark.sql`` by name. ``previous_run`` is the ``run_ts`` of the last run, None
    for the first. Intermediate copies are deleted at the end. Returns the report on the marts.
    """
    with scratch_scope(tune(tables.spark)):
        return _refresh(tables, run_ts, as_of, previous_run, incremental_sales, look_back_months)


def _refresh(tables: Tables, run_ts: datetime, as_of: date, previous_run: datetime | None,
             incremental_sales: bool, look_back_months: int) -> DataFrame:
    spark = tables.spark
    raw = {name: tables.table(name) for name in (
        "orders", "order_items", "order_payments", "customers", "sellers", "products", "reviews",
        "product_categories", "marketplace_products")}

    stg_products = S.stg_marketplace_products(raw["marketplace_products"])
    stg_sellers = S.stg_sellers(raw["sellers"], run_ts)
    for spec, current in ((H.SNAP_PRODUCTS, stg_products), (H.SNAP_SELLERS, stg_sellers)):
        H.record_run(spec, tables.path(spec.name, "snapshots"), current, run_ts, previous_run)

    Q.gate(Q.SOURCE_SUITE, raw)

    stg_orders = S.stg_orders(raw["orders"], run_ts)
    stg_customers = S.stg_customers(raw["customers"], run_ts)
    payments = S.stg_order_payments(raw["order_payments"], run_ts)
    items = S.stg_order_items(raw["order_items"], run_ts)
    products = S.stg_products(raw["products"], run_ts)
    categories = S.stg_product_categories(raw["product_categories"], run_ts)
    reviews = S.stg_reviews(raw["reviews"], run_ts)
    enriched = tables.materialize(
        "orders_enriched", orders.orders_enriched(stg_orders, stg_customers, payments), "marts")
    items_enriched = tables.materialize(
        "order_items_enriched", orders.order_items_enriched(items, products, categories), "marts")

    sales_target = tables.target("mart_sales", "marts", I.MONTH_COLUMN)
    if incremental_sales:
        build = orders.sales_builder(stg_orders, stg_customers, payments, items, products,
                                     categories, reviews)
        I.incremental_refresh(spark, build, sales_target, look_back_months)
    else:
        I.write_partitioned(orders.mart_sales(enriched, items_enriched, reviews), sales_target)
    sales = tables.table("mart_sales", "marts")
    lifetime = customers.customers_lifetime(enriched, as_of)
    snap_products = H.read_history(spark, tables.path("snap_products", "snapshots"), run_ts)
    models = {
        "mart_customers": customers.mart_customers(lifetime, enriched, reviews),
        "mart_cohorts": customers.mart_cohorts(enriched),
        "mart_sellers": sellers.mart_sellers(stg_sellers, items, None, stg_orders, reviews,
                                             orders.catalogue(products, categories)),
        "mart_customer_features": customers.mart_customer_features(sales, reviews, as_of),
        "mart_price_history": prices.mart_price_history(snap_products, as_of),
        "dim_date": calendar.dim_date(spark),
    }
    marts = {}
    for name, stored in in_parallel(spark, {
            name: lambda name=name, df=df: tables.materialize(name, df, "marts")
            for name, df in models.items()}).items():
        if isinstance(stored, BaseException):
            raise stored
        marts[name] = stored
    tables.register(["mart_sales", *marts], "marts")
    return Q.gate(
        Q.Suite(Q.MART_SUITE.columns, (*Q.MART_SUITE.models, Q.volume_check(as_of))),
        {"mart_sales": sales, "snap_products": snap_products, **marts})
