"""Enriched orders and items, and the sales fact."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import days_between, money_sum, month_start, ratio, rounded
from cartwheel.operators import bloom
from cartwheel.session import keep

DELIVERED = "delivered"
#: Orders of a range whose ids Spark is left to broadcast or shuffle by itself.
FEW_IDS = 200_000


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Works on staged and on enriched orders."""
    return orders.where(F.col("order_status") == DELIVERED)


def delivery_measures() -> list[Column]:
    """Days to delivery, estimated days, and whether the order came in time.

    It is on time up to the estimate, NULL while not delivered, and late when
    delivered without an estimate.
    """
    bought, delivered, estimated = (
        F.col(c) for c in ("purchased_at", "delivered_to_customer_at", "estimated_delivery_at"))
    return [
        days_between(delivered, bought).alias("actual_delivery_days"),
        days_between(estimated, bought).alias("estimated_delivery_days"),
        F.when(delivered.isNotNull(), F.coalesce(delivered <= estimated, F.lit(False)))
         .alias("is_on_time"),
    ]


def payment_totals(payments: DataFrame) -> DataFrame:
    """One row per order. The primary type is the last one in the alphabet."""
    return payments.groupBy("order_id").agg(
        money_sum(F.col("payment_brl")).alias("total_payment_brl"),
        F.count(F.lit(1)).alias("payment_count"),
        F.max("payment_type").alias("primary_payment_type"),
    )


def item_totals(items_enriched: DataFrame) -> DataFrame:
    """One row per order. The primary category is the last one in the alphabet."""
    return items_enriched.groupBy("order_id").agg(
        money_sum(F.col("price_brl")).alias("items_value_brl"),
        money_sum(F.col("freight_brl")).alias("freight_value_brl"),
        money_sum(F.col("total_brl")).alias("total_items_brl"),
        F.count_distinct("product_id").alias("unique_products"),
        F.max("category_name_en").alias("primary_category"),
    )


def review_totals(reviews: DataFrame) -> DataFrame:
    """One row per order with the counts that every review average is made of.

    Averages over any set of orders follow from these sums, so reviews meet other
    tables only at order grain.
    """
    score = F.col("score")
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.count(score).alias("scored"),
        F.sum(score).alias("score_sum"),
        F.count_if(score == 5).alias("five_star"),
        F.count_if(score <= 2).alias("low_score"),
    )


def orders_enriched(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their customer, payment totals and delivery measures.

    An order without payments has a total of 0 and no payment count.
    """
    who = customers.select(
        "customer_id", "customer_unique_id",
        F.col("city").alias("customer_city"), F.col("state").alias("customer_state"))
    return (
        orders.join(who, "customer_id", "left")
        .join(payment_totals(payments), "order_id", "left")
        .select(
            "order_id", "customer_id", "customer_unique_id", "order_status", "purchased_at",
            "approved_at", "delivered_to_carrier_at", "delivered_to_customer_at",
            "estimated_delivery_at", "customer_city", "customer_state",
            F.coalesce("total_payment_brl", F.lit(0.0)).alias("total_payment_brl"),
            "payment_count", "primary_payment_type",
            *delivery_measures(),
            F.to_date("purchased_at").alias("order_date"),
        )
    )


def catalogue(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with the category in English where there is one.

    A category is shared by many items, and products are the smaller table: categories meet
    products, not items.
    """
    return products.join(categories.select("category_name_pt", "category_name_en"),
                         "category_name_pt", "left").select(
        "product_id", "category_name_pt",
        F.coalesce("category_name_en", "category_name_pt").alias("category_name_en"),
        "weight_g", "photos_qty")


def order_items_enriched(items: DataFrame, products: DataFrame,
                         categories: DataFrame) -> DataFrame:
    """Items with product attributes and the category in English where there is one."""
    return items.join(catalogue(products, categories), "product_id", "left").select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_at",
        "price_brl", "freight_brl", "total_brl",
        "category_name_pt", "category_name_en", "weight_g", "photos_qty")


def mart_sales(orders_enriched: DataFrame, items_enriched: DataFrame,
               reviews: DataFrame) -> DataFrame:
    """Sales fact, one row per delivered order; items and reviews are summed up first."""
    ratings = review_totals(reviews).select(
        "order_id", "review_count",
        rounded(ratio(F.col("score_sum"), F.col("scored")), 1).alias("review_score"))
    return (
        delivered_orders(orders_enriched)
        .join(item_totals(items_enriched), "order_id", "left")
        .join(ratings, "order_id", "left")
        .select(
            "order_id", "customer_id", "customer_unique_id", "order_date", "purchased_at",
            "delivered_to_customer_at", "customer_city", "customer_state", "primary_category",
            "items_value_brl", "freight_value_brl", "total_payment_brl", "unique_products",
            "actual_delivery_days", "estimated_delivery_days", "is_on_time", "review_score",
            "review_count", "primary_payment_type",
        )
    )


def sales_builder(orders: DataFrame, customers: DataFrame, payments: DataFrame,
                  items: DataFrame, products: DataFrame, categories: DataFrame,
                  reviews: DataFrame, few_ids: int = FEW_IDS) -> Callable[..., DataFrame]:
    """The sales fact of a range of order dates, or of single months, from staged tables.

    Orders are cut to the range first and every other table to those orders, so
    products are looked up, and payments and reviews summed, for the range alone. The cut
    orders are stored, so they are read once and Spark knows their size: for a short range it
    broadcasts their ids, and items, payments and reviews are filtered where they are read
    instead of being shuffled whole. With more than ``few_ids`` orders a Bloom filter of their ids, of
    bounded size, leaves out most other rows before the shuffle.
    """
    def build(start: date | None = None, end: date | None = None,
              months: Sequence[date] | None = None) -> DataFrame:
        if start is None and end is None and months is None:
            return mart_sales(
                orders_enriched(orders, customers, payments),
                order_items_enriched(items, products, categories), reviews)
        day = F.to_date("purchased_at")
        cut = delivered_orders(orders)
        if start is not None:
            cut = cut.where(day >= F.lit(start))
        if end is not None:
            cut = cut.where(day <= F.lit(end))
        if months is not None:
            cut = cut.where(month_start(day).isin(list(months)))
        cut = keep(cut, "range-orders")
        ids, n = cut.select("order_id"), cut.count()
        words = bloom.words_for(n)
        bits = keep(bloom.key_filter(ids, "order_id", words), "range-bits") if n > few_ids else None

        def of_range(table: DataFrame) -> DataFrame:
            rows = table if bits is None else bloom.may_match(table, "order_id", bits, words)
            return rows.join(ids, "order_id", "left_semi")

        return mart_sales(
            orders_enriched(cut, customers, of_range(payments)),
            order_items_enriched(of_range(items), products, categories),
            of_range(reviews))
    return build
