"""Seller performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import money_sum, ratio, rounded
from cartwheel.plans.orders import delivered_orders, delivery_measures, review_totals


def seller_sales(items: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """Products, categories and revenue per seller, over items of any order status.

    Items are summed up by seller and product before anything else, so a hot product is
    reduced where it is read and the distinct counts are plain ones. With ``catalogue``
    (product_id, category_name_en) the category is looked up after that, else items have it.
    """
    price = F.col("price_brl")
    keys = ["seller_id", "product_id"] + ([] if catalogue is not None else ["category_name_en"])
    lines = items.groupBy(*keys).agg(money_sum(price).alias("sold"), F.count(price).alias("priced"))
    if catalogue is not None:
        lines = lines.join(catalogue.select("product_id", "category_name_en"), "product_id", "left")
    sold, priced = F.col("sold"), F.col("priced")
    by_category = lines.groupBy("seller_id", "category_name_en").agg(
        F.count("product_id").alias("products"), money_sum(sold).alias("sold"),
        F.sum(priced).alias("priced"))
    return by_category.groupBy("seller_id").agg(
        F.sum("products").alias("unique_products"),
        F.count("category_name_en").alias("categories_count"),
        rounded(money_sum(sold), 2).alias("total_revenue_brl"),
        rounded(ratio(money_sum(sold), F.sum(priced)), 2).alias("avg_item_price_brl"),
    )


def seller_service(items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders, delivery and reviews per seller, from staged items and orders.

    An order counts once per item of the seller, for its delivery as for its
    reviews. Items are therefore counted per seller and order first, and the
    count weighs the order's delivery days and review sums: no item meets a
    review row.
    """
    lines = items.groupBy("seller_id", "order_id").agg(F.count(F.lit(1)).alias("items"))
    delivery = delivered_orders(orders).select("order_id", *delivery_measures()).drop(
        "estimated_delivery_days")
    per_order = (
        lines.join(delivery, "order_id", "left")
        .join(review_totals(reviews), "order_id", "left")
    )
    n, days, on_time = F.col("items"), F.col("actual_delivery_days"), F.col("is_on_time")
    timed = F.nullif(F.sum(F.when(on_time.isNotNull(), n)), F.lit(0))
    reviewed = F.sum(n * F.col("scored"))
    return per_order.groupBy("seller_id").agg(
        F.count("order_id").alias("total_orders"),
        rounded(ratio(F.sum(n * days), F.sum(F.when(days.isNotNull(), n))), 1)
         .alias("avg_delivery_days"),
        rounded(ratio(F.coalesce(F.sum(F.when(on_time, n)), F.lit(0)) * 100, timed), 2)
         .alias("on_time_delivery_rate_pct"),
        rounded(ratio(F.sum(n * F.col("score_sum")), reviewed), 2).alias("avg_review_score"),
        reviewed.alias("reviews_count"),
    )


def mart_sellers(sellers: DataFrame, items: DataFrame, items_enriched: DataFrame | None,
                 orders: DataFrame, reviews: DataFrame,
                 catalogue: DataFrame | None = None) -> DataFrame:
    """One row per seller with at least one item.

    Only the categories need more than staged tables: a ``catalogue`` of products, or items
    that are enriched already.
    """
    sales = seller_sales(items_enriched) if catalogue is None else seller_sales(items, catalogue)
    return (
        sellers.select("seller_id", F.col("city").alias("seller_city"),
                       F.col("state").alias("seller_state"))
        .join(sales, "seller_id")
        .join(seller_service(items, orders, reviews), "seller_id", "left")
        .select(
            "seller_id", "seller_city", "seller_state", "total_orders", "unique_products",
            "categories_count", "total_revenue_brl", "avg_item_price_brl", "avg_delivery_days",
            "on_time_delivery_rate_pct", "avg_review_score", "reviews_count",
        )
    )
