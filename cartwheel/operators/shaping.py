"""Shaping marketplace replies into product rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How many categories and products per category one run takes.
MAX_CATEGORIES = 5
MAX_PRODUCTS_PER_CATEGORY = 10
CURRENCY = "ARS"


def first_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, key: str, order: list[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group in the given order.

    Spark keeps only ``n`` rows per group in each task before the shuffle, so a
    large group does not travel.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def min_listing_price(results: Column) -> Column:
    """Lowest price in an array of listings, leaving out missing and zero prices."""
    prices = F.transform(results, lambda listing: listing["price"])
    return F.array_min(F.filter(prices, lambda p: p.isNotNull() & (p != 0)))


def min_price_by_product(listings: DataFrame) -> DataFrame:
    """The same for flat listings; a product without a usable price has no row."""
    return (
        listings.where(F.col("price").isNotNull() & (F.col("price") != 0))
        .groupBy("product_id").agg(F.min("price").alias("min_price_ars"))
    )


def build_products(categories: DataFrame, highlights: DataFrame, details: DataFrame,
                   listings: DataFrame, run_ts: datetime,
                   max_categories: int = MAX_CATEGORIES,
                   max_products: int = MAX_PRODUCTS_PER_CATEGORY) -> DataFrame:
    """Product rows of one run: first categories, their top products, details, lowest price.

    A product without detail is dropped, one without a price is kept. A product
    listed in two categories stays twice. At most ``max_categories * max_products``
    rows are selected, so the selection is broadcast to the large tables.
    """
    picked = first_n(categories, max_categories, "position", "id").select(
        F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    top = top_n_per_group(
        highlights.join(F.broadcast(picked), "category_id"),
        "category_id", ["position", "product_id"], max_products,
    ).select("category_id", "category_name", "product_id")
    ids = F.broadcast(top.select("product_id").distinct())
    known = details.join(ids, "product_id", "left_semi").select(
        "product_id", "name", "status", "domain_id")
    prices = min_price_by_product(listings.join(ids, "product_id", "left_semi"))
    return (
        top.join(known, "product_id")
        .join(prices, "product_id", "left")
        .select(
            "product_id", "category_id", "category_name", "name", "status", "domain_id",
            "min_price_ars", F.lit(CURRENCY).alias("currency"),
            F.lit(run_ts).cast("timestamp").alias("ingested_at"),
        )
    )
