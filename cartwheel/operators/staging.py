"""Staging: one renaming projection per raw table, stamped with the time of the run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import mask_zip


def _stamped(raw: DataFrame, run_ts: datetime, **columns: str | Column) -> DataFrame:
    """Select ``new_name=raw_column`` pairs and add ``_loaded_at``."""
    chosen = [
        (F.col(source) if isinstance(source, str) else source).alias(name)
        for name, source in columns.items()
    ]
    return raw.select(*chosen, F.lit(run_ts).cast("timestamp").alias("_loaded_at"))


def stg_orders(raw: DataFrame, run_ts: datetime) -> DataFrame:
    return _stamped(
        raw, run_ts,
        order_id="order_id",
        customer_id="customer_id",
        order_status="order_status",
        purchased_at="order_purchase_timestamp",
        approved_at="order_approved_at",
        delivered_to_carrier_at="order_delivered_carrier_date",
        delivered_to_customer_at="order_delivered_customer_date",
        estimated_delivery_at="order_estimated_delivery_date",
    )


def stg_customers(raw: DataFrame, run_ts: datetime) -> DataFrame:
    """Holds the zip prefix both masked and raw; later models take only the masked one."""
    return _stamped(
        raw, run_ts,
        customer_id="customer_id",
        customer_unique_id="customer_unique_id",
        zip_code_masked=mask_zip(F.col("customer_zip_code_prefix")),
        zip_code_raw="customer_zip_code_prefix",
        city="customer_city",
        state="customer_state",
    )


def stg_order_items(raw: DataFrame, run_ts: datetime) -> DataFrame:
    return _stamped(
        raw, run_ts,
        order_id="order_id",
        order_item_id="order_item_id",
        product_id="product_id",
        seller_id="seller_id",
        shipping_limit_at="shipping_limit_date",
        price_brl="price",
        freight_brl="freight_value",
        total_brl=F.col("price") + F.col("freight_value"),
    )


def stg_order_payments(raw: DataFrame, run_ts: datetime) -> DataFrame:
    return _stamped(
        raw, run_ts,
        order_id="order_id",
        payment_sequential="payment_sequential",
        payment_type="payment_type",
        installments="payment_installments",
        payment_brl="payment_value",
    )


def stg_products(raw: DataFrame, run_ts: datetime) -> DataFrame:
    return _stamped(
        raw, run_ts,
        product_id="product_id",
        category_name_pt="product_category_name",
        name_length="product_name_lenght",
        description_length="product_description_lenght",
        photos_qty="product_photos_qty",
        weight_g="product_weight_g",
        length_cm="product_length_cm",
        height_cm="product_height_cm",
        width_cm="product_width_cm",
    )


def stg_product_categories(raw: DataFrame, run_ts: datetime) -> DataFrame:
    return _stamped(
        raw, run_ts,
        category_name_pt="product_category_name",
        category_name_en="product_category_name_english",
    )


def stg_reviews(raw: DataFrame, run_ts: datetime) -> DataFrame:
    return _stamped(
        raw, run_ts,
        review_id="review_id",
        order_id="order_id",
        score="review_score",
        comment_title="review_comment_title",
        comment_message="review_comment_message",
        created_at="review_creation_date",
        answered_at="review_answer_timestamp",
    )


def stg_sellers(raw: DataFrame, run_ts: datetime) -> DataFrame:
    return _stamped(
        raw, run_ts,
        seller_id="seller_id",
        zip_code="seller_zip_code_prefix",
        city="seller_city",
        state="seller_state",
    )


def stg_marketplace_products(raw: DataFrame, *run_columns: str) -> DataFrame:
    """Not stamped: the rows carry their own time of ingestion.

    ``run_columns`` are passed through, for drops of several runs read together.
    """
    return raw.select(
        "product_id", "category_id", "category_name",
        F.col("name").alias("product_name"),
        "status", "domain_id",
        F.col("min_price_ars").alias("price_ars"),
        "currency",
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        *run_columns,
    )
