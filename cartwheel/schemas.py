"""Declared schemas of the raw tables. ``nullable=False`` marks a REQUIRED column."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(spec: str) -> T.StructType:
    """Build a schema from ``name type`` pairs; ``!`` after the type means REQUIRED."""
    kinds = {
        "str": T.StringType(), "int": T.LongType(), "float": T.DoubleType(),
        "ts": T.TimestampType(), "strs": T.ArrayType(T.StringType()),
    }
    fields = []
    for line in spec.strip().splitlines():
        name, kind = line.split()
        fields.append(T.StructField(name, kinds[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


# Column names, types and REQUIRED marks of the source files.
ORDERS = _table("""
    order_id str!
    customer_id str!
    order_status str
    order_purchase_timestamp ts
    order_approved_at ts
    order_delivered_carrier_date ts
    order_delivered_customer_date ts
    order_estimated_delivery_date ts
""")

ORDER_ITEMS = _table("""
    order_id str!
    order_item_id int!
    product_id str
    seller_id str
    shipping_limit_date ts
    price float
    freight_value float
""")

ORDER_PAYMENTS = _table("""
    order_id str!
    payment_sequential int
    payment_type str
    payment_installments int
    payment_value float
""")

CUSTOMERS = _table("""
    customer_id str!
    customer_unique_id str
    customer_zip_code_prefix str
    customer_city str
    customer_state str
""")

SELLERS = _table("""
    seller_id str!
    seller_zip_code_prefix str
    seller_city str
    seller_state str
""")

PRODUCTS = _table("""
    product_id str!
    product_category_name str
    product_name_lenght int
    product_description_lenght int
    product_photos_qty int
    product_weight_g float
    product_length_cm float
    product_height_cm float
    product_width_cm float
""")

REVIEWS = _table("""
    review_id str
    order_id str!
    review_score int
    review_comment_title str
    review_comment_message str
    review_creation_date ts
    review_answer_timestamp ts
""")

PRODUCT_CATEGORIES = _table("""
    product_category_name str!
    product_category_name_english str
""")

MARKETPLACE_PRODUCTS = _table("""
    product_id str
    category_id str
    category_name str
    name str
    status str
    domain_id str
    min_price_ars float
    currency str
    ingested_at ts
""")

QUERY_AUDIT = _table("""
    user_id str
    question str
    generated_sql str
    tables_referenced strs
    tokens_used int
    created_at ts
""")

# The tables loaded from CSV drops, and those whose text may hold line breaks.
CSV_TABLES: dict[str, T.StructType] = {
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "order_payments": ORDER_PAYMENTS,
    "customers": CUSTOMERS,
    "sellers": SELLERS,
    "products": PRODUCTS,
    "reviews": REVIEWS,
    "product_categories": PRODUCT_CATEGORIES,
}
FREE_TEXT_TABLES = frozenset({"reviews"})


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]
