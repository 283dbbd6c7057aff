"""The test tables renamed to the raw schemas.

Every column is a formula of columns of one row, written again in SQL in
``oracles.py``. Rules that make a value NULL or another status are there so that
the branches of the models are taken; no row is left out.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators import history as H
from cartwheel.operators import staging as S
from cartwheel.plans import calendar, customers, orders, prices, sellers
from cartwheel.session import keep, tune
from cartwheel.sources.replace import Folders

RUN_TS = datetime(2024, 1, 31)
ORDERS_AS_OF = date(2001, 8, 2)
PRICES_AS_OF = date(2024, 1, 31)

# Texts of the generated statements in the query log.
LOG_TABLES = ["mart_sales", "mart_cohorts", "MART_SELLERS", "mart_price_history", "dim_date",
              "mart_customers", "raw_orders"]


class Inputs:
    """Raw tables, staging models and marts over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def size(self, name: str) -> int:
        """Bytes of a stored table, 1 at least."""
        path = f"{self.folder}/{name}.parquet"
        return max(1, sum(Folders(self.spark, path).data_files(path).values()))

    # --- raw tables ------------------------------------------------------

    def raw_orders(self) -> DataFrame:
        status = F.col("o_orderstatus")
        bought = F.col("o_orderdate").cast("timestamp")

        def after(days: Column) -> Column:
            return F.timestamp_add("DAY", days, bought)

        return self.source("orders").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.when(status == "F", "delivered").otherwise(
                F.when(status == "O", "shipped").otherwise(F.when(status == "P", "processing")))
             .alias("order_status"),
            bought.alias("order_purchase_timestamp"),
            F.when(status != "P", after(F.lit(1))).alias("order_approved_at"),
            F.when(status != "P", after(F.lit(3))).alias("order_delivered_carrier_date"),
            F.when((status == "F") & (F.col("o_orderkey") % 97 != 0),
                   after((F.col("o_orderkey") % 21 + 5).cast("int")))
             .alias("order_delivered_customer_date"),
            after((F.col("o_custkey") % 15 + 10).cast("int"))
             .alias("order_estimated_delivery_date"),
        )

    def _places(self) -> DataFrame:
        nation, region = self.source("nation"), self.source("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("state"))

    def raw_customers(self) -> DataFrame:
        key = F.col("c_custkey")
        zip_code = F.lpad((key * 37 % 100000).cast("string"), 5, "0")
        base = self.source("customer")
        places = self._places()
        return base.join(places, base.c_nationkey == places.n_nationkey).select(
            key.cast("string").alias("customer_id"),
            F.expr("cast(c_custkey div 2 as string)").alias("customer_unique_id"),
            F.when(key % 101 != 0, zip_code).alias("customer_zip_code_prefix"),
            F.col("city").alias("customer_city"),
            F.col("state").alias("customer_state"),
        )

    def raw_sellers(self) -> DataFrame:
        key = F.col("s_suppkey")
        base = self.source("supplier")
        places = self._places()
        return base.join(places, base.s_nationkey == places.n_nationkey).select(
            key.cast("string").alias("seller_id"),
            F.lpad((key * 37 % 100000).cast("string"), 5, "0").alias("seller_zip_code_prefix"),
            F.col("city").alias("seller_city"),
            F.col("state").alias("seller_state"),
        )

    def raw_order_items(self) -> DataFrame:
        price = F.col("l_extendedprice")
        freight = F.round(price.cast("decimal(18,2)") * F.col("l_tax").cast("decimal(4,2)"), 2)
        return self.source("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").cast("bigint").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
            price.alias("price"),
            freight.cast("double").alias("freight_value"),
        )

    def raw_order_payments(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.source("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").cast("bigint").alias("payment_sequential"),
            F.when(flag == "A", "credit_card").when(flag == "R", "boleto")
             .when(flag == "N", "voucher").alias("payment_type"),
            (F.col("l_quantity").cast("bigint") % 12 + 1).alias("payment_installments"),
            F.col("l_extendedprice").alias("payment_value"),
        )

    def raw_products(self) -> DataFrame:
        size = F.col("p_size")
        return self.source("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.when(F.col("p_partkey") % 50 != 0, F.col("p_type")).alias("product_category_name"),
            F.length("p_name").cast("bigint").alias("product_name_lenght"),
            (F.length("p_name") + F.length("p_brand")).cast("bigint")
            .alias("product_description_lenght"),
            (size % 6).cast("bigint").alias("product_photos_qty"),
            (size * 100.0).alias("product_weight_g"),
            (size * 1.0).alias("product_length_cm"),
            (size * 0.5).alias("product_height_cm"),
            (size * 2.0).alias("product_width_cm"),
        )

    def raw_product_categories(self) -> DataFrame:
        """Without a translation for one type, so that its items keep the first name."""
        kinds = self.source("part").select("p_type").distinct()
        return kinds.select(F.col("p_type").alias("product_category_name"),
                            F.when(F.col("p_type") != "PROMO", F.lower("p_type"))
                             .alias("product_category_name_english"))

    def raw_reviews(self) -> DataFrame:
        seen = F.col("ts").cast("timestamp")
        return self.source("events").select(
            F.col("event_id").cast("string").alias("review_id"),
            F.expr("cast(event_id div 2 as string)").alias("order_id"),
            F.when(F.col("event_type") != "error", F.col("event_id") % 5 + 1)
             .alias("review_score"),
            F.col("event_type").alias("review_comment_title"),
            F.col("props").alias("review_comment_message"),
            seen.alias("review_creation_date"),
            F.timestamp_add("DAY", F.lit(1), seen).alias("review_answer_timestamp"),
        )

    def raw_csv_tables(self) -> dict[str, DataFrame]:
        return {
            "orders": self.raw_orders(),
            "order_items": self.raw_order_items(),
            "order_payments": self.raw_order_payments(),
            "customers": self.raw_customers(),
            "sellers": self.raw_sellers(),
            "products": self.raw_products(),
            "reviews": self.raw_reviews(),
            "product_categories": self.raw_product_categories(),
        }

    def marketplace_drops(self) -> DataFrame:
        """One row per product and day, as its last event says, with the day as ``run_ts``.

        Only fixed-width values are carried through the aggregation, so rows of a
        busy product are reduced before the shuffle.
        """
        kind = F.col("event_type")
        price = F.floor(F.col("value") / 50) * 50 + 100
        stamp = F.col("ts").cast("timestamp")
        pair = F.expr("user_id div 2")
        family = pair % 5
        days = (
            self.source("events")
            .groupBy("user_id", F.to_date("ts").alias("day"))
            .agg(F.max_by(F.when(kind != "error", price.cast("double")), "ts").alias("price"),
                 F.max_by(kind == "signup", "ts").alias("paused"),
                 F.max(stamp).alias("seen"))
        )
        return days.select(
            F.col("user_id").cast("string").alias("product_id"),
            (F.col("user_id") % 5).cast("string").alias("category_id"),
            F.when(family != 4, F.concat(F.lit("Category "), family.cast("string")))
             .alias("category_name"),
            F.concat(F.lit("Product "), pair.cast("string"),
                     F.expr("repeat(' long name', cast(user_id div 2 % 9 as int))")).alias("name"),
            F.when(F.col("paused"), "paused").otherwise("active").alias("status"),
            F.concat(F.lit("D-"), (F.col("user_id") % 3).cast("string")).alias("domain_id"),
            F.col("price").alias("min_price_ars"),
            F.lit("ARS").alias("currency"),
            F.col("seen").alias("ingested_at"),
            F.col("day").cast("timestamp").alias("run_ts"),
        )

    def query_audit(self) -> DataFrame:
        """Turns of conversations as logged questions; some without user or token count."""
        tables = F.when(F.col("role") == "user", F.array(F.lit("mart_sales"), F.lit("dim_date"))) \
            .when(F.col("role") == "assistant", F.array(F.lit("mart_sellers"))) \
            .otherwise(F.array().cast("array<string>"))
        return self.source("conversations").select(
            F.when(F.col("turn") != 0, F.concat(F.lit("user-"),
                   (F.col("conv_id") % 20).cast("string"))).alias("user_id"),
            F.col("text").alias("question"),
            F.concat(F.lit("SELECT "), F.col("turn").cast("string")).alias("generated_sql"),
            tables.alias("tables_referenced"),
            F.when(F.col("role") != "system", F.length("text").cast("bigint"))
             .alias("tokens_used"),
            F.timestamp_add("HOUR", F.col("conv_id").cast("int"),
                            F.lit(RUN_TS).cast("timestamp")).alias("created_at"),
        )

    def generated_sql(self) -> DataFrame:
        """One statement per event: a table by user, an ending by kind of event."""
        names = F.array(*[F.lit(t) for t in LOG_TABLES])
        table = F.get(names, (F.col("user_id") % len(LOG_TABLES)).cast("int"))
        ending = (
            F.when(F.col("event_type") == "click", " WHERE updated_at > 1")
            .when(F.col("event_type") == "error", "; drop table x")
            .when(F.col("event_type") == "signup", " JOIN Dataset_Marts.mart_customers USING (id)")
            .when(F.col("event_type") == "purchase", " -- Replace and CREATE")
            .otherwise("")
        )
        return self.source("events").select(
            "event_id",
            F.concat(F.lit("SELECT * FROM `p`.dataset_marts."), table, ending).alias("sql"))

    def raw_replies(self) -> DataFrame:
        """One raw reply per turn: fenced, inside prose, plain, cut short, or without JSON."""
        source = (
            F.when(F.col("role") == "user", " FROM dataset_marts.mart_sales")
            .when(F.col("role") == "assistant", " FROM dataset_marts.mart_customers")
            .otherwise("; truncate y"))
        whole = F.to_json(F.struct(
            F.concat(F.lit("SELECT "), F.col("turn").cast("string"), source).alias("sql"),
            F.col("text").alias("explanation"),
            F.array(F.lit("mart_sales"), F.col("role")).alias("tables_used")))
        bare = F.to_json(F.struct(F.lit("SELECT 1").alias("sql")))
        kind = (F.col("conv_id") + F.col("turn")) % 6
        return self.source("conversations").select(
            "conv_id", "turn", "text",
            F.when(kind == 0, F.concat(F.lit("```json\n"), whole, F.lit("\n```")))
            .when(kind == 1, F.concat(F.lit("The answer: "), whole, F.lit(" as asked")))
            .when(kind == 2, F.col("text"))
            .when(kind == 3, F.concat(F.lit('{"sql": cut '), F.col("text"), F.lit("}")))
            .when(kind == 4, bare)
            .otherwise(F.concat(F.lit("  "), whole, F.lit(" \n"))).alias("raw"))

    # --- marketplace replies ---------------------------------------------

    def reply_categories(self) -> DataFrame:
        return self.source("nation").select(
            F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("id"),
            F.col("n_name").alias("name"),
            (100 - F.col("n_nationkey")).alias("position"))

    def reply_highlights(self) -> DataFrame:
        return self.source("part").select(
            F.concat(F.lit("C"), (F.col("p_size") % 25).cast("string")).alias("category_id"),
            F.col("p_partkey").cast("string").alias("product_id"),
            F.expr("cast(p_partkey div 7 as int)").alias("position"))

    def reply_details(self) -> DataFrame:
        """Detail is unavailable for one brand."""
        return self.source("part").where(F.col("p_brand") != "Brand#13").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("name"),
            F.when(F.col("p_size") > 40, "paused").otherwise("active").alias("status"),
            F.col("p_brand").alias("domain_id"))

    def reply_listings(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.source("lineitem").select(
            F.col("l_partkey").cast("string").alias("product_id"),
            F.when(flag == "R", F.lit(0.0)).when(flag == "A", F.col("l_extendedprice"))
             .alias("price"))

    # --- staging and models ----------------------------------------------

    def stg_orders(self) -> DataFrame:
        return S.stg_orders(self.raw_orders(), RUN_TS)

    def stg_customers(self) -> DataFrame:
        return S.stg_customers(self.raw_customers(), RUN_TS)

    def stg_order_items(self) -> DataFrame:
        return S.stg_order_items(self.raw_order_items(), RUN_TS)

    def stg_order_payments(self) -> DataFrame:
        return S.stg_order_payments(self.raw_order_payments(), RUN_TS)

    def stg_products(self) -> DataFrame:
        return S.stg_products(self.raw_products(), RUN_TS)

    def stg_product_categories(self) -> DataFrame:
        return S.stg_product_categories(self.raw_product_categories(), RUN_TS)

    def stg_reviews(self) -> DataFrame:
        return S.stg_reviews(self.raw_reviews(), RUN_TS)

    def stg_sellers(self) -> DataFrame:
        return S.stg_sellers(self.raw_sellers(), RUN_TS)

    def observations(self) -> DataFrame:
        """Staged marketplace products of every run."""
        return S.stg_marketplace_products(self.marketplace_drops(), "run_ts")

    def orders_enriched(self) -> DataFrame:
        return orders.orders_enriched(self.stg_orders(), self.stg_customers(),
                                      self.stg_order_payments())

    def items_enriched(self) -> DataFrame:
        return orders.order_items_enriched(self.stg_order_items(), self.stg_products(),
                                           self.stg_product_categories())

    def lifetime(self) -> DataFrame:
        return customers.customers_lifetime(self.orders_enriched(), ORDERS_AS_OF)

    def sales(self) -> DataFrame:
        return orders.mart_sales(self.orders_enriched(), self.items_enriched(),
                                 self.stg_reviews())

    def mart_customers(self) -> DataFrame:
        return customers.mart_customers(self.lifetime(), self.orders_enriched(),
                                        self.stg_reviews())

    def mart_cohorts(self) -> DataFrame:
        return customers.mart_cohorts(self.orders_enriched())

    def mart_sellers(self) -> DataFrame:
        return sellers.mart_sellers(
            self.stg_sellers(), self.stg_order_items(), None, self.stg_orders(), self.stg_reviews(),
            orders.catalogue(self.stg_products(), self.stg_product_categories()))

    def features(self) -> DataFrame:
        return customers.mart_customer_features(self.sales(), self.stg_reviews(), ORDERS_AS_OF)

    def product_history(self) -> DataFrame:
        return H.snapshot_rebuild(H.SNAP_PRODUCTS, self.observations(), "run_ts", self.runs())

    def runs(self) -> DataFrame:
        """The days on which there was a drop, from the dates of the events alone."""
        days = self.source("events").select(
            F.to_date("ts").cast("timestamp").alias("run_ts"))
        return keep(H.run_calendar(days, "run_ts"), "runs")

    def price_history(self) -> DataFrame:
        return prices.mart_price_history(self.product_history(), PRICES_AS_OF)

    def price_ranking(self) -> DataFrame:
        return prices.price_ranking(self.price_history())

    def order_calendar(self) -> DataFrame:
        """The calendar from the first to the last order, both read from the orders."""
        first, last = self.stg_orders().agg(
            F.to_date(F.min("purchased_at")), F.to_date(F.max("purchased_at"))).first()
        return calendar.dim_date(self.spark, first, last, end_inclusive=True)
