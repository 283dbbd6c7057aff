"""One registered query per operator, each over whole tables.

Keys start with the operator's ID in the survey. Queries that write do so below
the shared folder, in a path of their own, and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.functions import columns as C
from cartwheel.operators import changes, clustering, intervals
from cartwheel.operators import history as H
from cartwheel.operators import incremental as I
from cartwheel.operators import quality as Q
from cartwheel.operators import shaping as R
from cartwheel.operators.ranking import Ntile, global_ntile
from cartwheel.plans import calendar, customers, guards, metrics, orders, person_state, prices, sellers
from cartwheel.session import keep, keep_all, scratch_path
from cartwheel.sources import audit, catalog, drift, files, landing
from cartwheel.sources.buckets import BucketedTables, buckets_for
from cartwheel.sources.versions import VersionedTable
from cartwheel.workload.inputs import ORDERS_AS_OF, PRICES_AS_OF, RUN_TS, Inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DROP_DATE = date(2024, 1, 31)
#: Stored documents that go to one CSV file, several partitions of a reader.
CSV_FILE_BYTES = 256 << 20


def query(name: str):
    """Register a function of :class:`Inputs` as the query ``name``."""
    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        return build
    return register


def _no_stamp(df: DataFrame) -> DataFrame:
    """Without the load time, which differs from run to run."""
    return df.drop("_loaded_at")


def _joined(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


# --- sources and sinks ---------------------------------------------------

@query("s1_csv_load")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "csv-orders")
    files.write_csv(t.raw_orders(), path)
    return files.read_csv_table(t.spark, path, schemas.ORDERS)


@query("s1_csv_free_text")
def _(t: Inputs) -> DataFrame:
    """Whole texts with line breaks and quotes through a CSV file."""
    turns = t.source("conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("review_id"),
        F.col("conv_id").cast("string").alias("order_id"),
        F.col("turn").alias("review_score"),
        F.nullif(F.col("role"), F.lit("system")).alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.lit(RUN_TS).cast("timestamp").alias("review_creation_date"),
        F.lit(None).cast("timestamp").alias("review_answer_timestamp"))
    path = scratch_path(t.spark, "csv-reviews")
    files.write_csv(turns, path)
    return files.read_csv_table(t.spark, path, schemas.REVIEWS, free_text=True)


@query("s1_csv_ranges")
def _(t: Inputs) -> DataFrame:
    """Whole documents in large CSV files, their line breaks inside quotes, read in byte ranges.

    One file up to :data:`CSV_FILE_BYTES` of documents, as a file is written by one task.
    """
    texts = t.source("documents").select(
        F.col("doc_id").cast("string").alias("review_id"), F.col("source").alias("order_id"),
        F.col("n_chars").alias("review_score"), F.col("lang").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.lit(RUN_TS).cast("timestamp").alias("review_creation_date"),
        F.lit(None).cast("timestamp").alias("review_answer_timestamp"))
    path = scratch_path(t.spark, "csv-documents")
    files.write_csv(texts.coalesce(-(-t.size("documents") // CSV_FILE_BYTES)), path)
    read = files.read_csv_table(t.spark, path, schemas.REVIEWS, free_text=True, large=0)
    return read.select("review_id", "order_id", "review_score", "review_comment_title",
                       F.length("review_comment_message").alias("chars"),
                       F.sha2("review_comment_message", 256).alias("digest"))


@query("s2_jsonl_load")
def _(t: Inputs) -> DataFrame:
    rows = t.marketplace_drops().drop("run_ts")
    path = files.write_jsonl(rows, scratch_path(t.spark, "jsonl"), DROP_DATE)
    return files.read_jsonl_table(t.spark, path, schemas.MARKETPLACE_PRODUCTS)


@query("s3_jsonl_sink")
def _(t: Inputs) -> DataFrame:
    """Two writes of the same date leave the second; texts keep their letters."""
    turns = t.source("conversations").select(
        "conv_id", "turn", "text", F.nullif(F.col("role"), F.lit("system")).alias("role"))
    base = scratch_path(t.spark, "jsonl")
    files.write_jsonl(turns.withColumn("text", F.upper("text")), base, DROP_DATE)
    path = files.write_jsonl(turns, base, DROP_DATE)
    lines = t.spark.read.text(path)
    return lines.select(
        F.get_json_object("value", "$.conv_id").cast("bigint").alias("conv_id"),
        F.get_json_object("value", "$.turn").cast("bigint").alias("turn"),
        F.get_json_object("value", "$.role").alias("role"),
        F.get_json_object("value", "$.text").alias("text"),
        F.contains(F.col("value"), F.lit('"role":')).alias("role_written"),
        F.contains(F.col("value"), F.lit("\\u00")).alias("letters_escaped"))


@query("s4_read_drop")
def _(t: Inputs) -> DataFrame:
    """Drops of several dates read together, and one of them alone."""
    base = scratch_path(t.spark, "drops")
    days = files.dates_between(DROP_DATE - timedelta(days=2), DROP_DATE)
    for i, day in enumerate(days):
        part = t.raw_sellers().withColumn(
            "seller_city", F.concat(F.col("seller_city"), F.lit(f"@{i}")))
        landing.land(part, base, "sellers", day)
    together = files.read_drops(t.spark, base, "sellers", days, schemas.SELLERS)
    alone = files.read_drop(t.spark, base, "sellers", days[1], schemas.SELLERS)
    return together.withColumn("how", F.lit("together")).unionByName(
        alone.withColumn("load_date", F.lit(days[1])).withColumn("how", F.lit("alone")))


@query("s5_land_drop")
def _(t: Inputs) -> DataFrame:
    """Landing twice keeps the first drop; forcing replaces it."""
    base = scratch_path(t.spark, "landed")
    customers_raw = t.raw_customers()
    moved = customers_raw.withColumn("customer_city", F.lower("customer_city"))

    def stored(outcome: str, step: str) -> DataFrame:
        rows = files.read_drop(t.spark, base, "customers", DROP_DATE, schemas.CUSTOMERS)
        return keep(rows.select(F.lit(step).alias("step"), F.lit(outcome).alias("outcome"), "*"),
                    "landed")

    first = stored(landing.land(customers_raw, base, "customers", DROP_DATE), "first")
    again = stored(landing.land(moved, base, "customers", DROP_DATE), "again")
    forced = stored(landing.land(moved, base, "customers", DROP_DATE, force=True), "forced")
    return first.unionByName(again).unionByName(forced)


@query("s6_source_gate")
def _(t: Inputs) -> DataFrame:
    """Every landed table passes the gate; one that was not landed does not."""
    base = scratch_path(t.spark, "gate")
    tables = t.raw_csv_tables()
    landing.land_all(tables, base, DROP_DATE)
    verdicts = []
    for name in [*tables, "returns"]:
        try:
            landing.validate_source(t.spark, files.drop_path(base, name, DROP_DATE))
            rows = files.read_drop(
                t.spark, base, name, DROP_DATE, schemas.CSV_TABLES[name],
                free_text=name in schemas.FREE_TEXT_TABLES).count()
            verdicts.append((name, "ok", rows))
        except FileNotFoundError:
            verdicts.append((name, "missing", None))
    return t.spark.createDataFrame(verdicts, "`table` string, verdict string, `rows` bigint")


@query("s7_load_all")
def _(t: Inputs) -> DataFrame:
    """All tables loaded with their counts; the one without a drop is an error row."""
    base = scratch_path(t.spark, "drops")
    landing.land_all(t.raw_csv_tables(), base, DROP_DATE)
    wanted = {"returns": schemas.ORDERS, **schemas.CSV_TABLES}
    status = landing.load_all(t.spark, base, scratch_path(t.spark, "raw"), DROP_DATE,
                              wanted, strict=False)
    return status.select("table", "status", "rows", F.col("reason").isNotNull().alias("has_reason"))


@query("s6_empty_source")
def _(t: Inputs) -> DataFrame:
    """A drop without bytes and one of a header alone fail; the full one beside them loads."""
    base = scratch_path(t.spark, "drops")
    landing.land(t.raw_sellers(), base, "sellers", DROP_DATE)
    landing.land(t.raw_customers().where(F.lit(False)), base, "customers", DROP_DATE)
    t.raw_orders().select("order_id").where(F.lit(False)).write.text(
        files.drop_path(base, "orders", DROP_DATE))
    wanted = {name: schemas.CSV_TABLES[name] for name in ("sellers", "customers", "orders")}
    return landing.load_all(t.spark, base, scratch_path(t.spark, "raw"), DROP_DATE, wanted,
                            strict=False).select("table", "status", "rows")


@query("s7_failed_load")
def _(t: Inputs) -> DataFrame:
    """A good drop, then one with a NULL key: the table keeps the rows of the good one."""
    base, raw = scratch_path(t.spark, "drops"), scratch_path(t.spark, "raw")
    wanted = {"sellers": schemas.CSV_TABLES["sellers"]}
    landing.land(t.raw_sellers(), base, "sellers", DROP_DATE)
    landing.load_all(t.spark, base, raw, DROP_DATE, wanted)
    later = DROP_DATE + timedelta(days=1)
    broken = t.raw_sellers().withColumn(
        "seller_id", F.when(F.col("seller_id") != "1", F.col("seller_id")))
    landing.land(broken, base, "sellers", later)
    status = landing.load_all(t.spark, base, raw, later, wanted, strict=False).first()["status"]
    return t.spark.read.parquet(f"{raw}/sellers").select(
        "seller_id", "seller_city", "seller_state", F.lit(status).alias("second_load"))


@query("s7_quoted_breaks")
def _(t: Inputs) -> DataFrame:
    """Line breaks inside quotes, in a table that is not one of free text."""
    base, raw = scratch_path(t.spark, "drops"), scratch_path(t.spark, "raw")
    broken = t.raw_sellers().withColumn("seller_city", F.concat("seller_city", F.lit("\nsouth")))
    landing.land(broken, base, "sellers", DROP_DATE)
    landing.load_all(t.spark, base, raw, DROP_DATE, {"sellers": schemas.CSV_TABLES["sellers"]})
    return t.spark.read.parquet(f"{raw}/sellers").select("seller_id", "seller_city", "seller_state")


@query("s4_dated_texts")
def _(t: Inputs) -> DataFrame:
    """Drops whose dates are texts, with hyphens and without."""
    base, days = scratch_path(t.spark, "drops"), ["2024-01-30", "20240131"]
    for day in days:
        landing.land(t.raw_sellers(), base, "sellers", day)
    return files.read_drops(t.spark, base, "sellers", days, schemas.SELLERS).select(
        "seller_id", "load_date")


@query("s8_write_disposition")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "table")
    rows = t.raw_sellers()
    landing.write_table(rows, path, "empty")
    landing.write_table(rows, path, "truncate")
    landing.write_table(rows, path, "append")
    try:
        landing.write_table(rows, path, "empty")
        refused = False
    except ValueError:
        refused = True
    return (t.spark.read.parquet(path).groupBy("seller_id", "seller_city", "seller_state")
            .agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("refused_when_full", F.lit(refused)))


@query("s8_table_versions")
def _(t: Inputs) -> DataFrame:
    """A table filled, added to and replaced: what each version holds, read at the end."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "versions"))
    rows = t.raw_sellers()
    for disposition in ("empty", "append", "truncate"):
        landing.write_table(rows, table, disposition)
        rows = rows.where(F.col("seller_state") != "ASIA")
    states = [table.read(number).groupBy("seller_state").agg(F.count(F.lit(1)).alias("sellers"))
              .withColumn("version", F.lit(number)) for number in (1, 2, 3)]
    return states[0].unionByName(states[1]).unionByName(states[2])


@query("s9_empty_batch")
def _(t: Inputs) -> DataFrame:
    """A batch without rows leaves the table as it was."""
    path = scratch_path(t.spark, "products")
    rows = t.raw_products()
    first = landing.write_if_nonempty(rows, path)
    second = landing.write_if_nonempty(rows.where(F.lit(False)), path)
    return t.spark.read.parquet(path).select(
        "product_id", "product_category_name",
        F.lit(first).alias("first_written"), F.lit(second).alias("empty_written"))


@query("s10_table_registry")
def _(t: Inputs) -> DataFrame:
    """Raw tables stored once and read by name."""
    tables = catalog.Tables(t.spark, scratch_path(t.spark, "tables"))
    for name, df in (("customers", t.raw_customers()), ("orders", t.raw_orders())):
        tables.materialize(name, df, "raw")
    return (tables.table("orders").join(tables.table("customers"), "customer_id")
            .groupBy("customer_state", "order_status")
            .agg(F.count(F.lit(1)).alias("order_count")))


@query("s11_materialize")
def _(t: Inputs) -> DataFrame:
    """A staging view read by name, and a mart stored from it and read back."""
    tables = catalog.Tables(t.spark, scratch_path(t.spark, "tables"))
    tables.materialize("stg_order_payments", t.stg_order_payments(), "staging")
    totals = orders.payment_totals(tables.table("stg_order_payments", "staging"))
    return tables.materialize("order_payment_totals", totals, "marts")


@query("s11_pinned_reader")
def _(t: Inputs) -> DataFrame:
    """A mart replaced while it is read: the first reader keeps its rows, the next has the new ones."""
    tables = catalog.Tables(t.spark, scratch_path(t.spark, "tables"), versioned=True)
    totals = orders.payment_totals(t.stg_order_payments())
    pinned = tables.materialize("order_payment_totals", totals, "marts")
    latest = tables.materialize("order_payment_totals", pinned.where("payment_count > 1"), "marts")
    return (pinned.withColumn("reader", F.lit("first"))
            .unionByName(latest.withColumn("reader", F.lit("next"))))


@query("s12_audit_append")
def _(t: Inputs) -> DataFrame:
    """Two batches appended, the second without users and token counts."""
    path = scratch_path(t.spark, "audit")
    log = t.query_audit()
    audit.append_audit(log.where(F.size("tables_referenced") > 0), path)
    audit.append_audit(log.where(F.size("tables_referenced") == 0)
                          .drop("user_id", "tokens_used"), path)
    return t.spark.read.parquet(path).withColumn("tables_referenced", _joined("tables_referenced"))


@query("s13_schema_drift")
def _(t: Inputs) -> DataFrame:
    """A drop that lost a column, gained one, and holds values that do not cast."""
    raw = t.raw_orders()
    drifted = raw.drop("order_approved_at").select(
        F.nullif(F.col("customer_id"), F.lit("7")).alias("customer_id"),
        *[c for c in raw.columns if c not in (
            "customer_id", "order_approved_at", "order_estimated_delivery_date")],
        F.when(F.col("order_status") == "processing", F.lit("soon")).otherwise(
            F.date_format("order_estimated_delivery_date", "yyyy-MM-dd HH:mm:ss"))
        .alias("order_estimated_delivery_date"),
        F.lit("web").alias("sales_channel"))
    path = scratch_path(t.spark, "drift")
    files.write_csv(drifted, path)
    return drift.schema_conformance(drift.read_as_text(t.spark, path), schemas.ORDERS)


# --- marketplace replies -------------------------------------------------

@query("r1_first_categories")
def _(t: Inputs) -> DataFrame:
    return R.first_n(t.reply_categories(), R.MAX_CATEGORIES, "position", "id")


@query("r2_top_highlights")
def _(t: Inputs) -> DataFrame:
    return R.top_n_per_group(t.reply_highlights(), "category_id", ["position", "product_id"],
                             R.MAX_PRODUCTS_PER_CATEGORY)


@query("r3_min_listing_price")
def _(t: Inputs) -> DataFrame:
    """Lowest listing price of every product; without a usable one it is NULL."""
    products = t.source("part").select(F.col("p_partkey").cast("string").alias("product_id"))
    return products.join(R.min_price_by_product(t.reply_listings()), "product_id", "left")


@query("r3_nested_listings")
def _(t: Inputs) -> DataFrame:
    """The lowest price of replies that hold their listings as an array."""
    replies = t.reply_listings().groupBy("product_id").agg(
        F.collect_list(F.struct("price")).alias("results"))
    return replies.select("product_id", F.size("results").cast("long").alias("listings"),
                          R.min_listing_price(F.col("results")).alias("min_price_ars"))


@query("r4_marketplace_products")
def _(t: Inputs) -> DataFrame:
    return R.build_products(t.reply_categories(), t.reply_highlights(), t.reply_details(),
                            t.reply_listings(), RUN_TS)


@query("r5_products_with_detail")
def _(t: Inputs) -> DataFrame:
    """All products of all categories, less those whose detail is unavailable."""
    return t.reply_highlights().join(t.reply_details(), "product_id")


# --- staging -------------------------------------------------------------

@query("p1_stg_orders")
def _(t: Inputs) -> DataFrame:
    return _no_stamp(t.stg_orders())


@query("p2_stg_customers")
def _(t: Inputs) -> DataFrame:
    return _no_stamp(t.stg_customers())


@query("p3_stg_order_items")
def _(t: Inputs) -> DataFrame:
    return _no_stamp(t.stg_order_items())


@query("p4_stg_order_payments")
def _(t: Inputs) -> DataFrame:
    return _no_stamp(t.stg_order_payments())


@query("p5_stg_products")
def _(t: Inputs) -> DataFrame:
    return _no_stamp(t.stg_products())


@query("p6_stg_product_categories")
def _(t: Inputs) -> DataFrame:
    return _no_stamp(t.stg_product_categories())


@query("p7_stg_reviews")
def _(t: Inputs) -> DataFrame:
    return _no_stamp(t.stg_reviews())


@query("p8_stg_sellers")
def _(t: Inputs) -> DataFrame:
    return _no_stamp(t.stg_sellers())


@query("p9_stg_marketplace_products")
def _(t: Inputs) -> DataFrame:
    return t.observations()


# --- filters, joins, aggregates that no model shows by itself --------------

@query("w1_delivered_orders")
def _(t: Inputs) -> DataFrame:
    return _no_stamp(orders.delivered_orders(t.stg_orders()))


@query("w7_sales_in_range")
def _(t: Inputs) -> DataFrame:
    """A date range across month ends, read from a mart stored by month."""
    path = scratch_path(t.spark, "sales")
    I.write_partitioned(t.sales(), path)
    rows = I.read_range(t.spark, path, date(1997, 2, 10), date(1997, 4, 20))
    return rows.select("order_id", "order_date", "primary_category", "total_payment_brl")


@query("a1_payments_per_order")
def _(t: Inputs) -> DataFrame:
    return orders.payment_totals(t.stg_order_payments())


@query("a3_items_per_order")
def _(t: Inputs) -> DataFrame:
    return orders.item_totals(t.items_enriched())


@query("a4_reviews_per_order")
def _(t: Inputs) -> DataFrame:
    return orders.review_totals(t.stg_reviews()).select(
        "order_id", "review_count",
        C.rounded(C.ratio(F.col("score_sum"), F.col("scored")), 1).alias("review_score"))


@query("a8_reviews_per_customer")
def _(t: Inputs) -> DataFrame:
    return customers.customer_reviews(t.orders_enriched(), t.stg_reviews())


@query("a9_seller_sales")
def _(t: Inputs) -> DataFrame:
    return sellers.seller_sales(t.items_enriched())


@query("a11_seller_service")
def _(t: Inputs) -> DataFrame:
    return sellers.seller_service(t.stg_order_items(), t.stg_orders(), t.stg_reviews())


@query("a16_daily_volumes")
def _(t: Inputs) -> DataFrame:
    return Q.daily_volumes(t.sales()).select("order_date", "order_count", "avg_last_7_days")


@query("n1_global_ntile")
def _(t: Inputs) -> DataFrame:
    """Seven uneven buckets over all orders, both directions, with NULLs and ties."""
    totals = t.orders_enriched().select(
        "order_id", "actual_delivery_days", F.col("payment_count").alias("payments"))
    return global_ntile(
        keep(totals, "orders"), "order_id",
        Ntile("slowest", "actual_delivery_days", 7, descending=True),
        Ntile("fewest", "payments", 7),
    )


@query("n1_n3_rfm_scores")
def _(t: Inputs) -> DataFrame:
    return customers.rfm_scores(keep(t.lifetime(), "lifetime")).select(
        "customer_unique_id", "r_score", "f_score", "m_score")


@query("t7_row_cap")
def _(t: Inputs) -> DataFrame:
    """The twenty rows of an answer: largest delivered orders."""
    rows = t.orders_enriched().select("order_id", "order_date", "total_payment_brl")
    return prices.cap_rows(rows, 20, F.col("total_payment_brl").desc(), "order_id")


# --- history -------------------------------------------------------------

@query("h1_snapshot_run")
def _(t: Inputs) -> DataFrame:
    """The last run applied to the history of all runs before it."""
    seen = keep(t.observations(), "observations")
    last = seen.agg(F.max("run_ts")).first()[0]
    before = H.snapshot_rebuild(H.SNAP_PRODUCTS, seen.where(F.col("run_ts") < F.lit(last)),
                                "run_ts")
    current = seen.where(F.col("run_ts") == F.lit(last))
    return H.snapshot_apply(H.SNAP_PRODUCTS, before, current, last)


@query("h2_snap_products")
def _(t: Inputs) -> DataFrame:
    return t.product_history()


def _recorded_sellers(t: Inputs, merge: bool) -> DataFrame:
    """Three runs: all sellers, then some moved and some gone, then all as at first."""
    places = t.stg_sellers().select("seller_id", "city", "state")
    balance = t.source("supplier").select(F.col("s_suppkey").cast("string").alias("seller_id"),
                                          "s_acctbal")
    second = places.join(balance, "seller_id").where("s_acctbal >= 0").select(
        "seller_id",
        F.when(F.col("s_acctbal") > 5000, F.concat(F.lit("New "), "city")).otherwise(
            F.col("city")).alias("city"),
        F.when(F.col("s_acctbal") <= 9000, F.col("state")).alias("state"))
    base = scratch_path(t.spark, "sellers")
    previous = None
    for day, run in ((1, places), (2, second), (3, places)):
        run_ts = datetime(2024, 1, day)
        H.record_run(H.SNAP_SELLERS, base, run, run_ts, previous)
        previous = run_ts
    if merge:
        H.compact_runs(t.spark, base, fan=2)
    return H.read_history(t.spark, base, previous)


@query("h3_snap_sellers")
def _(t: Inputs) -> DataFrame:
    return _recorded_sellers(t, merge=False)


@query("h3_merged_runs")
def _(t: Inputs) -> DataFrame:
    """The same after the closed versions of the first two runs were merged into one folder."""
    return _recorded_sellers(t, merge=True)


@query("h4_history_rebuild")
def _(t: Inputs) -> DataFrame:
    """History of all products from all daily drops, without the carried columns."""
    seen = t.observations()
    return H.scd2_rebuild(seen, "product_id", "run_ts", ["price_ars", "status"],
                          ["product_id", "price_ars", "status"], t.runs())


@query("h5_valid_at")
def _(t: Inputs) -> DataFrame:
    """Products as they were at noon of one day and as they are now."""
    history = keep(t.product_history(), "history")
    then = H.scd2_as_of(history, datetime(2024, 1, 15, 12)).withColumn("moment", F.lit("then"))
    now = H.scd2_current(history).withColumn("moment", F.lit("now"))
    return then.unionByName(now).select("moment", "product_id", "price_ars", "status",
                                        "dbt_valid_from", "dbt_valid_to")


# --- models --------------------------------------------------------------

@query("m1_orders_enriched")
def _(t: Inputs) -> DataFrame:
    return t.orders_enriched()


@query("m2_order_items_enriched")
def _(t: Inputs) -> DataFrame:
    return t.items_enriched()


@query("m3_customers_lifetime")
def _(t: Inputs) -> DataFrame:
    return t.lifetime()


@query("m4_mart_sales")
def _(t: Inputs) -> DataFrame:
    return t.sales()


@query("j3_bucketed_sales")
def _(t: Inputs) -> DataFrame:
    """The sales fact from enriched orders, items and reviews that are stored in buckets of the order."""
    buckets = buckets_for(sum(map(t.size, ("customer", "part", "orders", "lineitem", "events"))))
    tables = BucketedTables(t.spark, scratch_path(t.spark, "buckets"), buckets)
    stored = [tables.store(name, df, "order_id") for name, df in (
        ("enriched", t.orders_enriched()), ("items", t.items_enriched()), ("reviews", t.stg_reviews()))]
    return orders.mart_sales(*stored)


@query("m5_mart_customers")
def _(t: Inputs) -> DataFrame:
    return t.mart_customers()


@query("m6_mart_cohorts")
def _(t: Inputs) -> DataFrame:
    return t.mart_cohorts()


@query("m7_mart_sellers")
def _(t: Inputs) -> DataFrame:
    return t.mart_sellers()


@query("m8_mart_customer_features")
def _(t: Inputs) -> DataFrame:
    """The deviation is rounded, as its last digits depend on the order of the rows."""
    return t.features().withColumn(
        "stddev_order_value_brl", C.rounded(F.col("stddev_order_value_brl"), 4))


@query("m9_mart_price_history")
def _(t: Inputs) -> DataFrame:
    return t.price_history()


@query("m10_dim_date")
def _(t: Inputs) -> DataFrame:
    """Every day from the first to the last order, with its orders."""
    daily = t.stg_orders().groupBy(F.to_date("purchased_at").alias("date_day")).agg(
        F.count(F.lit(1)).alias("order_count"))
    return t.order_calendar().join(daily, "date_day", "left").withColumn(
        "order_count", F.coalesce("order_count", F.lit(0)))


@query("m11_sales_by_calendar")
def _(t: Inputs) -> DataFrame:
    return calendar.sales_by_calendar(
        t.sales(), t.order_calendar(), "quarter_label", "is_weekend", "is_holiday_br",
        "is_business_day_br")


# --- data quality --------------------------------------------------------

@query("q1_not_null")
def _(t: Inputs) -> DataFrame:
    return Q.not_null(t.stg_products(), "category_name_pt").select("product_id")


@query("q2_unique")
def _(t: Inputs) -> DataFrame:
    return Q.unique(t.stg_order_items(), "order_id")


@query("q3_accepted_values")
def _(t: Inputs) -> DataFrame:
    return Q.accepted_values(t.items_enriched(), "category_name_en",
                             ["economy", "large", "medium", "small"])


@query("q4_delivery_after_purchase")
def _(t: Inputs) -> DataFrame:
    """On sales whose purchase was entered twelve days late."""
    late = F.timestamp_add("DAY", F.lit(12), F.col("purchased_at"))
    return Q.delivery_before_purchase(t.sales().withColumn("purchased_at", late))


@query("q5_revenue_non_negative")
def _(t: Inputs) -> DataFrame:
    """On sales with a refund taken off every order."""
    refunded = F.col("total_payment_brl") - 100000
    return Q.negative_revenue(t.sales().withColumn("total_payment_brl", refunded))


@query("q6_retention_rate_valid")
def _(t: Inputs) -> DataFrame:
    """On cohorts whose rate was computed with an offset of -3 and a factor of 2."""
    wrong = C.rounded((F.col("retention_rate_pct") - 3) * 2, 2)
    return Q.retention_out_of_range(t.mart_cohorts().withColumn("retention_rate_pct", wrong))


@query("q7_no_overlapping_periods")
def _(t: Inputs) -> DataFrame:
    """On a history in which versions with a price above 200 end two days late."""
    history = keep(t.product_history(), "history")
    late = F.timestamp_add("DAY", F.lit(2), F.col("dbt_valid_to"))
    wrong = history.withColumn(
        "dbt_valid_to",
        F.when(F.col("price_ars") > 200, late).otherwise(F.col("dbt_valid_to")))
    clean = Q.overlapping_periods(history, "product_id").withColumn("kind", F.lit("clean"))
    return clean.unionByName(
        Q.overlapping_periods(wrong, "product_id").withColumn("kind", F.lit("late")))


@query("q7_overlapping_pairs")
def _(t: Inputs) -> DataFrame:
    """The pairs of versions behind that check, on the history with late ends."""
    late = F.timestamp_add("DAY", F.lit(2), F.col("dbt_valid_to"))
    wrong = t.product_history().withColumn(
        "dbt_valid_to", F.when(F.col("price_ars") > 200, late).otherwise(F.col("dbt_valid_to")))
    return intervals.overlapping_pairs(wrong, "product_id")


@query("q7_unique_versions")
def _(t: Inputs) -> DataFrame:
    """On a history whose version starts were cut to weeks."""
    weekly = t.product_history().withColumn("dbt_valid_from", F.date_trunc("week", "dbt_valid_from"))
    return Q.duplicate_versions(weekly, "product_id")


@query("q8_volume_anomaly")
def _(t: Inputs) -> DataFrame:
    """All low days, those of one date, and low days when days without orders count."""
    sales = keep(t.sales().select("order_date"), "days")
    every = Q.volume_anomalies(sales).withColumn("form", F.lit("all days"))
    one = Q.volume_anomalies(sales, as_of=date(1997, 6, 1)).withColumn("form", F.lit("one day"))
    filled = Q.volume_anomalies(sales, calendar=t.order_calendar()).withColumn(
        "form", F.lit("with empty days"))
    return every.unionByName(one).unionByName(filled)


@query("q9_relationships")
def _(t: Inputs) -> DataFrame:
    """Reviews of orders that were not delivered, and items of products with no category."""
    reviews = Q.relationships(t.stg_reviews(), "order_id",
                              orders.delivered_orders(t.stg_orders()), "order_id")
    named = t.stg_products().where(F.col("category_name_pt").isNotNull())
    items = Q.relationships(t.stg_order_items(), "product_id", named, "product_id")
    return reviews.withColumn("child", F.lit("reviews")).unionByName(
        items.withColumn("child", F.lit("items")))


@query("q10_source_suite")
def _(t: Inputs) -> DataFrame:
    """Raw tables are checked where they lie; only the drops are worked out first."""
    drops = keep(t.marketplace_drops(), "marketplace")
    return Q.run_suite(Q.SOURCE_SUITE, {**t.raw_csv_tables(), "marketplace_products": drops})


@query("q10_mart_suite")
def _(t: Inputs) -> DataFrame:
    """All checks of the marts, on marts stored first."""
    stored = keep_all({"snap_products": t.product_history(), "enriched": t.orders_enriched()})
    enriched = stored.pop("enriched")
    sales = keep(orders.mart_sales(enriched, t.items_enriched(), t.stg_reviews()), "mart_sales")
    first = stored | {"mart_sales": sales}
    tables = first | keep_all({
        "mart_customers": customers.mart_customers(
            customers.customers_lifetime(enriched, ORDERS_AS_OF), enriched, t.stg_reviews()),
        "mart_cohorts": customers.mart_cohorts(enriched),
        "mart_sellers": t.mart_sellers(),
        "mart_price_history": prices.mart_price_history(first["snap_products"], PRICES_AS_OF),
        "dim_date": t.order_calendar(),
        "mart_customer_features": customers.mart_customer_features(
            first["mart_sales"], t.stg_reviews(), ORDERS_AS_OF),
    })
    suite = Q.Suite(Q.MART_SUITE.columns, (*Q.MART_SUITE.models, Q.volume_check(date(1997, 6, 1))))
    return Q.run_suite(suite, tables)


# --- metrics -------------------------------------------------------------

@query("k1_gross_revenue")
def _(t: Inputs) -> DataFrame:
    return metrics.evaluate(t.sales(), "gross_revenue_brl", by=["customer_state"])


@query("k2_order_count")
def _(t: Inputs) -> DataFrame:
    return metrics.evaluate(t.sales(), "order_count", by=["primary_category", "is_on_time"])


@query("k3_avg_order_value")
def _(t: Inputs) -> DataFrame:
    return metrics.evaluate(t.sales(), "avg_order_value_brl", by=["primary_payment_type"])


@query("k4_avg_delivery_days")
def _(t: Inputs) -> DataFrame:
    return metrics.evaluate(t.sales(), "avg_delivery_days", by=["customer_city"],
                            where=F.col("primary_category").isNotNull())


@query("k5_on_time_delivery_rate")
def _(t: Inputs) -> DataFrame:
    return metrics.evaluate(t.sales(), "on_time_delivery_rate", by=["customer_state"])


@query("k6_monthly_retention_rate")
def _(t: Inputs) -> DataFrame:
    return metrics.evaluate(t.mart_cohorts(), "monthly_retention_rate",
                            by=["months_since_first_order"])


@query("k7_customer_ltv")
def _(t: Inputs) -> DataFrame:
    return metrics.evaluate(t.mart_customers(), "customer_ltv_brl", by=["rfm_segment"])


@query("k8_active_customers")
def _(t: Inputs) -> DataFrame:
    """Active customers at the end of the data and one year before."""
    lifetime = keep(t.lifetime(), "lifetime")
    counts = [
        customers.active_customers(lifetime, day).agg(
            F.count(F.lit(1)).alias("active_customers")).withColumn("as_of", F.lit(day))
        for day in (ORDERS_AS_OF, date(2000, 8, 2))
    ]
    return counts[0].unionByName(counts[1])


@query("k1_revenue_by_month")
def _(t: Inputs) -> DataFrame:
    return metrics.revenue_by_month(t.sales())


# --- price analytics -----------------------------------------------------

@query("d1_price_listing")
def _(t: Inputs) -> DataFrame:
    return prices.price_listing(t.price_history())


@query("d2_price_ranking")
def _(t: Inputs) -> DataFrame:
    return t.price_ranking()


@query("d3_top_growth")
def _(t: Inputs) -> DataFrame:
    return prices.top_growth(t.price_ranking())


@query("d4_price_kpis")
def _(t: Inputs) -> DataFrame:
    history = keep(t.price_history(), "prices")
    return prices.price_kpis(history, prices.price_ranking(history))


@query("d5_product_names")
def _(t: Inputs) -> DataFrame:
    history = keep(t.price_history(), "prices")
    ranking = prices.price_ranking(history)
    every = prices.product_names(history, ranking, show_all=True)
    changed = prices.product_names(history, ranking, show_all=False)
    return every.withColumn("list", F.lit("all")).unionByName(
        changed.withColumn("list", F.lit("changed")))


@query("d6_product_detail")
def _(t: Inputs) -> DataFrame:
    """The detail of the product name first in the alphabet."""
    history = keep(t.price_history(), "prices")
    name = history.agg(F.min("product_name")).first()[0]
    return prices.product_detail(history, name)


@query("d7_category_volatility")
def _(t: Inputs) -> DataFrame:
    return prices.category_volatility(t.price_ranking())


@query("d8_price_gallery")
def _(t: Inputs) -> DataFrame:
    return prices.price_gallery(t.price_history())


@query("d9_product_history")
def _(t: Inputs) -> DataFrame:
    """The versions of the product that has most of them."""
    history = keep(t.price_history(), "prices")
    most = history.orderBy(F.col("price_version").desc(), "product_id").first()["product_id"]
    return prices.product_history(history, most)


@query("d10_price_drops")
def _(t: Inputs) -> DataFrame:
    return prices.price_drops(t.price_history())


@query("d10_directional_drops")
def _(t: Inputs) -> DataFrame:
    return prices.price_drops(t.price_history(), directional=True)


@query("d11_price_waterfall")
def _(t: Inputs) -> DataFrame:
    return prices.price_waterfall(t.price_history())


# --- incremental load and backfill ----------------------------------------

def _sales_builder(t: Inputs, payments: DataFrame | None = None) -> I.Build:
    return orders.sales_builder(
        t.stg_orders(), t.stg_customers(),
        t.stg_order_payments() if payments is None else payments,
        t.stg_order_items(), t.stg_products(), t.stg_product_categories(), t.stg_reviews())


def _stored_sales(t: Inputs, target: str | VersionedTable) -> DataFrame:
    return I.stored(t.spark, target).select(
        "order_id", "order_date", "order_month", "customer_state", "primary_category",
        "items_value_brl", "total_payment_brl", "review_score")


@query("i1_partitioned_mart")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "sales")
    I.write_partitioned(t.sales(), path)
    return _stored_sales(t, path)


@query("i2_clustered_files")
def _(t: Inputs) -> DataFrame:
    """Months in small files along the curve of category and state; one pair is looked up."""
    table = I.sales_table(t.spark, scratch_path(t.spark, "sales"))
    year = t.sales().where(F.year("order_date") == 1995).withColumn(I.MONTH_COLUMN, C.month_start(F.col("order_date")))
    table.replace(year, year.repartition(3, F.xxhash64("order_id")).write.partitionBy(I.MONTH_COLUMN).parquet)
    clustering.recluster(table, [date(1995, month, 1) for month in (2, 3)], file_bytes=8 << 10)
    return clustering.read_where(table, customer_state="ASIA").select(
        "order_id", "order_date", "order_month", "customer_state", "primary_category", "total_payment_brl")


@query("i3_incremental_refresh")
def _(t: Inputs) -> DataFrame:
    """A mart that ends inside a month, brought up to date, twice."""
    path = scratch_path(t.spark, "sales")
    build = _sales_builder(t)
    I.write_partitioned(build(date(1995, 1, 1), date(2001, 6, 14)), path)
    I.incremental_refresh(t.spark, build, path)
    I.incremental_refresh(t.spark, build, path)
    return _stored_sales(t, path)


@query("i4_backfill")
def _(t: Inputs) -> DataFrame:
    """A mart built with every payment ten times too high, repaired for one range."""
    path = scratch_path(t.spark, "sales")
    wrong = t.stg_order_payments().withColumn("payment_brl", F.col("payment_brl") * 10)
    I.write_partitioned(_sales_builder(t, wrong)(date(1995, 1, 1), None), path)
    I.backfill(_sales_builder(t), path, date(1997, 2, 10), date(1997, 4, 20))
    return _stored_sales(t, path)


@query("i3_versioned_refresh")
def _(t: Inputs) -> DataFrame:
    """The same refresh twice on a table with versions, of which the last is kept."""
    table, build = I.sales_table(t.spark, scratch_path(t.spark, "sales")), _sales_builder(t)
    I.write_partitioned(build(date(1995, 1, 1), date(2001, 6, 14)), table)
    I.incremental_refresh(t.spark, build, table)
    I.incremental_refresh(t.spark, build, table)
    table.remove_old(keep_versions=1)
    return _stored_sales(t, table)


@query("i4_versioned_backfill")
def _(t: Inputs) -> DataFrame:
    """A mart with payments ten times too high before and after the repair of a range."""
    table = I.sales_table(t.spark, scratch_path(t.spark, "sales"))
    wrong = t.stg_order_payments().withColumn("payment_brl", F.col("payment_brl") * 10)
    I.write_partitioned(_sales_builder(t, wrong)(date(1995, 1, 1), None), table)
    before = table.read()
    I.backfill(_sales_builder(t), table, date(1997, 2, 10), date(1997, 4, 20))

    def months(rows: DataFrame, state: str) -> DataFrame:
        return rows.groupBy("order_month").agg(
            F.count(F.lit(1)).alias("orders"),
            C.money_sum(F.col("total_payment_brl")).alias("total_payment_brl")).withColumn("state", F.lit(state))

    return months(before, "before").unionByName(months(table.read(), "after"))


@query("i3_filtered_range")
def _(t: Inputs) -> DataFrame:
    """Half a year built with a filter of the orders' ids, as for a range of very many orders."""
    build = orders.sales_builder(**_staged(t), few_ids=0)
    return build(date(1995, 1, 1), date(1995, 6, 30)).select(
        "order_id", "order_date", "items_value_brl", "total_payment_brl", "review_count")


def _staged(t: Inputs) -> dict[str, DataFrame]:
    return {"orders": t.stg_orders(), "customers": t.stg_customers(), "payments": t.stg_order_payments(),
            "items": t.stg_order_items(), "products": t.stg_products(),
            "categories": t.stg_product_categories(), "reviews": t.stg_reviews()}


def _before_the_load(now: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The staged tables before some reviews came, some payments were corrected and an order was moved."""
    key = F.col("order_id").cast("long")
    return now | {
        "reviews": now["reviews"].where(key % 641 != 3),
        "payments": now["payments"].withColumn(
            "payment_brl", F.when(key % 1009 == 6, 1.0).otherwise(F.col("payment_brl"))),
        "orders": now["orders"].withColumn("purchased_at", F.when(
            key == 7, F.lit(datetime(1999, 12, 31))).otherwise(F.col("purchased_at")))}


@query("i3_late_changes")
def _(t: Inputs) -> DataFrame:
    """A mart of the tables before a load, of which only the touched months are made anew."""
    table, now = I.sales_table(t.spark, scratch_path(t.spark, "sales")), _staged(t)
    before = _before_the_load(now)
    I.write_partitioned(orders.sales_builder(**before)(), table)
    I.refresh_months(orders.sales_builder(**now), table, changes.months_to_refresh(before, now))
    return _stored_sales(t, table)


@query("i3_changed_orders")
def _(t: Inputs) -> DataFrame:
    """The orders that a load changed, with the month each is in now."""
    now = _staged(t)
    changed = changes.changed_orders(_before_the_load(now), now)
    return changed.join(now["orders"], "order_id", "left").select(
        "order_id", C.month_start(F.to_date("purchased_at")).alias("order_month"))


def _state_after_a_load(t: Inputs) -> DataFrame:
    """State per person of the tables before a load, with the touched months computed anew, merged."""
    table, now = person_state.state_table(t.spark, scratch_path(t.spark, "state")), _staged(t)
    before = _before_the_load(now)

    def facts(of: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
        enriched = orders.orders_enriched(of["orders"], of["customers"], of["payments"])
        items = orders.order_items_enriched(of["items"], of["products"], of["categories"])
        return orders.mart_sales(enriched, items, of["reviews"]), enriched, of["reviews"]

    person_state.refresh_state(table, *facts(before))
    person_state.refresh_state(table, *facts(now), changes.months_to_refresh(before, now))
    return keep(person_state.merged(table.read()), "merged-state")


@query("m5_merged_state")
def _(t: Inputs) -> DataFrame:
    """Lifetime, scores and review averages from merged state."""
    return person_state.mart_customers(_state_after_a_load(t), ORDERS_AS_OF)


@query("m8_merged_state")
def _(t: Inputs) -> DataFrame:
    """Churn features from merged state."""
    return person_state.mart_customer_features(_state_after_a_load(t), ORDERS_AS_OF).withColumn(
        "stddev_order_value_brl", C.rounded(F.col("stddev_order_value_brl"), 4))


@query("m3_day_delta")
def _(t: Inputs) -> DataFrame:
    """Lifetime of all orders up to a day, to which the orders of later days are merged.

    The sales fact is stored for both parts with the columns that state takes of it.
    """
    sales = keep(t.sales().select(*person_state.SALES), "sales")
    enriched, reviews = t.orders_enriched(), t.stg_reviews()
    late = F.col("order_date") > F.lit(date(2001, 6, 14))
    parts = [person_state.merged(person_state.monthly_state(sales.where(when), enriched.where(when), reviews))
             for when in (~late, late)]
    return person_state.lifetime(person_state.merged(parts[0].unionByName(parts[1])), ORDERS_AS_OF)


def _undelivered_between(t: Inputs, start: date, end: date) -> I.Build:
    """A builder for which no order of a range of dates was delivered."""
    day = F.to_date("purchased_at")
    status = F.when(day.between(F.lit(start), F.lit(end)), "canceled").otherwise(F.col("order_status"))
    return orders.sales_builder(
        t.stg_orders().withColumn("order_status", status), t.stg_customers(), t.stg_order_payments(),
        t.stg_order_items(), t.stg_products(), t.stg_product_categories(), t.stg_reviews())


@query("i3_emptied_last_month")
def _(t: Inputs) -> DataFrame:
    """A refresh after all orders of the last stored month and later were canceled."""
    path = scratch_path(t.spark, "sales")
    I.write_partitioned(_sales_builder(t)(date(1995, 1, 1), date(2001, 6, 14)), path)
    I.incremental_refresh(t.spark, _undelivered_between(t, date(2001, 6, 1), date(2099, 1, 1)), path)
    return _stored_sales(t, path)


@query("i4_emptied_month")
def _(t: Inputs) -> DataFrame:
    """A backfill of two months, of which one has no delivered order any more."""
    path = scratch_path(t.spark, "sales")
    I.write_partitioned(t.sales(), path)
    I.backfill(_undelivered_between(t, date(1997, 3, 1), date(1997, 3, 31)), path,
               date(1997, 2, 10), date(1997, 3, 5))
    return _stored_sales(t, path)


# --- guards --------------------------------------------------------------

@query("g1_pii_documents")
def _(t: Inputs) -> DataFrame:
    return guards.pii_screen(t.source("documents"), "text").select(
        "doc_id", "has_email", "has_phone", "has_pii")


@query("g1_pii_questions")
def _(t: Inputs) -> DataFrame:
    return guards.pii_screen(t.query_audit(), "question").groupBy("has_email", "has_phone").agg(
        F.count(F.lit(1)).alias("questions"))


@query("g2_sql_guard")
def _(t: Inputs) -> DataFrame:
    return guards.sql_guard(t.generated_sql(), "sql")


@query("g2_missing_statement")
def _(t: Inputs) -> DataFrame:
    """A statement that is missing may not run."""
    sql = F.when(F.col("event_type") != "view", F.lit("SELECT 1"))
    return guards.sql_guard(t.source("events").select("event_id", sql.alias("sql")), "sql").select(
        "event_id", "reason", "is_valid")


@query("g3_parse_answer")
def _(t: Inputs) -> DataFrame:
    parsed = guards.parse_answer(t.raw_replies(), "raw")
    return parsed.select("conv_id", "turn", "sql", "explanation", _joined("tables_used"), "error")


@query("g3_answer_verdicts")
def _(t: Inputs) -> DataFrame:
    """Questions and replies through all checks in turn."""
    return guards.answer_verdicts(t.raw_replies(), "text", "raw").select(
        "conv_id", "turn", "sql", "error")


@query("g4_queries_by_table")
def _(t: Inputs) -> DataFrame:
    return audit.queries_by_table(audit.audit_records(t.query_audit()))


@query("g4_tokens_by_user")
def _(t: Inputs) -> DataFrame:
    return audit.tokens_by_user(audit.audit_records(t.query_audit()))
