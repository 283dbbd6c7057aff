"""Sums of persons that can be merged, so that a load recomputes only the months it touched.

A row of state holds what orders of one person add to lifetime, features and review averages:
counts, exact sums, first and last days, sets of states and categories, and the count, mean and
squared deviations of what was paid. Rows of state over different orders merge to the row over
all of them, whatever the grouping. The state is stored by person and month of the order, in a
table with versions; a month is computed from the orders of that month alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.columns import month_start, ratio, rounded
from cartwheel.plans import customers
from cartwheel.plans.orders import review_totals
from cartwheel.sources.versions import VersionedTable

PERSON, MONTH = "customer_unique_id", "order_month"
_SUMS = ("total_orders", "paid_orders", "paid_exact", "paid_plain", "delivery_sum", "delivery_count", "on_time",
         "late", "credit_card_orders", "boleto_orders", "voucher_orders", "score_sum", "scored",
         "five_star", "low_score", "any_score_sum", "any_scored")
_LEAST, _MOST = ("first_order_date", "min_paid"), ("last_order_date", "max_paid", "paid_size")
_SETS = ("states", "categories")
_MOMENTS = "moments"
#: What state takes of the sales fact.
SALES = ("order_id", PERSON, "order_date", "customer_state", "primary_category", "total_payment_brl",
         "actual_delivery_days", "is_on_time", "primary_payment_type")


def monthly_state(sales: DataFrame, enriched: DataFrame, reviews: DataFrame) -> DataFrame:
    """State by person and month, from the sales fact, enriched orders of any status, and reviews.

    Reviews are reduced to orders once, and meet delivered and other orders at that grain. Both
    kinds of rows are added up in one grouping. Of the sales fact only the columns :data:`SALES` are read.
    """
    totals = review_totals(reviews)
    paid, on_time, kind = F.col("total_payment_brl"), F.col("is_on_time"), F.col("primary_payment_type")
    month = month_start(F.col("order_date")).alias(MONTH)
    bought = sales.join(totals.drop("review_count"), "order_id", "left").select(
        PERSON, month, F.lit(True).alias("sold"), "order_id", "order_date", paid, "actual_delivery_days", on_time, kind,
        "customer_state", "primary_category", "score_sum", "scored", "five_star", "low_score")
    # A person's review average counts orders of any status.
    reviewed = enriched.select("order_id", PERSON, month).join(totals.where("scored > 0"), "order_id").select(
        PERSON, MONTH, F.col("score_sum").alias("any_score_sum"), F.col("scored").alias("any_scored"))
    rows = bought.unionByName(reviewed, allowMissingColumns=True)
    counts = {
        "total_orders": F.count("order_id"), "paid_orders": F.count(paid),
        "delivery_count": F.count("actual_delivery_days"),
        "on_time": F.count_if(on_time), "late": F.count_if(~on_time),
        **{f"{k}_orders": F.count_if(kind == k) for k in ("credit_card", "boleto", "voucher")}}
    state = rows.groupBy(PERSON, MONTH).agg(
        F.count("sold").alias("sold"), *(n.alias(name) for name, n in counts.items()),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"),
        F.sum(paid.try_cast("decimal(28,8)")).alias("paid_exact"),
        F.sum(paid).alias("paid_plain"), F.max(F.abs(paid)).alias("paid_size"),
        F.min(paid).alias("min_paid"), F.max(paid).alias("max_paid"),
        F.avg(paid).alias("mean"), F.var_pop(paid).alias("variance"),
        F.sum("actual_delivery_days").alias("delivery_sum"),
        *(F.array_sort(F.collect_set(c)).alias(name) for c, name in zip(("customer_state", "primary_category"), _SETS)),
        *(F.sum(c).alias(c) for c in ("score_sum", "scored", "five_star", "low_score", "any_score_sum", "any_scored")))
    moments = F.struct(F.col("paid_orders").alias("n"), F.col("mean"),
                       (F.col("variance") * F.col("paid_orders")).alias("squares"))
    # Without an order there are no counts, as there are no sums.
    return state.select(
        PERSON, MONTH, *(F.when(F.col("sold") > 0, F.col(c)).alias(c) if c in counts else F.col(c) for c in _SUMS),
        *_LEAST, *_MOST, *_SETS, F.when(F.col("paid_orders") > 0, moments).alias(_MOMENTS))


def _joined_moments(held: str) -> Column:
    """Count, mean and squared deviations of several parts together (Chan et al. 1979)."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def add(a: Column, b: Column) -> Column:
        n, step = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + step * b["n"] / n).alias("mean"),
                        (a["squares"] + b["squares"] + step * step * a["n"] * b["n"] / n).alias("squares"))

    return F.when(F.size(held) > 0, F.aggregate(held, none, add))


def merged(state: DataFrame, *keys: str) -> DataFrame:
    """Rows of state merged to one per key; by person if no key is given.

    Only parts of one person meet, at most one for each month or load: no large group.
    """
    keys = keys or (PERSON,)
    rows = state.groupBy(*keys).agg(
        *(F.sum(c).cast(state.schema[c].dataType).alias(c) for c in _SUMS),
        *(F.min(c).alias(c) for c in _LEAST), *(F.max(c).alias(c) for c in _MOST),
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in _SETS),
        F.collect_list(_MOMENTS).alias("parts"))
    return rows.withColumn(_MOMENTS, _joined_moments("parts")).drop("parts")


def lifetime(state: DataFrame, as_of: date) -> DataFrame:
    """:func:`cartwheel.plans.customers.customers_lifetime` from state merged by person."""
    first, last = F.col("first_order_date"), F.col("last_order_date")
    ltv = F.when(F.col("paid_size") < 1e18, F.col("paid_exact").cast("double")).otherwise(F.col("paid_plain"))
    return state.where("total_orders IS NOT NULL").select(
        PERSON, "total_orders", first, last, F.datediff(last, first).alias("customer_age_days"),
        ltv.alias("ltv_brl"), F.try_divide(ltv, F.col("paid_orders").cast("double")).alias("avg_order_value_brl"),
        F.datediff(F.lit(as_of), last).alias("days_since_last_order"))


def mart_customers(state: DataFrame, as_of: date) -> DataFrame:
    """:func:`cartwheel.plans.customers.mart_customers` from state merged by person."""
    reviewed = state.where(F.col(PERSON).isNotNull() & F.col("any_scored").isNotNull()).select(
        PERSON, rounded(ratio(F.col("any_score_sum"), F.col("any_scored")), 2).alias("avg_review_score"),
        F.col("any_scored").alias("reviews_count"))
    return customers.scored_customers(lifetime(state, as_of), reviewed)


def mart_customer_features(state: DataFrame, as_of: date) -> DataFrame:
    """:func:`cartwheel.plans.customers.mart_customer_features` from state merged by person."""
    n = F.col(f"{_MOMENTS}.n")
    more = state.where("total_orders IS NOT NULL").select(
        F.col(PERSON).alias("who"), "max_paid", "min_paid",
        F.when(n > 1, F.sqrt(F.col(f"{_MOMENTS}.squares") / (n - 1))).alias("stddev_paid"),
        ratio(F.col("delivery_sum"), F.col("delivery_count")).alias("delivery_days"), "on_time", "late",
        "credit_card_orders", "boleto_orders", "voucher_orders",
        F.size("states").cast("long").alias("states"), F.size("categories").cast("long").alias("categories"),
        "score_sum", "scored", "five_star", "low_score")
    people = lifetime(state, as_of).join(more, F.col(PERSON).eqNullSafe(F.col("who"))).drop("who")
    return customers.features_of(people, as_of)


def state_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, MONTH)


def _by_month(rows: DataFrame) -> Callable[[str], None]:
    """Writes rows with the months brought together: few files a month, not one of each task.

    Spark splits a large month over several tasks by its measured size.
    """
    return rows.hint("rebalance", F.col(MONTH)).write.partitionBy(MONTH).parquet


def refresh_state(table: VersionedTable, sales: DataFrame, enriched: DataFrame, reviews: DataFrame,
                  months: Iterable[date] | None = None) -> None:
    """Compute the state of some months anew (first days), all others stay; None for all months.

    Orders are cut to the months before reviews meet them. An order that moved between months
    touches both, see :func:`cartwheel.operators.changes.months_to_refresh`.
    """
    if months is None:
        rows = monthly_state(sales, enriched, reviews).where(F.col(MONTH).isNotNull())
        table.replace(rows, _by_month(rows))
        return
    chosen = sorted(set(months))
    if chosen:
        inside = month_start(F.col("order_date")).isin(chosen)
        rows = monthly_state(sales.where(inside), enriched.where(inside), reviews)
        names = {m.isoformat() for m in chosen}
        table.replace_partitions(rows, lambda month: month in names, _by_month(rows))
