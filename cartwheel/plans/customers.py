"""Customer lifetime, RFM segments, cohort retention and churn features."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import (
    money_avg, money_sum, month_start, months_between_starts, ratio, rounded,
)
from cartwheel.operators.ranking import Ntile, global_ntile
from cartwheel.plans.orders import delivered_orders, review_totals
from cartwheel.session import keep

# Days without an order after which a customer is churned, at risk, inactive.
CHURN_DAYS = 365
AT_RISK_DAYS = 180
ACTIVE_DAYS = 365


def _lifetime_measures(as_of: date) -> list[Column]:
    """Over rows that are unique by order, which the checks make sure of."""
    first, last = F.min("order_date"), F.max("order_date")
    paid = F.col("total_payment_brl")
    return [
        F.count("order_id").alias("total_orders"),
        first.alias("first_order_date"),
        last.alias("last_order_date"),
        F.datediff(last, first).alias("customer_age_days"),
        money_sum(paid).alias("ltv_brl"),
        money_avg(paid).alias("avg_order_value_brl"),
        F.datediff(F.lit(as_of), last).alias("days_since_last_order"),
    ]


def customers_lifetime(orders_enriched: DataFrame, as_of: date) -> DataFrame:
    """One row per person, over delivered orders of all their accounts."""
    return delivered_orders(orders_enriched).groupBy("customer_unique_id").agg(
        *_lifetime_measures(as_of))


def active_customers(customers: DataFrame, as_of: date) -> DataFrame:
    """Customers with an order in the last 365 days."""
    return customers.where(F.col("last_order_date") >= F.date_sub(F.lit(as_of), ACTIVE_DAYS))


def rfm_scores(lifetime: DataFrame) -> DataFrame:
    """Recency, frequency and money quartiles over all customers; equal values by id."""
    return global_ntile(
        lifetime, "customer_unique_id",
        Ntile("r_score", "days_since_last_order", descending=True),
        Ntile("f_score", "total_orders"),
        Ntile("m_score", "ltv_brl"),
    )


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """The first rule that holds names the segment."""
    frequent, big, recent = f >= 3, m >= 3, r >= 3
    return (
        F.when((r == 4) & frequent & big, "champion")
        .when(frequent & big, "loyal")
        .when(~recent & frequent, "at_risk")
        .when(~recent & ~frequent, "hibernating")
        .when(recent & ~frequent, "new")
        .otherwise("lost")
    )


def customer_reviews(orders_enriched: DataFrame, reviews: DataFrame) -> DataFrame:
    """Average score per person over orders of any status."""
    scored = review_totals(reviews).where("scored > 0")
    return (
        orders_enriched.select("order_id", "customer_unique_id").join(scored, "order_id")
        .groupBy("customer_unique_id")
        .agg(rounded(ratio(F.sum("score_sum"), F.sum("scored")), 2).alias("avg_review_score"),
             F.sum("scored").alias("reviews_count"))
    )


def mart_customers(lifetime: DataFrame, orders_enriched: DataFrame,
                   reviews: DataFrame) -> DataFrame:
    """One row per person with RFM scores, segment and review average.

    The lifetime table is stored first, as the scoring reads it several times.
    """
    return scored_customers(lifetime, customer_reviews(orders_enriched, reviews))


def scored_customers(lifetime: DataFrame, review_averages: DataFrame) -> DataFrame:
    """The same from review averages per person."""
    scores = rfm_scores(keep(lifetime, "lifetime"))
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (
        scores.join(review_averages, "customer_unique_id", "left")
        .select(
            "customer_unique_id", "first_order_date", "last_order_date", "customer_age_days",
            "days_since_last_order", "total_orders",
            F.coalesce(rounded(F.col("ltv_brl"), 2), F.lit(0.0)).alias("ltv_brl"),
            rounded(F.col("avg_order_value_brl"), 2).alias("avg_order_value_brl"),
            "r_score", "f_score", "m_score", (r + f + m).alias("rfm_total"),
            rfm_segment(r, f, m).alias("rfm_segment"),
            "avg_review_score", "reviews_count",
        )
    )


def mart_cohorts(orders_enriched: DataFrame, max_offset: int = 12) -> DataFrame:
    """Retention by month of the first order and months since then.

    Orders are reduced to one row per person and month before a person's first
    month is looked up, so no person is a large group.
    """
    months = (
        delivered_orders(orders_enriched).where(F.col("customer_unique_id").isNotNull())
        .select("customer_unique_id", month_start(F.col("order_date")).alias("activity_month"))
        .distinct()
    )
    first = F.min("activity_month").over(Window.partitionBy("customer_unique_id"))
    offset = months_between_starts(F.col("activity_month"), F.col("cohort_month"))
    retained = (
        months.withColumn("cohort_month", first)
        .withColumn("months_since_first_order", offset)
        .where(F.col("months_since_first_order").between(0, max_offset))
        .groupBy("cohort_month", "months_since_first_order")
        .agg(F.count(F.lit(1)).alias("retained_customers"))
    )
    # everybody is active in the first month, so that count is the size of the cohort
    size = F.max(F.when(F.col("months_since_first_order") == 0, F.col("retained_customers"))) \
        .over(Window.partitionBy("cohort_month"))
    rate = ratio(F.col("retained_customers") * 100, F.col("cohort_size"))
    return (
        retained.withColumn("cohort_size", size)
        .select("cohort_month", "months_since_first_order", "cohort_size", "retained_customers",
                rounded(rate, 2).alias("retention_rate_pct"))
        .orderBy("cohort_month", "months_since_first_order")
    )


def mart_customer_features(sales: DataFrame, reviews: DataFrame, as_of: date) -> DataFrame:
    """Churn features, one row per person, from the sales fact and the reviews of its orders.

    One join at order grain and one grouping by person give all features. Orders
    of unknown persons form one row without order, review and category measures,
    as these would be looked up by a key that is NULL.
    """
    orders = sales.join(review_totals(reviews).drop("review_count"), "order_id", "left")
    paid, on_time = F.col("total_payment_brl"), F.col("is_on_time")
    by_type = {
        kind: F.count_if(F.col("primary_payment_type") == kind).alias(f"{kind}_orders")
        for kind in ("credit_card", "boleto", "voucher")
    }
    people = orders.groupBy("customer_unique_id").agg(
        *_lifetime_measures(as_of),
        F.max(paid).alias("max_paid"),
        F.min(paid).alias("min_paid"),
        F.stddev_samp(paid).alias("stddev_paid"),
        F.avg("actual_delivery_days").alias("delivery_days"),
        F.count_if(on_time).alias("on_time"),
        F.count_if(~on_time).alias("late"),
        *by_type.values(),
        # Few different values: a set each is summed up where it is read.
        F.size(F.collect_set("customer_state")).cast("long").alias("states"),
        F.size(F.collect_set("primary_category")).cast("long").alias("categories"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("scored").alias("scored"),
        F.sum("five_star").alias("five_star"),
        F.sum("low_score").alias("low_score"),
    )
    return features_of(people, as_of)


def features_of(people: DataFrame, as_of: date) -> DataFrame:
    """The features from a person's sums."""
    kinds = ("credit_card", "boleto", "voucher")
    known = F.col("customer_unique_id").isNotNull()

    def looked_up(value: Column | str) -> Column:
        return F.when(known, F.col(value) if isinstance(value, str) else value)

    def or_zero(value: Column | str, zero=0) -> Column:
        return F.coalesce(looked_up(value), F.lit(zero))

    orders_n, age, idle = F.col("total_orders"), F.col("customer_age_days"), F.col(
        "days_since_last_order")
    return people.select(
        "customer_unique_id",
        "days_since_last_order",
        F.datediff(F.lit(as_of), "first_order_date").alias("days_since_first_order"),
        "total_orders",
        (ratio(orders_n, age) * 30).alias("orders_per_month"),
        ratio(age, orders_n - 1).alias("avg_days_between_orders"),
        "ltv_brl",
        "avg_order_value_brl",
        looked_up("max_paid").alias("max_order_value_brl"),
        looked_up("min_paid").alias("min_order_value_brl"),
        or_zero("stddev_paid", 0.0).alias("stddev_order_value_brl"),
        or_zero(ratio(F.col("score_sum"), F.col("scored")), 0.0).alias("avg_review_score"),
        or_zero("scored").alias("reviews_count"),
        or_zero("five_star").alias("five_star_reviews"),
        or_zero("low_score").alias("low_score_reviews"),
        or_zero("delivery_days", 0.0).alias("avg_delivery_days"),
        or_zero("on_time").alias("on_time_orders"),
        or_zero("late").alias("late_orders"),
        ratio(or_zero("on_time"), orders_n).alias("on_time_rate"),
        *[or_zero(f"{kind}_orders").alias(f"{kind}_orders") for kind in kinds],
        or_zero("categories").alias("unique_categories_count"),
        or_zero("states").alias("states_ordered_from"),
        (idle > CHURN_DAYS).cast("int").alias("is_churned"),
        (idle > AT_RISK_DAYS).cast("int").alias("is_at_risk"),
    )
