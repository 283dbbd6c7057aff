"""Data-quality checks. A check gives the violating rows; no rows means it passed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: an open period counts as ending here.
OPEN_END = datetime(9999, 12, 31)


# --- generic checks ------------------------------------------------------

def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with their number of rows; NULL passes."""
    return (df.where(~F.col(column).isin(values)).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, column: str, parent: DataFrame,
                  parent_column: str) -> DataFrame:
    """Foreign-key values without a parent, with their number of rows.

    Counted per value first, so a value that fills the child table is one row in
    the join.
    """
    used = (child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
                 .agg(F.count(F.lit(1)).alias("n_records")))
    known = parent.select(F.col(parent_column).alias("value"))
    return used.join(known, "value", "left_anti")


# --- checks of single models ---------------------------------------------

def delivery_before_purchase(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("delivered_to_customer_at") < F.col("purchased_at")).select("order_id")


def negative_revenue(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("total_payment_brl") < 0).select("order_id")


def retention_out_of_range(cohorts: DataFrame) -> DataFrame:
    return cohorts.where(~F.col("retention_rate_pct").between(0, 100)).select(
        "cohort_month", "months_since_first_order", "retention_rate_pct")


def overlapping_periods(history: DataFrame, key: str) -> DataFrame:
    """Keys with two versions valid at the same time.

    Instead of pairing all versions of a key, versions that start together are
    first merged to their count and latest end. What is left has one row per key
    and run; it is walked in order of start with the latest end so far.
    """
    start, end = F.col("dbt_valid_from"), F.coalesce(
        "dbt_valid_to", F.lit(OPEN_END).cast("timestamp"))
    starts = (
        history.select(key, "dbt_scd_id", start.alias("s"), end.alias("e"))
        .groupBy(key, "s")
        .agg(F.max("e").alias("latest_end"),
             F.count_distinct(F.when(F.col("e") > F.col("s"), F.col("dbt_scd_id"))).alias("live"))
    )
    earlier = Window.partitionBy(key).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    clash = (F.col("live") > 1) | (F.col("s") < F.max("latest_end").over(earlier))
    return starts.select(key, clash.alias("clash")).where("clash").select(key).distinct()


def duplicate_versions(history: DataFrame, key: str) -> DataFrame:
    """(key, start) pairs that occur twice; the period check lets equal ids pass."""
    return (history.groupBy(key, "dbt_valid_from")
                   .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))


def daily_volumes(sales: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Orders per day next to the mean of the seven rows before.

    A day without orders has no row. With ``calendar`` (``date_day``) every day of
    it has one. The window runs over one row per day.
    """
    days = sales.groupBy("order_date").agg(F.count(F.lit(1)).alias("order_count"))
    if calendar is not None:
        days = (calendar.select(F.col("date_day").alias("order_date"))
                        .join(days, "order_date", "left")
                        .select("order_date", F.coalesce("order_count", F.lit(0))
                                               .alias("order_count")))
    before = Window.orderBy("order_date").rowsBetween(-7, -1)
    return days.select(
        "order_date", "order_count",
        F.sum("order_count").over(before).alias("previous_orders"),
        F.count("order_count").over(before).alias("previous_days"),
        F.avg("order_count").over(before).alias("avg_last_7_days"),
    )


def volume_anomalies(sales: DataFrame, as_of: date | None = None,
                     calendar: DataFrame | None = None) -> DataFrame:
    """Days with less than 70 % of that mean; only ``as_of`` if given.

    Compared in whole numbers, so exactly 70 % passes whatever the mean.
    """
    days = daily_volumes(sales, calendar)
    low = days.where(F.col("order_count") * 10 * F.col("previous_days")
                     < F.col("previous_orders") * 7)
    if as_of is not None:
        low = low.where(F.col("order_date") == F.lit(as_of))
    return low.select("order_date")


# --- suites --------------------------------------------------------------

@dataclass(frozen=True)
class ColumnRules:
    """Checks declared for one column."""

    table: str
    column: str
    not_null: bool = True
    unique: bool = False
    accepted: tuple = ()


@dataclass(frozen=True)
class ModelCheck:
    """A named check on whole tables: ``run(tables)`` gives the violating rows."""

    name: str
    table: str
    run: Callable[[dict[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class Suite:
    columns: tuple[ColumnRules, ...] = ()
    models: tuple[ModelCheck, ...] = field(default=())


class ChecksFailed(RuntimeError):
    """Some checks found violating rows; ``report`` has a row per check."""

    def __init__(self, report: DataFrame, failed: list[str]):
        super().__init__(f"failing checks: {', '.join(failed)}")
        self.report = report


# The checks declared for raw tables and marts, and their value lists.
ORDER_STATUSES = ("delivered", "shipped", "canceled", "invoiced", "processing", "approved",
                  "unavailable", "created")
RFM_SEGMENTS = ("champion", "loyal", "at_risk", "hibernating", "new", "lost")
PRICE_DIRECTIONS = ("first_record", "increase", "decrease", "unchanged")

SOURCE_SUITE = Suite((
    ColumnRules("orders", "order_id", unique=True),
    ColumnRules("orders", "customer_id"),
    ColumnRules("orders", "order_status", accepted=ORDER_STATUSES),
    ColumnRules("orders", "order_purchase_timestamp"),
    ColumnRules("order_items", "order_id"),
    ColumnRules("order_items", "order_item_id"),
    ColumnRules("order_items", "price"),
    ColumnRules("customers", "customer_id", unique=True),
    ColumnRules("sellers", "seller_id", unique=True),
    ColumnRules("products", "product_id", unique=True),
    ColumnRules("order_payments", "order_id"),
    ColumnRules("reviews", "order_id"),
    ColumnRules("product_categories", "product_category_name", unique=True),
    ColumnRules("marketplace_products", "product_id"),
))

MART_SUITE = Suite(
    (
        ColumnRules("mart_sales", "order_id", unique=True),
        ColumnRules("mart_sales", "customer_id"),
        ColumnRules("mart_sales", "order_date"),
        ColumnRules("mart_sales", "total_payment_brl"),
        ColumnRules("mart_customers", "customer_unique_id", unique=True),
        ColumnRules("mart_customers", "total_orders"),
        ColumnRules("mart_customers", "ltv_brl"),
        ColumnRules("mart_customers", "rfm_segment", accepted=RFM_SEGMENTS),
        ColumnRules("mart_customers", "r_score"),
        ColumnRules("mart_customers", "days_since_last_order"),
        ColumnRules("mart_cohorts", "cohort_month"),
        ColumnRules("mart_cohorts", "months_since_first_order"),
        ColumnRules("mart_cohorts", "cohort_size"),
        ColumnRules("mart_cohorts", "retained_customers"),
        ColumnRules("mart_cohorts", "retention_rate_pct"),
        ColumnRules("mart_sellers", "seller_id", unique=True),
        ColumnRules("mart_sellers", "total_orders"),
        ColumnRules("mart_sellers", "total_revenue_brl"),
        ColumnRules("mart_price_history", "product_id"),
        ColumnRules("mart_price_history", "valid_from"),
        ColumnRules("mart_price_history", "is_current"),
        ColumnRules("mart_price_history", "price_change_direction", accepted=PRICE_DIRECTIONS),
        ColumnRules("dim_date", "date_day", unique=True),
        ColumnRules("dim_date", "year"),
        ColumnRules("dim_date", "is_weekend"),
        ColumnRules("dim_date", "is_holiday_br"),
        ColumnRules("dim_date", "is_holiday_ar"),
        ColumnRules("dim_date", "is_business_day_br"),
        ColumnRules("mart_customer_features", "customer_unique_id", unique=True),
        ColumnRules("mart_customer_features", "is_churned"),
        ColumnRules("mart_customer_features", "is_at_risk"),
    ),
    (
        ModelCheck("delivery_after_purchase", "mart_sales",
                   lambda t: delivery_before_purchase(t["mart_sales"])),
        ModelCheck("revenue_non_negative", "mart_sales",
                   lambda t: negative_revenue(t["mart_sales"])),
        ModelCheck("retention_rate_valid", "mart_cohorts",
                   lambda t: retention_out_of_range(t["mart_cohorts"])),
        ModelCheck("scd_no_overlapping_periods", "snap_products",
                   lambda t: overlapping_periods(t["snap_products"], "product_id")),
        ModelCheck("scd_unique_versions", "snap_products",
                   lambda t: duplicate_versions(t["snap_products"], "product_id")),
    ),
)


def volume_check(as_of: date) -> ModelCheck:
    return ModelCheck("volume_anomaly_orders", "mart_sales",
                      lambda t: volume_anomalies(t["mart_sales"], as_of))


def _column_report(df: DataFrame, table: str, rules: list[ColumnRules]) -> DataFrame:
    """The checks of a table's columns, in one pass over it and one shuffle.

    A row gives an entry for each rule it breaks, and for each unique column its value; entries
    are counted by check and value, where each column has a key of its own type. A task adds up the
    entries it has, so a value that fills the table, or a column of NULLs, is one row of it.
    Tables whose only keyed rule is one unique column need no entries, see :func:`_counted_report`.
    """
    keyed = [rule for rule in rules if rule.unique or rule.accepted]
    if len(keyed) <= 1 and not any(rule.accepted for rule in rules):
        return _counted_report(df, table, rules, keyed[0].column if keyed else None)
    names = [f"_key{i}" for i in range(len(keyed))]

    def entry(check: str, counts: str, rule: ColumnRules | None = None) -> Column:
        keys = [(F.col(rule.column) if rule is own else F.lit(None).cast(df.schema[own.column].dataType)).alias(name)
                for name, own in zip(names, keyed)]
        return F.struct(F.lit(check).alias("check"), F.lit(counts).alias("counts"), *keys)

    entries, checks = [], []
    for rule in rules:
        value = F.col(rule.column)
        if rule.not_null:
            checks.append(f"not_null_{rule.column}")
            entries.append(F.when(value.isNull(), entry(checks[-1], "rows")))
        if rule.unique:
            checks.append(f"unique_{rule.column}")
            entries.append(F.when(value.isNotNull(), entry(checks[-1], "repeated values", rule)))
        if rule.accepted:
            checks.append(f"accepted_values_{rule.column}")
            entries.append(F.when(~value.isin(list(rule.accepted)), entry(checks[-1], "values", rule)))
    broken = df.select(F.explode(F.array_compact(F.array(*entries))).alias("entry")).select("entry.*")
    values = broken.groupBy("check", "counts", *names).agg(F.count(F.lit(1)).alias("n"))
    found = F.when(F.col("counts") == "rows", F.col("n")).when(
        F.col("counts") == "repeated values", (F.col("n") > 1).cast("long")).otherwise(1)
    # Checks without an entry found nothing.
    declared = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, checks))).alias("check"), F.lit(0).alias("n"))
    return (
        values.select("check", found.cast("long").alias("n")).unionByName(declared.withColumn("n", F.col("n").cast("long")))
        .groupBy("check").agg(F.sum("n").alias("failures"))
        .select("check", F.lit(table).alias("table"), "failures"))


def _counted_report(df: DataFrame, table: str, rules: list[ColumnRules], key: str | None) -> DataFrame:
    """NULLs of columns and repeated values of at most one: counted per value of that one, then in all."""
    nulls = [rule.column for rule in rules if rule.not_null]
    counts = [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(nulls)]
    if key is None:
        whole = df.agg(*counts)
    else:
        values = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *counts)
        whole = values.agg(F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias("_repeated"),
                           *(F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_null_{i}") for i in range(len(nulls))))
    found = [(f"not_null_{c}", f"_null_{i}") for i, c in enumerate(nulls)]
    found += [(f"unique_{key}", "_repeated")] if key else []
    return whole.select(F.inline(F.array(*(F.struct(
        F.lit(check).alias("check"), F.lit(table).alias("table"), F.col(n).cast("long").alias("failures"))
        for check, n in found))))


def run_suite(suite: Suite, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check: ``check, table, failures, status``.

    All column checks of a table are made in one pass over it. Checks of tables
    that are not given are left out.
    """
    reports = []
    for table in dict.fromkeys(rule.table for rule in suite.columns):
        if table in tables:
            rules = [rule for rule in suite.columns if rule.table == table]
            reports.append(_column_report(tables[table], table, rules))
    for check in suite.models:
        if check.table in tables:
            reports.append(_report(check.name, check.table, check.run(tables)))
    report = reduce(DataFrame.unionByName, reports)
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def _report(name: str, table: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("check"), F.lit(table).alias("table"), "failures")


def gate(suite: Suite, tables: dict[str, DataFrame]) -> DataFrame:
    """Run the suite and raise :class:`ChecksFailed` so that the next layer is not built."""
    report = run_suite(suite, tables)
    rows = report.collect()  # one row per declared check
    stored = report.sparkSession.createDataFrame(rows, report.schema)
    failed = [f"{r['table']}.{r['check']}" for r in rows if r["status"] == "fail"]
    if failed:
        raise ChecksFailed(stored, failed)
    return stored
