"""Declared business metrics, evaluated over the marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import money_avg, money_sum, ratio


@dataclass(frozen=True)
class Metric:
    """``agg`` of a measure, or the quotient of two, times ``scale``."""

    model: str
    agg: str
    measure: str = ""
    numerator: str = ""
    denominator: str = ""
    scale: int = 1


# Names and definitions of the business metrics.
METRICS: dict[str, Metric] = {
    "gross_revenue_brl": Metric("mart_sales", "money_sum", "total_payment_brl"),
    "order_count": Metric("mart_sales", "count", "order_id"),
    "avg_order_value_brl": Metric("mart_sales", "ratio", numerator="gross_revenue_brl",
                                  denominator="order_count"),
    "avg_delivery_days": Metric("mart_sales", "average", "actual_delivery_days"),
    "on_time_delivery_rate": Metric("mart_sales", "average", "is_on_time", scale=100),
    "monthly_retention_rate": Metric("mart_cohorts", "ratio", numerator="retained_customers",
                                     denominator="cohort_size", scale=100),
    "customer_ltv_brl": Metric("mart_customers", "money_average", "ltv_brl"),
}

# Sums that only serve as parts of a ratio.
_PARTS: dict[str, Metric] = {
    "retained_customers": Metric("mart_cohorts", "sum", "retained_customers"),
    "cohort_size": Metric("mart_cohorts", "sum", "cohort_size"),
}


def _expression(metric: Metric) -> Column:
    if metric.agg == "ratio":
        parts = METRICS | _PARTS
        value = ratio(_expression(parts[metric.numerator]) * metric.scale,
                      _expression(parts[metric.denominator]))
    else:
        measure = F.col(metric.measure)
        value = {
            "sum": lambda: F.sum(measure),
            "money_sum": lambda: money_sum(measure),
            "money_average": lambda: money_avg(measure),
            "count": lambda: F.count(measure),
            "average": lambda: ratio(F.sum(measure.cast("int")) * metric.scale,
                                     F.count(measure)),
        }[metric.agg]()
    return value


def evaluate(table: DataFrame, *names: str, by: list[str | Column] | None = None,
             where: Column | None = None) -> DataFrame:
    """Metrics of one mart, grouped and filtered, in a single pass over it."""
    models = {METRICS[name].model for name in names}
    if len(models) != 1:
        raise ValueError(f"metrics of several models: {sorted(models)}")
    rows = table if where is None else table.where(where)
    return rows.groupBy(*(by or [])).agg(*[_expression(METRICS[n]).alias(n) for n in names])


def revenue_by_month(sales: DataFrame) -> DataFrame:
    month = F.trunc("order_date", "month").alias("order_month")
    return evaluate(sales, "gross_revenue_brl", "order_count", "avg_order_value_brl", by=[month])
