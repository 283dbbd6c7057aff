"""Calendar dimension and its use as a lookup for facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.columns import is_month_day, month_start, money_sum, sunday_week

# The range of the calendar, and holidays on fixed dates as (month, day).
FIRST_DAY = date(2016, 1, 1)
LAST_DAY = date(2030, 12, 31)
HOLIDAYS_BR = [
    (1, 1),    # New Year
    (4, 21),   # Tiradentes
    (5, 1),    # Labour Day
    (9, 7),    # Independence Day
    (10, 12),  # Our Lady of Aparecida
    (11, 2),   # All Souls Day
    (11, 15),  # Republic Day
    (12, 25),  # Christmas
]
HOLIDAYS_AR = [
    (1, 1),    # New Year
    (3, 24),   # Memory Day
    (4, 2),    # Malvinas Veterans Day
    (5, 1),    # Labour Day
    (5, 25),   # May Revolution
    (6, 20),   # Flag Day
    (7, 9),    # Independence Day
    (12, 8),   # Immaculate Conception
    (12, 25),  # Christmas
]
WEEKEND = [1, 7]  # Sunday and Saturday, weeks counted from Sunday = 1


def dim_date(spark: SparkSession, start: date = FIRST_DAY, end: date = LAST_DAY,
             end_inclusive: bool = False) -> DataFrame:
    """One row per day from ``start`` up to ``end``, which is left out by default."""
    last = F.lit(end) if end_inclusive else F.date_sub(F.lit(end), 1)
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), last)).alias("date_day"))
    return with_calendar(days)


def with_calendar(days: DataFrame) -> DataFrame:
    """The calendar attributes of a table of days (``date_day``)."""
    day = F.col("date_day")
    weekend = F.dayofweek(day).isin(WEEKEND)
    holiday_br = is_month_day(day, HOLIDAYS_BR)

    def label(prefix: Column) -> Column:
        return F.concat(prefix, F.lit(" "), F.year(day).cast("string"))

    return days.select(
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_name_short"),
        sunday_week(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_name_short"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        weekend.alias("is_weekend"),
        (day == month_start(day)).alias("is_first_day_of_month"),
        (day == F.last_day(day)).alias("is_last_day_of_month"),
        label(F.concat(F.lit("Q"), F.quarter(day).cast("string"))).alias("quarter_label"),
        label(F.date_format(day, "MMM")).alias("month_label"),
        holiday_br.alias("is_holiday_br"),
        is_month_day(day, HOLIDAYS_AR).alias("is_holiday_ar"),
        (~(weekend | holiday_br)).alias("is_business_day_br"),
    )


def sales_by_calendar(sales: DataFrame, calendar: DataFrame, *attributes: str) -> DataFrame:
    """Orders and revenue by calendar attributes; sales are summed per day before the join."""
    daily = sales.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("order_count"),
        money_sum(F.col("total_payment_brl")).alias("revenue_brl"))
    return (
        daily.join(calendar, daily.order_date == calendar.date_day)
        .groupBy(*attributes)
        .agg(F.sum("order_count").alias("order_count"),
             money_sum(F.col("revenue_brl")).alias("revenue_brl"))
    )
