"""Scalar and aggregate column expressions, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# --- money ---------------------------------------------------------------

def money_sum(amount: Column) -> Column:
    """Sum of a money column, the same whatever the order of the rows.

    Amounts are summed as decimals of eight places, so parts of a cent count. If any
    amount is not below 1e18 in size, or is infinite or NaN, the plain sum of floating
    point numbers is given, which is then as large, infinite or NaN.
    """
    exact = F.sum(amount.try_cast("decimal(28,8)")).cast("double")
    return F.when(F.max(F.abs(amount)) < 1e18, exact).otherwise(F.sum(amount))


def money_avg(amount: Column) -> Column:
    return F.try_divide(money_sum(amount), F.count(amount).cast("double"))


# --- numbers -------------------------------------------------------------

def ratio(numerator: Column, denominator: Column) -> Column:
    """Float division that gives NULL instead of an error for a zero divisor."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded(value: Column, digits: int) -> Column:
    """Round half away from zero, as the decimal number that the value stands for.

    A binary quotient can lie a hair below the half it means, as 886731.09 / 6 does;
    eight decimals are kept before rounding, which takes such a hair away. A number of
    1e20 or more, which such a decimal does not hold, is rounded as it is; infinity and NaN stay.
    """
    exact = F.round(value.try_cast("decimal(28,8)"), digits).cast("double")
    return F.coalesce(exact, F.round(value.cast("double"), digits))


# --- dates ---------------------------------------------------------------

def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(F.to_date(later), F.to_date(earlier))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole months from one month to another; days of the month do not count."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def sunday_week(day: Column) -> Column:
    """Week of the year with weeks starting on Sunday; 0 before the first Sunday."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def is_month_day(day: Column, month_days: list[tuple[int, int]]) -> Column:
    """Whether the date falls on one of the (month, day) pairs in any year."""
    return (F.month(day) * 100 + F.dayofmonth(day)).isin([m * 100 + d for m, d in month_days])


# --- text ----------------------------------------------------------------

def mask_zip(zip_code: Column) -> Column:
    """First three characters followed by two stars; NULL stays NULL."""
    return F.concat(F.substring(zip_code, 1, 3), F.lit("**"))


def shorten(text: Column, width: int) -> Column:
    """The first ``width`` characters, with three dots only where something was cut."""
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))) \
        .otherwise(text)


def version_label(day: Column, version: Column) -> Column:
    return F.concat(F.date_format(day, "dd.MM"), F.lit(" (v"), version.cast("string"), F.lit(")"))


# --- histories -----------------------------------------------------------

def differs(left: Column, right: Column) -> Column:
    """NULL-safe inequality."""
    return ~left.eqNullSafe(right)


def version_id(key: Column, run_ts: Column) -> Column:
    stamp = F.date_format(run_ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", key.cast("string"), stamp))
