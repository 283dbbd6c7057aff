"""Month-partitioned marts: full write, incremental refresh and backfill."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.columns import month_start
from cartwheel.sources.replace import Folders, recover, replace_months, replace_table
from cartwheel.sources.versions import VersionedTable

# The date that partitions the mart and the columns that cluster it.
DATE_COLUMN = "order_date"
MONTH_COLUMN = "order_month"
CLUSTER_BY = ("primary_category", "customer_state")

Build = Callable[[date | None, date | None], DataFrame]


def sales_table(spark: SparkSession, path: str) -> VersionedTable:
    """A table with versions that is partitioned by the month of the order date."""
    return VersionedTable(spark, path, MONTH_COLUMN)


def write_partitioned(df: DataFrame, target: str | VersionedTable,
                      months: tuple[date, date | None] | frozenset[date] | None = None) -> None:
    """Write by month of the order date, clustered inside each month.

    Rows are brought together by month; Spark splits a large month over several
    tasks and joins small ones, by their measured size. Inside a file they are
    sorted by the clustering columns, so each row group holds a narrow range for
    the reader to skip by. With ``months`` (first and last month, None for no last; or a set of them) those
    months are replaced, and one that ``df`` has no row of is emptied; other months stay. A
    write that fails leaves the table as it was. In a table with versions all months
    change at once, and a month that someone else wrote meanwhile is noticed.
    """
    monthly = df.withColumn(MONTH_COLUMN, month_start(F.col(DATE_COLUMN)))
    rows = (
        monthly.hint("rebalance", F.col(MONTH_COLUMN))
        .sortWithinPartitions(MONTH_COLUMN, *CLUSTER_BY)
        .write.partitionBy(MONTH_COLUMN)
    )
    def replaced(month: str) -> bool:
        if isinstance(months, frozenset):
            return month in {m.isoformat() for m in months}
        first, last = months
        return first.isoformat() <= month and (last is None or month <= last.isoformat())

    if isinstance(target, VersionedTable):
        if months is None:
            target.replace(monthly, rows.parquet)
        else:
            target.replace_partitions(monthly, replaced, rows.parquet)
    elif months is None:
        replace_table(df.sparkSession, target, rows.parquet)
    else:
        replace_months(df.sparkSession, target, MONTH_COLUMN, replaced, rows.parquet)


def stored(spark: SparkSession, target: str | VersionedTable) -> DataFrame:
    """The rows of a mart, wherever it is stored."""
    return target.read() if isinstance(target, VersionedTable) else spark.read.parquet(target)


def read_range(spark: SparkSession, target: str | VersionedTable, start: date,
               end: date | None = None) -> DataFrame:
    """Rows of a date range; the month filter lets Spark list only those folders."""
    rows = stored(spark, target)
    kept = rows.where((F.col(MONTH_COLUMN) >= F.lit(start.replace(day=1)))
                      & (F.col(DATE_COLUMN) >= F.lit(start)))
    if end is not None:
        kept = kept.where((F.col(MONTH_COLUMN) <= F.lit(end.replace(day=1)))
                          & (F.col(DATE_COLUMN) <= F.lit(end)))
    return kept


def last_date(spark: SparkSession, target: str | VersionedTable) -> date | None:
    """The latest order date, read from the last month alone; None for no rows or no table."""
    try:
        table = stored(spark, target)
    except FileNotFoundError:
        return None
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    last_month = table.agg(F.max(MONTH_COLUMN)).first()[0]
    if last_month is None:
        return None
    return table.where(F.col(MONTH_COLUMN) == F.lit(last_month)).agg(F.max(DATE_COLUMN)).first()[0]


def months_before(day: date, months: int) -> date:
    """The first day of the month that lies ``months`` before that of ``day``."""
    year, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    return date(year, month + 1, 1)


def incremental_refresh(spark: SparkSession, build: Build, target: str | VersionedTable,
                        look_back_months: int = 0) -> None:
    """Recompute from the last stored order date on, or so many months earlier.

    ``build(start, end)`` gives the mart for a range of order dates, None being an
    open side; a target without rows is built whole. The range is
    widened to the whole month, as a month is replaced as a whole: no row is
    doubled, none of the month is lost. What changes later in an older month, such as an
    order that is delivered after the month's last refresh or a late payment or review,
    stays out until a backfill, unless ``look_back_months`` reaches that month.
    """
    if not isinstance(target, VersionedTable):
        recover(Folders(spark, target), target)
    latest = last_date(spark, target)
    if latest is None:
        write_partitioned(build(None, None), target)
        return
    first = months_before(latest, look_back_months)
    write_partitioned(build(first, None), target, months=(first, None))


def month_bounds(start: date, end: date) -> tuple[date, date]:
    """First day of the first month and last day of the last month of a range."""
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    first = start.replace(day=1)
    after = date(end.year + end.month // 12, end.month % 12 + 1, 1)
    return first, date.fromordinal(after.toordinal() - 1)


def backfill(build: Build, target: str | VersionedTable, start: date, end: date) -> None:
    """Recompute the months that a date range touches; other months stay as they are.

    A month that has no row any more is emptied.
    """
    first, last = month_bounds(start, end)
    write_partitioned(build(first, last), target, months=(first, last))


def refresh_months(build: Callable[..., DataFrame], target: str | VersionedTable,
                   months: Iterable[date]) -> None:
    """Recompute some months, given by their first days; others are neither read nor written.

    ``build(months=...)`` gives the mart of these months. For the months that a load changed
    see :func:`cartwheel.operators.changes.months_to_refresh`.
    """
    chosen = frozenset(months)
    if chosen:
        write_partitioned(build(months=sorted(chosen)), target, months=chosen)
