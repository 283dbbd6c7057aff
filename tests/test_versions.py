"""Tables with versions, and swaps of path tables that fail or stop half way."""

from datetime import date, timedelta

import pytest
from conftest import rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartwheel.operators import incremental as I
from cartwheel.session import in_parallel, scratch_path
from cartwheel.sources import landing
from cartwheel.sources.catalog import Tables
from cartwheel.sources.replace import Folders, InterruptedSwap, _beside, replace_table
from cartwheel.sources.versions import ConcurrentWrite, VersionedTable

SALES = "order_id string, order_date date, primary_category string, customer_state string, total double"


def sales(frame, *days):
    return frame(SALES, *[(f"o{d}", date.fromisoformat(d), "k", "s", float(i)) for i, d in enumerate(days)])


def days(df):
    return sorted(str(r.order_date) for r in df.collect())


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.fixture
def table(spark):
    return VersionedTable(spark, scratch_path(spark, "versions"))


def failing(spark):
    return spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))


# --- versions ------------------------------------------------------------

def test_each_write_is_a_version(spark, table):
    assert table.version() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    for disposition, n in (("empty", 3), ("append", 2), ("truncate", 4)):
        landing.write_table(spark.range(n), table, disposition)
    assert [ids(table.read(v)) for v in (1, 2, 3)] == [[0, 1, 2], [0, 0, 1, 1, 2], [0, 1, 2, 3]]
    assert [(r.version, r.action, r.parts) for r in table.versions().orderBy("version").collect()] == [
        (1, "replace", 1), (2, "append", 2), (3, "replace", 1)]
    with pytest.raises(ValueError, match="not empty"):
        landing.write_table(spark.range(1), table, "empty")
    with pytest.raises(ValueError, match="no version 9"):
        table.read(9)
    assert landing.write_counted(spark.range(6), table) == 6
    assert not landing.write_if_nonempty(spark.range(0), table)
    assert table.version().number == 4


def test_a_failing_write_is_no_version_and_leaves_nothing(spark, table):
    table.replace(spark.range(3))
    for write in (table.replace, table.append):
        with pytest.raises(PySparkException):
            write(failing(spark))
    assert table.version().number == 1 and ids(table.read()) == [0, 1, 2]
    assert len(Folders(spark, table.path).names(table.path)) == 2  # the list and one write


def test_a_reader_keeps_its_version(spark, table):
    table.replace(spark.range(3))
    pinned = table.read()
    table.replace(pinned.where("id > 0"))
    table.append(spark.range(7, 8))
    assert ids(pinned) == [0, 1, 2]
    assert ids(table.read()) == [1, 2, 7]


def test_a_second_writer_is_noticed(spark, table):
    table.replace(spark.range(3))
    start = table.version()
    table.append(spark.range(3, 4))
    with pytest.raises(ConcurrentWrite):
        table.replace(spark.range(1), since=start)
    assert ids(table.read()) == [0, 1, 2, 3]
    # The name of the next version is taken between looking and committing.
    taken = VersionedTable(spark, table.path)
    taken.version = lambda number=None: VersionedTable.version(taken, number or 1)
    with pytest.raises(ConcurrentWrite):
        taken.replace(spark.range(1))
    assert ids(table.read()) == [0, 1, 2, 3]


def test_appends_at_the_same_time_all_count(spark, table):
    table.replace(spark.range(0))
    done = in_parallel(spark, {str(k): lambda k=k: VersionedTable(spark, table.path).append(spark.range(k, k + 1))
                               for k in range(8)}, workers=8)
    assert not [d for d in done.values() if isinstance(d, BaseException)]
    assert ids(table.read()) == list(range(8))
    assert sorted(d.number for d in done.values()) == list(range(2, 10))


def test_other_columns_are_refused_by_appends(spark, table):
    table.replace(spark.range(2))
    with pytest.raises(ValueError, match="columns differ"):
        table.append(spark.range(2).withColumn("more", F.lit(1)))
    table.replace(spark.range(2).withColumn("more", F.lit(1)))
    assert table.read().columns == ["id", "more"] and table.read(1).columns == ["id"]


def test_old_versions_are_removed(spark, table):
    for n in (1, 2, 3):
        table.replace(spark.range(n))
    table.append(spark.range(5, 6))
    lost = f"{table.path}/write=unfinished"
    spark.range(1).write.parquet(lost)
    assert table.remove_old(keep_versions=2) == [1, 2]
    assert ids(table.read()) == [0, 1, 2, 5] and ids(table.read(3)) == [0, 1, 2]
    files = Folders(spark, table.path)
    assert files.exists(lost)  # it may be a write that is not finished
    assert table.remove_old(1, unfinished=timedelta(0)) == [3]
    assert not files.exists(lost) and ids(table.read()) == [0, 1, 2, 5]
    with pytest.raises(ValueError):
        table.remove_old(0)


def test_months_change_at_once(spark, frame):
    table = I.sales_table(spark, scratch_path(spark, "months"))
    I.incremental_refresh(spark, lambda a, b: sales(frame, "2024-01-05", "2024-02-10", "2024-03-15"), table)
    before = I.stored(spark, table)
    I.backfill(lambda a, b: sales(frame, "2024-01-06"), table, date(2024, 1, 3), date(2024, 2, 20))
    assert days(before) == ["2024-01-05", "2024-02-10", "2024-03-15"]
    assert days(table.read()) == ["2024-01-06", "2024-03-15"]
    assert I.last_date(spark, table) == date(2024, 3, 15)
    I.incremental_refresh(spark, lambda a, b: sales(frame), table)
    assert days(table.read()) == ["2024-01-06"]
    with pytest.raises(ValueError, match="outside"):
        I.backfill(lambda a, b: sales(frame, "2024-05-01"), table, date(2024, 1, 3), date(2024, 2, 20))
    broken = sales(frame, "2024-01-07").withColumn("total", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(PySparkException):
        I.backfill(lambda a, b: broken, table, date(2024, 1, 1), date(2024, 1, 2))
    assert days(table.read()) == ["2024-01-06"]
    plan = I.read_range(spark, table, date(2024, 1, 1), date(2024, 1, 31))
    assert "order_month" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_backfills_of_different_months_get_along(spark, frame):
    table = I.sales_table(spark, scratch_path(spark, "months"))
    I.write_partitioned(sales(frame, "2024-01-05", "2024-02-10"), table)
    start = table.version()
    I.backfill(lambda a, b: sales(frame, "2024-01-06"), table, date(2024, 1, 1), date(2024, 1, 1))
    other = sales(frame, "2024-02-11").withColumn(I.MONTH_COLUMN, F.lit(date(2024, 2, 1)))
    table.replace_partitions(other, lambda month: month == "2024-02-01", since=start)
    assert days(table.read()) == ["2024-01-06", "2024-02-11"]
    with pytest.raises(ConcurrentWrite):
        table.replace_partitions(other, lambda month: month == "2024-02-01", since=start)


def test_marts_of_a_registry_can_have_versions(spark):
    tables = Tables(spark, scratch_path(spark, "tables"), versioned=True)
    first = tables.materialize("t", spark.range(3), "marts")
    tables.materialize("t", spark.range(9, 10), "marts")
    assert ids(first) == [0, 1, 2] and ids(tables.table("t", "marts")) == [9]


# --- swaps of path tables ------------------------------------------------

class Stop(BaseException):
    """The process ends here."""


@pytest.fixture
def breaking(monkeypatch):
    """Let the nth rename from now on fail, or end the process without any clean-up."""
    def install(nth, error=OSError):
        count = [0]

        def rename(self, old, new, f=Folders.rename):
            count[0] += 1
            if count[0] == nth:
                raise error("no more")
            f(self, old, new)
        monkeypatch.setattr(Folders, "rename", rename)
    yield install


@pytest.mark.parametrize("nth", range(1, 5))
def test_a_month_swap_that_fails_is_undone(spark, frame, breaking, monkeypatch, nth):
    path = scratch_path(spark, "months")
    old = ["2024-01-05", "2024-01-06", "2024-02-10", "2024-02-11", "2024-02-12"]
    I.write_partitioned(sales(frame, *old), path)
    new = sales(frame, "2024-02-20", "2024-03-20")
    with monkeypatch.context():
        breaking(nth)
        with pytest.raises(OSError):
            I.backfill(lambda a, b: new, path, date(2024, 1, 1), date(2024, 3, 1))
        monkeypatch.undo()
    assert days(spark.read.parquet(path)) == old
    parent = path.rpartition("/")[0]
    assert [n for n in Folders(spark, parent).names(parent) if path.rpartition("/")[2] in n] == [path.rpartition("/")[2]]
    I.backfill(lambda a, b: new, path, date(2024, 1, 1), date(2024, 3, 1))
    assert days(spark.read.parquet(path)) == ["2024-02-20", "2024-03-20"]


@pytest.mark.parametrize("nth", range(1, 5))
def test_a_month_swap_that_stops_is_undone_by_the_next_writer(spark, frame, monkeypatch, nth):
    root = scratch_path(spark, "marts")
    tables, path = Tables(spark, root), f"{root}/marts/sales"
    old = ["2024-01-05", "2024-02-10", "2024-02-11"]
    I.write_partitioned(sales(frame, *old), path)
    moves = []
    with monkeypatch.context() as patch:
        def rename(self, a, b, f=Folders.rename):
            moves.append((a, b))
            if len(moves) >= nth:
                raise Stop
            f(self, a, b)
        patch.setattr(Folders, "rename", rename)
        patch.setattr("cartwheel.sources.replace._undo_months", lambda files, path: None)
        with pytest.raises(Stop):
            I.backfill(lambda a, b: sales(frame, "2024-02-20", "2024-03-20"), path, date(2024, 1, 1), date(2024, 3, 1))
    with pytest.raises(InterruptedSwap):
        tables.table("sales", "marts")
    with pytest.raises(ValueError, match="outside"):  # a writer that does not get far still undoes it
        I.backfill(lambda a, b: sales(frame, "2025-01-01"), path, date(2024, 1, 1), date(2024, 3, 1))
    assert days(tables.table("sales", "marts")) == old


@pytest.mark.parametrize("disposition, rows", [("append", 11), ("truncate", 1)])
def test_writes_after_a_stopped_swap_lose_nothing(spark, disposition, rows):
    root = scratch_path(spark, "raw")
    path, tables = f"{root}/raw/t", Tables(spark, root)
    landing.write_table(spark.range(10), path)
    Folders(spark, path).rename(path, _beside(path, "old"))  # as if stopped between the renames
    with pytest.raises(InterruptedSwap):
        tables.table("t")
    with pytest.raises(ValueError, match="not empty"):
        landing.write_table(spark.range(1), path, "empty")
    assert tables.table("t").count() == 10
    Folders(spark, path).rename(path, _beside(path, "old"))
    landing.write_table(spark.range(1), path, disposition)
    assert tables.table("t").count() == rows
    landing.write_table(tables.table("t"), path)
    assert tables.table("t").count() == rows


def test_a_swap_that_fails_puts_the_table_back(spark, breaking, monkeypatch):
    path = scratch_path(spark, "swap")
    landing.write_table(spark.range(10), path)
    breaking(2)
    with pytest.raises(OSError):
        replace_table(spark, path, spark.range(1).write.parquet)
    monkeypatch.undo()
    assert spark.read.parquet(path).count() == 10
    assert rows_of(spark.read.parquet(path)) == [{"id": n} for n in range(10)]
