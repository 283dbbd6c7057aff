"""Writers that fail leave the old table; lost months, broken run chains, odd amounts."""

from datetime import date, datetime

import pytest
from conftest import rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartwheel.functions.columns import money_avg, money_sum
from cartwheel.operators import history as H
from cartwheel.operators import incremental as I
from cartwheel.plans import guards
from cartwheel.session import keep, scratch_path, scratch_scope, shared_folder
from cartwheel.sources import files, landing
from cartwheel.sources.catalog import Tables
from cartwheel.sources.replace import Folders, _beside, replace_table


@pytest.fixture
def old(spark):
    return spark.range(10)


@pytest.fixture
def failing(spark):
    """Rows of which the last one fails the job."""
    return spark.range(10, 20).select(
        F.when(F.col("id") == 19, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))


WRITERS = {
    "write_table": lambda df, path: landing.write_table(df, path),
    "write_counted": lambda df, path: landing.write_counted(df, path),
    "write_if_nonempty": lambda df, path: landing.write_if_nonempty(df, path),
    "append": lambda df, path: landing.write_table(df, path, "append"),
    "materialize": lambda df, path: Tables(
        df.sparkSession, path.rpartition("/marts/")[0]).materialize("t", df, "marts"),
}


@pytest.mark.parametrize("writer", WRITERS)
def test_a_failing_write_keeps_the_table(spark, old, failing, writer):
    path = scratch_path(spark, "safe") + "/marts/t"
    WRITERS[writer](old, path)
    with pytest.raises(PySparkException):
        WRITERS[writer](failing, path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(10))
    WRITERS[writer](spark.range(3), path)
    assert spark.read.parquet(path).count() == (13 if writer == "append" else 3)
    parent = path.rpartition("/")[0]
    assert Folders(spark, parent).names(parent) == ["t"]  # nothing is left beside it


def test_a_table_can_replace_itself(spark, old):
    path = scratch_path(spark, "self")
    landing.write_table(old, path)
    landing.write_table(spark.read.parquet(path).where("id > 4"), path)
    assert spark.read.parquet(path).count() == 5


def test_an_interrupted_swap_is_undone(spark, old):
    path = scratch_path(spark, "swap")
    landing.write_table(old, path)
    Folders(spark, path).rename(path, _beside(path, "old"))

    def fail(_):
        raise OSError("no space")

    with pytest.raises(OSError):
        replace_table(spark, path, fail)
    assert spark.read.parquet(path).count() == 10


SALES = "order_id string, order_date date, primary_category string, customer_state string, total double"


def sales(frame, *days):
    return frame(SALES, *[(f"o{i}", date.fromisoformat(d), "k", "s", float(i)) for i, d in enumerate(days)])


def stored_days(spark, path):
    return sorted(str(r.order_date) for r in spark.read.parquet(path).collect())


def test_months_that_lost_their_rows_are_emptied(spark, frame, failing):
    path = scratch_path(spark, "months")
    full = sales(frame, "2024-01-05", "2024-02-10", "2024-03-15")
    I.write_partitioned(full, path)
    I.backfill(lambda a, b: sales(frame, "2024-01-06"), path, date(2024, 1, 3), date(2024, 2, 20))
    assert stored_days(spark, path) == ["2024-01-06", "2024-03-15"]
    I.incremental_refresh(spark, lambda a, b: sales(frame), path)
    assert stored_days(spark, path) == ["2024-01-06"]
    with pytest.raises(ValueError, match="outside"):
        I.backfill(lambda a, b: sales(frame, "2024-05-01"), path, date(2024, 1, 3), date(2024, 2, 20))
    broken = full.withColumn("total", F.raise_error(F.lit("broken")).cast("double"))
    for write in (lambda: I.write_partitioned(broken, path),
                  lambda: I.backfill(lambda a, b: broken, path, date(2024, 1, 1), date(2024, 3, 1))):
        with pytest.raises(PySparkException):
            write()
        assert stored_days(spark, path) == ["2024-01-06"]


def test_a_look_back_reaches_older_months(spark, frame):
    path, asked = scratch_path(spark, "look"), []
    I.write_partitioned(sales(frame, "2023-12-05", "2024-02-10"), path)

    def build(start, end):
        asked.append((start, end))
        return sales(frame, "2023-12-06", "2024-02-10")

    I.incremental_refresh(spark, build, path, look_back_months=2)
    assert asked == [(date(2023, 12, 1), None)]
    assert stored_days(spark, path) == ["2023-12-06", "2024-02-10"]


SELLERS = "seller_id string, city string, state string"


def test_a_broken_chain_of_runs_is_refused(spark, frame):
    base = scratch_path(spark, "history")
    days = [datetime(2024, 1, d) for d in (1, 2, 3)]
    one, two = frame(SELLERS, ("a", "x", "s"), ("b", "y", "s")), frame(SELLERS, ("a", "x", "s"))
    H.record_run(H.SNAP_SELLERS, base, one, days[0])
    for wrong in (None, days[1]):  # runs are there; that run is not
        with pytest.raises(ValueError, match="last finished run"):
            H.record_run(H.SNAP_SELLERS, base, two, days[2], wrong)
    H.record_run(H.SNAP_SELLERS, base, two, days[1], days[0])
    Folders(spark, base).delete(f"{base}/run={H._run_name(days[1])}/_SUCCESS")  # as if unfinished
    with pytest.raises(ValueError, match="last finished run"):
        H.record_run(H.SNAP_SELLERS, base, two, days[2], days[1])
    H.record_run(H.SNAP_SELLERS, base, two, days[1], days[0])
    H.record_run(H.SNAP_SELLERS, base, two, days[2], days[1])
    versions = rows_of(H.read_history(spark, base, days[2]), "seller_id")
    assert [(v["seller_id"], v["dbt_valid_from"], v["dbt_valid_to"]) for v in versions] == [
        ("a", days[0], None), ("b", days[0], days[1])]


def test_null_keys_are_refused_in_both_forms(spark, frame):
    run = frame(SELLERS, ("a", "x", "s"), (None, "y", "s"))
    with pytest.raises(H.DuplicateKey):
        H.record_run(H.SNAP_SELLERS, scratch_path(spark, "nulls"), run, datetime(2024, 1, 1))
    with pytest.raises(PySparkException, match="NULL seller_id"):
        H.snapshot_rebuild(H.SNAP_SELLERS, run.withColumn("run_ts", F.lit(datetime(2024, 1, 1))),
                           "run_ts").collect()


@pytest.mark.parametrize("amounts, total", [
    ([0.005] * 1000, 5.0), ([0.1] * 10, 1.0), ([1e15, 0.01, -1e15], 0.01), ([None, 2.5], 2.5), ([None], None),
    ([float("inf"), 1.0], float("inf")), ([1e300, 1e300], 2e300), ([-3.333, 3.333], 0.0),
])
def test_money_sums(spark, amounts, total):
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    row = df.repartition(3).agg(money_sum(F.col("amount")).alias("s"), money_avg(F.col("amount")).alias("a")).first()
    assert row.s == total
    given = [a for a in amounts if a is not None]
    assert row.a == (pytest.approx(total / len(given)) if given else None)


def test_nan_is_not_hidden(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "amount double")
    assert df.agg(money_sum(F.col("amount")).alias("s")).first().s != 0
    assert str(df.agg(money_sum(F.col("amount")).alias("s")).first().s) == "nan"


def test_a_missing_statement_may_not_run(spark, frame):
    rows = rows_of(guards.sql_guard(frame("id int, sql string", (1, None), (2, "SELECT 1")), "sql"), "id")
    assert [(r["is_valid"], r["reason"]) for r in rows] == [(False, "No statement"), (True, "")]
    answers = guards.answer_verdicts(frame("q string, raw string", ("why", None)), "q", "raw").first()
    assert answers.error


def test_dates_that_are_no_dates_are_refused(spark):
    from cartwheel import schemas
    with pytest.raises(ValueError):
        files.read_drops(spark, "/nowhere", "sellers", ["yesterday"], schemas.SELLERS)


def test_a_scope_deletes_what_it_kept(spark):
    outside = keep(spark.range(3), "outside")
    with scratch_scope(spark):
        inside = scratch_path(spark, "inside")
        assert keep(spark.range(4), "inside").count() == 4
    root = inside.rpartition("/")[0]
    assert not Folders(spark, shared_folder(spark)).exists(root)
    assert outside.count() == 3
