from datetime import date

import pytest

from cartwheel.operators import incremental as I
from cartwheel.session import scratch_path
from conftest import rows_of

SCHEMA = ("order_id string, order_date date, primary_category string, customer_state string, "
          "total double")


def day(text):
    return date.fromisoformat(text)


@pytest.fixture
def fact(frame):
    days = ["2024-01-10", "2024-01-31", "2024-02-01", "2024-02-14", "2024-02-28", "2024-03-05"]
    return frame(SCHEMA, *[(f"o{i}", day(d), "k", "s", float(i)) for i, d in enumerate(days)])


def builder(df):
    def build(start=None, end=None):
        rows = df if start is None else df.where(df.order_date >= start)
        return rows if end is None else rows.where(df.order_date <= end)
    return build


def stored(spark, path):
    return rows_of(spark.read.parquet(path).select(*[f.split()[0] for f in SCHEMA.split(", ")]),
                   "order_id")


def test_refresh_completes_a_month_and_does_not_double(spark, fact):
    path = scratch_path(spark, "fact")
    I.write_partitioned(fact.where("order_date <= '2024-02-14'"), path)
    I.incremental_refresh(spark, builder(fact), path)
    assert stored(spark, path) == rows_of(fact, "order_id")
    I.incremental_refresh(spark, builder(fact), path)
    assert stored(spark, path) == rows_of(fact, "order_id")


@pytest.mark.parametrize("target", ["absent", "no files", "no rows"])
def test_refresh_of_an_empty_target_builds_everything(spark, fact, target):
    path = scratch_path(spark, "fact")
    if target == "no files":
        I.write_partitioned(fact.limit(0), path)
    if target == "no rows":
        fact.limit(0).selectExpr("*", "order_date AS order_month").write.parquet(path)
    I.incremental_refresh(spark, builder(fact), path)
    assert stored(spark, path) == rows_of(fact, "order_id")


def test_backfill_changes_whole_months_and_nothing_else(spark, fact):
    path = scratch_path(spark, "fact")
    I.write_partitioned(fact, path)
    from pyspark.sql import functions as F
    fixed = fact.withColumn("total", F.col("total") + 100)
    for _ in range(2):
        I.backfill(builder(fixed), path, day("2024-02-10"), day("2024-02-20"))
        got = {r["order_id"]: r["total"] for r in stored(spark, path)}
        assert got == {"o0": 0.0, "o1": 1.0, "o2": 102.0, "o3": 103.0, "o4": 104.0, "o5": 5.0}


def test_range_read_prunes_months(spark, fact):
    path = scratch_path(spark, "fact")
    I.write_partitioned(fact, path)
    rows = I.read_range(spark, path, day("2024-01-31"), day("2024-02-14"))
    assert sorted(r.order_id for r in rows.collect()) == ["o1", "o2", "o3"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "order_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("start, end, bounds", [
    ("2024-02-10", "2024-02-20", ("2024-02-01", "2024-02-29")),
    ("2023-12-31", "2024-01-01", ("2023-12-01", "2024-01-31")),
    ("2023-11-05", "2023-12-05", ("2023-11-01", "2023-12-31")),
])
def test_month_bounds(start, end, bounds):
    assert I.month_bounds(day(start), day(end)) == tuple(map(day, bounds))


def test_reversed_range_is_refused():
    with pytest.raises(ValueError):
        I.month_bounds(day("2024-02-01"), day("2024-01-01"))


def test_a_large_month_is_written_by_several_tasks(spark):
    """And every file is sorted by the clustering columns."""
    import glob

    import pyarrow.parquet as pq
    path = scratch_path(spark, "fact")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64KB")
    try:
        rows = spark.range(0, 60000, numPartitions=8).selectExpr(
            "uuid() AS order_id", "date'2024-02-03' AS order_date",
            "concat('k', id % 7) AS primary_category", "concat('s', id % 5) AS customer_state",
            "rand() AS total")
        I.write_partitioned(rows, path)
    finally:
        spark.conf.set(size, before)
    files = glob.glob(f"{path}/order_month=2024-02-01/*.parquet")
    assert len(files) > 3
    for file in files:
        table = pq.read_table(file, columns=["primary_category", "customer_state"])
        pairs = list(zip(*table.to_pydict().values()))
        assert pairs == sorted(pairs)
    assert spark.read.parquet(path).count() == 60000
