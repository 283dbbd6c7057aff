"""Months that are clustered across files."""

from datetime import date

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from cartwheel.operators import clustering as K
from cartwheel.operators import incremental as I
from cartwheel.session import scratch_path
from cartwheel.sources.replace import Folders
from cartwheel.sources.versions import ConcurrentWrite


@pytest.fixture
def table(spark):
    """One large month in many files, each with all categories, and a small month."""
    table = I.sales_table(spark, scratch_path(spark, "clustered"))
    rows = spark.range(40_000, numPartitions=6).selectExpr(
        "CAST(id AS STRING) AS order_id", "IF(id < 39990, date'2024-02-03', date'2024-03-01') AS order_date",
        "IF(id % 3 = 0, 'hot', IF(id % 97 = 0, NULL, concat('k', id % 29))) AS primary_category",
        "concat('s', (id * 7) % 13) AS customer_state", "rand(1) AS total")
    monthly = rows.withColumn(I.MONTH_COLUMN, F.trunc("order_date", "month"))
    table.replace(monthly, monthly.repartition(8, F.rand(3)).write.partitionBy(I.MONTH_COLUMN).parquet)
    return table


def size_of(table):
    return sum(sum(Folders(table.spark, table.path).data_files(f"{table.path}/{f}/{p}").values()) for f, p in table.version().parts)


def test_a_filter_opens_a_fraction_of_the_files(spark, table):
    before = rows_of(table.read(), "order_id")
    each = size_of(table) // 24
    assert K.recluster(table, file_bytes=each) == [date(2024, 2, 1), date(2024, 3, 1)]
    assert rows_of(table.read(), "order_id") == before
    every = [f for folder, part in table.version().parts for f in Folders(spark, table.path).data_files(f"{table.path}/{folder}/{part}")]
    assert len(every) > 20
    for values, most in (({"primary_category": "k11"}, 0.35), ({"customer_state": "s4"}, 0.6),
                         ({"primary_category": "k11", "customer_state": "s4"}, 0.25), ({"primary_category": "none"}, 0.3)):
        chosen = K.read_where(table, **values)
        expected = [r for r in before if all(r[c] == v for c, v in values.items())]
        assert rows_of(chosen, "order_id") == expected
        assert len(K.files_for(table, values)) <= most * len(every), values
    sizes = [r["count"] for r in table.read().groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 4 * 40_000 / 24  # the hot category is spread over files


def test_months_without_ranges_are_read_whole(spark, table):
    K.recluster(table, [date(2024, 2, 1)], file_bytes=size_of(table) // 6)
    assert K.read_where(table, primary_category="hot").count() == sum(i % 3 == 0 for i in range(40_000))
    assert K.recluster(table, [date(2030, 1, 1)]) == []


def test_a_month_written_meanwhile_is_not_lost(spark, table, monkeypatch):
    def z_order(rows, columns, f=K.z_order):
        I.write_partitioned(table.read().drop(I.MONTH_COLUMN).where("order_date = date'2024-02-03'").limit(5), table,
                            months=frozenset([date(2024, 2, 1)]))
        return f(rows, columns)

    monkeypatch.setattr(K, "z_order", z_order)
    with pytest.raises(ConcurrentWrite):
        K.recluster(table, [date(2024, 2, 1)])
    assert table.read().where("order_date = date'2024-02-03'").count() == 5
