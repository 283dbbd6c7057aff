import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators.ranking import Ntile, _end_positions, global_ntile


def expected(df, spec):
    key = F.col(spec.order)
    order = [key.desc_nulls_last() if spec.descending else key.asc_nulls_first(), F.col("id")]
    return df.withColumn("want", F.ntile(spec.buckets).over(Window.orderBy(*order)))


@pytest.mark.parametrize("rows", [0, 1, 3, 5, 7, 103])
@pytest.mark.parametrize("descending", [False, True])
def test_equals_ntile_with_ties_and_nulls(spark, rows, descending):
    df = spark.range(rows).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 6 != 0, F.col("id") % 4).alias("k"))
    spec = Ntile("got", "k", 4, descending)
    both = expected(global_ntile(df, "id", spec), spec)
    assert both.where("got <> want").count() == 0
    assert both.count() == rows


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.one_of(st.none(), st.floats(-3, 3, width=16)), max_size=30),
       buckets=st.integers(1, 9), descending=st.booleans())
def test_equals_ntile_for_any_values(spark, keys, buckets, descending):
    df = spark.createDataFrame(list(enumerate(keys)), "id int, k double")
    spec = Ntile("got", "k", buckets, descending)
    assert expected(global_ntile(df, "id", spec), spec).where("got <> want").count() == 0


@given(st.integers(0, 200), st.integers(1, 12))
def test_bucket_ends_follow_the_rule(total, buckets):
    base, larger = divmod(total, buckets)
    sizes = [base + (k < larger) for k in range(buckets)]
    ends = [sum(sizes[:k + 1]) for k in range(buckets - 1)]
    assert _end_positions(total, buckets) == [e for e in ends if 0 < e < total]


def test_no_single_partition_sort(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    plan = global_ntile(df, "id", Ntile("b", "k"))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_several_specs_share_one_sort(spark):
    df = spark.range(103).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 5).alias("a"),
        (F.col("id") * 0.5).alias("b"), F.when(F.col("id") > 50, F.to_date(F.lit("2024-01-01")))
        .alias("c"))
    specs = [Ntile("x", "a", 4), Ntile("y", "b", 7, True), Ntile("z", "c", 3, True)]
    scored = global_ntile(df, "id", *specs)
    for spec in specs:
        assert expected(scored, spec).where(F.col(spec.name) != F.col("want")).count() == 0
