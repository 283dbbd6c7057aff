"""Rows that are left out before a join."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from cartwheel.operators import bloom


def test_no_key_is_lost_and_most_others_go(spark):
    keys = spark.range(0, 30_000, 3).select(F.col("id").cast("string").alias("k"))
    words = bloom.words_for(10_000)
    bits = bloom.key_filter(keys, "k", words)
    assert bits.count() <= words == 2048
    rows = spark.range(30_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("r"), F.lit("x").alias("word"))
    passed = bloom.may_match(rows, "k", bits, words)
    assert passed.columns == rows.columns
    counts = {r.r: r["count"] for r in passed.groupBy("r").count().collect()}
    assert counts[0] == 10_000 and counts.get(1, 0) + counts.get(2, 0) < 0.05 * 20_000
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("keys, words", [(0, 1), (1, 1), (5, 1), (6, 1), (1000, 256), (10**12, bloom.MOST_WORDS)])
def test_size_of_a_filter(keys, words):
    assert bloom.words_for(keys) == words


def test_nulls_and_nothing(spark, frame):
    rows = frame("k string, v int", ("a", 1), (None, 2), ("b", 3))
    bits = bloom.key_filter(frame("k string", ("a",), (None,)), "k", 4)
    assert {r["v"] for r in rows_of(bloom.may_match(rows, "k", bits, 4))} <= {1, 3}
    assert bloom.may_match(rows, "k", bloom.key_filter(rows.limit(0), "k", 1), 1).count() == 0
