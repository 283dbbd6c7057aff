"""Pairs of overlapping periods against comparing all of them."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.operators import intervals
from cartwheel.operators import quality as Q
from cartwheel.operators import ranking

HISTORY = "k string, dbt_scd_id string, dbt_valid_from timestamp, dbt_valid_to timestamp"


def at(n):
    return None if n is None else datetime(2024, 1, 1) + timedelta(hours=n)


def brute(rows):
    found = Counter()
    for i, (k, a, s, e) in enumerate(rows):
        for k2, b, s2, e2 in rows[:i]:
            if k is None or k != k2 or a == b or s is None or s2 is None:
                continue
            end, end2 = e or Q.OPEN_END, e2 or Q.OPEN_END
            if s < end2 and s2 < end:
                found[k, min(a, b), max(a, b), max(s, s2), min(end, end2)] += 1
    return found


def pairs(frame, rows, **kw):
    return Counter(map(tuple, intervals.overlapping_pairs(frame(HISTORY, *rows), "k", **kw).collect()))


times = st.one_of(st.none(), st.integers(0, 12))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from("uvwxyz"), times, times), max_size=25), st.sampled_from([1, 3, 1024]))
def test_pairs_of_any_periods(spark, rows, bucket):
    rows = [(k, i, at(s), at(e)) for k, i, s, e in rows]
    frame = lambda schema, *data: spark.createDataFrame(list(data), schema)
    assert pairs(frame, rows, bucket=bucket) == brute(rows)


def test_pairs_agree_with_the_keys_of_the_check(frame):
    rows = [(f"k{n % 7}", f"v{n}", at(n), at(n + 1 + n % 5)) for n in range(60)] + [("lone", "x", at(0), None)]
    found = pairs(frame, rows, bucket=4)
    assert found == brute(rows)
    keys = {r.k for r in Q.overlapping_periods(frame(HISTORY, *rows), "k").collect()}
    assert {k for k, *_ in found} == keys


def test_a_hot_key_is_split(spark, monkeypatch):
    """200,000 versions of one key, of which some overlap, in buckets of bounded size."""
    n = 200_000
    history = spark.range(n, numPartitions=8).selectExpr(
        "'hot' AS k", "CAST(id AS STRING) AS dbt_scd_id", "timestamp_seconds(id * 10) AS dbt_valid_from",
        "timestamp_seconds(id * 10 + IF(id % 1000 = 0, 25, 10)) AS dbt_valid_to")
    seen = {}

    def keep(df, label, f=intervals.keep):
        seen[label] = f(df, label)
        return seen[label]

    monkeypatch.setattr(intervals, "keep", keep)
    monkeypatch.setattr(ranking, "keep", keep)
    found = intervals.overlapping_pairs(history, "k", bucket=512)
    assert found.count() == 2 * n // 1000
    swept = seen["swept-periods"]
    rows = swept.selectExpr("explode(sequence(opens div 512, (closes - 1) div 512)) AS bucket").groupBy("bucket").count()
    assert rows.count() > 700 and rows.agg({"count": "max"}).first()[0] <= 600
    assert seen["ordered-rows"].select("_task").distinct().count() > 1


def test_one_open_version_and_many_others(frame):
    rows = [("k", "open", at(0), None)] + [("k", f"v{n}", at(n), at(n + 1)) for n in range(1, 300)]
    assert pairs(frame, rows, bucket=16) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, "a", at(0), None), (None, "b", at(0), None)]])
def test_nothing_to_compare(frame, rows):
    assert pairs(frame, rows) == Counter()
