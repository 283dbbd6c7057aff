from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartwheel.operators import history as H
from cartwheel.operators import quality as Q
from cartwheel.session import keep, scratch_path
from conftest import rows_of, ts

DROP = "k string, v double, s string, note string"
SEEN = DROP + ", run_ts timestamp"
CHECK = ["v", "s"]
COLUMNS = ["k", "v", "s", "note"]


def apply(history, current, run, **kw):
    base = H.empty_history(current) if history is None else history
    return H.scd2_apply(base, current, "k", CHECK, ts(run), **kw)


def periods(df):
    return sorted((r.k, r.v, r.s, r.note, str(r.dbt_valid_from.date()),
                   r.dbt_valid_to and str(r.dbt_valid_to.date())) for r in df.collect())


def test_new_changed_unchanged_deleted_and_back(frame):
    h = apply(None, frame(DROP, ("new", 1.0, "a", "n1"), ("chg", 1.0, "a", "n1"),
                          ("same", None, "a", "n1"), ("del", 1.0, "a", "n1")), "2024-01-01")
    h = apply(h, frame(DROP, ("new", 1.0, "a", "n2"), ("chg", None, "a", "n2"),
                       ("same", None, "a", "n2")), "2024-01-02")
    h = apply(h, frame(DROP, ("new", 1.0, "a", "n3"), ("chg", None, "a", "n3"),
                       ("same", None, "b", "n3"), ("del", 1.0, "a", "n3")), "2024-01-03")
    assert periods(h.where("k = 'new'")) == [("new", 1.0, "a", "n1", "2024-01-01", None)]
    assert rows_of(h.where("k = 'chg'").select("v", "note"), "note") == [
        {"v": 1.0, "note": "n1"}, {"v": None, "note": "n2"}]
    assert [r.dbt_valid_to for r in h.where("k = 'same'").orderBy("dbt_valid_from").collect()] == [
        ts("2024-01-03"), None]
    assert periods(h.where("k = 'del'")) == [
        ("del", 1.0, "a", "n1", "2024-01-01", "2024-01-02"),
        ("del", 1.0, "a", "n3", "2024-01-03", None)]
    assert h.select("dbt_scd_id").distinct().count() == h.count() == 7


def test_deletes_can_be_left_open(frame):
    h = apply(None, frame(DROP, ("a", 1.0, "s", "n")), "2024-01-01")
    h = apply(h, frame(DROP, ("b", 1.0, "s", "n")), "2024-01-02", invalidate_hard_deletes=False)
    assert h.where("dbt_valid_to is not null").count() == 0


@pytest.mark.parametrize("rows", [[("a", 1.0, "s", "n"), ("a", 2.0, "s", "n")],
                                  [(None, 1.0, "s", "n")]])
def test_duplicate_or_null_keys_are_refused(frame, rows):
    with pytest.raises(H.DuplicateKey):
        apply(None, frame(DROP, *rows), "2024-01-01")


def test_rebuild_refuses_duplicates(frame):
    seen = frame(SEEN, ("a", 1.0, "s", "n", ts("2024-01-01")), ("a", 2.0, "s", "n",
                                                               ts("2024-01-01")))
    with pytest.raises(Exception, match="duplicate k in one run: a"):
        H.scd2_rebuild(seen, "k", "run_ts", CHECK, COLUMNS).collect()


OBSERVATION = st.tuples(st.sampled_from("ab"), st.integers(0, 5),
                        st.sampled_from([None, 1.0, 2.0]), st.sampled_from(["x", "y"]))


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(OBSERVATION, min_size=1, max_size=12, unique_by=lambda o: (o[0], o[1])))
def test_rebuild_equals_applying_each_run(spark, observations):
    """Runs without any row never happened for either: an empty batch is not loaded."""
    start = datetime(2024, 1, 1)
    seen = spark.createDataFrame(
        [(k, v, s, f"note{r}", start + timedelta(days=r)) for k, r, v, s in observations], SEEN)
    folded = None
    for run in sorted({r for _, r, _, _ in observations}):
        now = start + timedelta(days=run)
        current = seen.where(seen.run_ts == now).drop("run_ts")
        base = H.empty_history(current) if folded is None else folded
        folded = keep(H.scd2_apply(base, current, "k", CHECK, now), "folded")
    rebuilt = keep(H.scd2_rebuild(seen, "k", "run_ts", CHECK, COLUMNS), "rebuilt")
    assert rows_of(rebuilt, "k", "dbt_valid_from") == rows_of(folded, "k", "dbt_valid_from")
    assert Q.overlapping_periods(rebuilt, "k").count() == 0
    assert Q.duplicate_versions(rebuilt, "k").count() == 0


def test_as_of_includes_the_start_only(frame):
    h = apply(None, frame(DROP, ("a", 1.0, "s", "n")), "2024-01-01")
    h = apply(h, frame(DROP, ("a", 2.0, "s", "n")), "2024-01-03")
    at = lambda t: [r.v for r in H.scd2_as_of(h, ts(t)).collect()]
    assert at("2023-12-31") == [] and at("2024-01-01") == [1.0]
    assert at("2024-01-02T23:59:59") == [1.0] and at("2024-01-03") == [2.0]
    assert [r.v for r in H.scd2_current(h).collect()] == [2.0]


SPEC = H.Snapshot("snap", "k", tuple(CHECK), tuple(COLUMNS))


def test_stored_history_reads_open_and_writes_no_closed_version_again(spark, frame):
    base = scratch_path(spark, "history")
    drops = [[("a", 1.0, "s", "n"), ("b", 1.0, "s", "n")], [("a", 2.0, "s", "n")],
             [("a", 3.0, "s", "n"), ("b", 1.0, "s", "n")], [("a", 3.0, "s", "n")]]
    folded, previous = None, None
    for i, rows in enumerate(drops):
        run = datetime(2024, 1, 1 + i)
        current = frame(DROP, *rows)
        H.record_run(SPEC, base, current, run, previous)
        folded = apply(folded, current, run.isoformat())
        previous = run
        assert rows_of(H.read_history(spark, base, run), "k", "dbt_valid_from") == \
            rows_of(folded, "k", "dbt_valid_from")
    stored = spark.read.parquet(base).groupBy("run", "is_open").count()
    assert {(r["run"][:9], r["is_open"]): r["count"] for r in stored.collect()} == {
        ("r20240101", 1): 2, ("r20240102", 1): 1, ("r20240102", 0): 2, ("r20240103", 1): 2,
        ("r20240103", 0): 1, ("r20240104", 1): 1, ("r20240104", 0): 1}
    plan = H.read_history(spark, base, previous)._jdf.queryExecution().executedPlan().toString()
    assert "(is_open" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_run_can_be_recorded_again(spark, frame):
    base = scratch_path(spark, "history")
    first, second = datetime(2024, 1, 1), datetime(2024, 1, 2)
    H.record_run(SPEC, base, frame(DROP, ("a", 1.0, "s", "n")), first)
    for _ in range(2):
        H.record_run(SPEC, base, frame(DROP, ("a", 2.0, "s", "n")), second, first)
        assert H.read_history(spark, base, second).count() == 2
    assert H.read_history(spark, base, first).count() == 1  # as it was then
    with pytest.raises(ValueError, match="does not follow"):
        H.record_run(SPEC, base, frame(DROP, ("a", 2.0, "s", "n")), first, second)


def test_snapshot_specs_choose_columns(frame):
    current = frame("seller_id string, zip_code string, city string, state string",
                    ("s1", "1", "X", "Y"))
    h = H.snapshot_apply(H.SNAP_SELLERS, None, current, ts("2024-01-01"))
    assert h.columns == ["seller_id", "city", "state", *H.META]


def test_merged_runs_read_like_single_ones(spark, frame, monkeypatch):
    """Every state of 23 runs, with folders of 3 and 9 runs; few folders are opened."""
    import random
    from datetime import timedelta

    from cartwheel.session import scratch_path
    from cartwheel.sources.replace import Folders
    r, base, days = random.Random(2), scratch_path(spark, "runs"), [datetime(2024, 1, 1) + timedelta(days=n) for n in range(23)]
    for n, day in enumerate(days):
        rows = [(f"s{k}", r.choice("ab"), "x") for k in range(6) if r.random() < 0.8]
        H.record_run(H.SNAP_SELLERS, base, frame("seller_id string, city string, state string", *rows), day, days[n - 1] if n else None)
        if n in (10, 21):
            H.compact_runs(spark, base, fan=3)
    order = ("seller_id", "dbt_valid_from", "dbt_valid_to")
    folders = H._merged_folders(Folders(spark, base), base)
    assert sorted(m.level for m in folders) == [1, 2, 2]
    got = {day: rows_of(H.read_history(spark, base, day), *order) for day in days}
    opened = {f.split("/part-")[0] for f in H.read_history(spark, base, days[-1]).inputFiles()}
    assert len(opened) <= 3 + 3 * 2
    monkeypatch.setattr(H, "_merged_folders", lambda files, base: [])
    assert got == {day: rows_of(H.read_history(spark, base, day), *order) for day in days}
    monkeypatch.undo()
    assert H.compact_runs(spark, base, fan=3) == []
    # A run that is recorded anew is not read from what was merged before.
    H.record_run(H.SNAP_SELLERS, base, frame("seller_id string, city string, state string", ("new", "a", "x")), days[4], days[3])
    assert not any(m.first <= H._run_name(days[4]) <= m.last for m in H._merged_folders(Folders(spark, base), base))
    assert {"new"} == {v["seller_id"] for v in rows_of(H.read_history(spark, base, days[4]), *order) if v["dbt_valid_to"] is None}
