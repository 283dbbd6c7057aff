from datetime import date, timedelta

import pytest

from cartwheel.operators import quality as Q
from cartwheel.workload import inputs, queries
from conftest import by_key, rows_of, ts

HISTORY = "k string, dbt_scd_id string, dbt_valid_from timestamp, dbt_valid_to timestamp"


def test_generic_checks(frame):
    df = frame("id string, kind string", ("a", "x"), ("a", None), ("b", "y"), (None, "y"),
               (None, "x"))
    assert Q.not_null(df, "id").count() == 2
    assert rows_of(Q.unique(df, "id")) == [{"id": "a", "n_records": 2}]
    assert rows_of(Q.accepted_values(df, "kind", ["x"])) == [{"kind": "y", "n_records": 2}]
    parents = frame("pid string", ("b",))
    assert rows_of(Q.relationships(df, "id", parents, "pid")) == [{"value": "a", "n_records": 2}]


def test_model_checks(frame):
    sales = frame("order_id string, purchased_at timestamp, delivered_to_customer_at timestamp, "
                  "total_payment_brl double",
                  ("ok", ts("2024-01-02"), ts("2024-01-02"), 0.0),
                  ("early", ts("2024-01-02"), ts("2024-01-01"), 1.0),
                  ("open", ts("2024-01-02"), None, -0.01))
    assert rows_of(Q.delivery_before_purchase(sales)) == [{"order_id": "early"}]
    assert rows_of(Q.negative_revenue(sales)) == [{"order_id": "open"}]
    cohorts = frame("cohort_month date, months_since_first_order int, retention_rate_pct double",
                    *[(date(2024, 1, 1), i, v) for i, v in enumerate([0.0, 100.0, 100.01, -0.1])])
    assert [r.months_since_first_order for r in Q.retention_out_of_range(cohorts).collect()] == [
        2, 3]


def at(day):
    return None if day is None else ts("2024-01-01") + timedelta(days=day)


@pytest.mark.parametrize("spans, clash", [
    ([(0, 1), (1, 2), (2, None)], False),      # touching
    ([(0, 2), (1, 3)], True),                  # overlapping
    ([(0, None), (5, None)], True),            # two open
    ([(0, 9), (1, 2), (3, 4)], True),          # inside a longer one
    ([(0, 3), (0, 3)], True),                  # same start
    ([(0, 0), (0, 3)], False),                 # an empty one at the start
    ([(2, 2), (0, 3)], True),                  # an empty one inside
    ([(0, 1), (4, 5)], False),                 # a gap
])
def test_overlaps_as_a_pairwise_comparison_finds_them(frame, spans, clash):
    end = Q.OPEN_END
    pairs = [(at(a), at(b) or end) for a, b in spans]
    pairwise = any(x[0] < y[1] and x[1] > y[0]
                   for i, x in enumerate(pairs) for j, y in enumerate(pairs) if i != j)
    assert pairwise == clash
    history = frame(HISTORY, *[("k", str(i), at(a), at(b)) for i, (a, b) in enumerate(spans)],
                    ("other", "z", at(0), None))
    assert [r.k for r in Q.overlapping_periods(history, "k").collect()] == (["k"] if clash else [])


def test_equal_ids_are_left_to_the_uniqueness_check(frame):
    history = frame(HISTORY, ("k", "same", at(0), None), ("k", "same", at(0), None))
    assert Q.overlapping_periods(history, "k").count() == 0
    assert rows_of(Q.duplicate_versions(history, "k").select("n_records")) == [{"n_records": 2}]


def sales_with(frame, counts, start=date(2024, 1, 1)):
    days = [start + timedelta(days=i) for i, n in enumerate(counts) for _ in range(n)]
    return frame("order_date date", *[(d,) for d in days])


@pytest.mark.parametrize("today, low", [(6, True), (7, False)])
def test_volume_drop(frame, today, low):
    sales = sales_with(frame, [10] * 7 + [today])
    day = date(2024, 1, 8)
    assert (Q.volume_anomalies(sales, as_of=day).count() == 1) == low


def test_volume_of_a_day_without_orders(frame, spark):
    from cartwheel.plans.calendar import dim_date
    sales = sales_with(frame, [10] * 7 + [0, 10])
    day = date(2024, 1, 8)
    assert Q.volume_anomalies(sales, as_of=day).count() == 0
    calendar = dim_date(spark, date(2024, 1, 1), date(2024, 1, 9), end_inclusive=True)
    assert [r.order_date for r in Q.volume_anomalies(sales, calendar=calendar).collect()] == [day]


def test_volume_needs_no_seven_days(frame):
    assert [r.order_date for r in Q.volume_anomalies(sales_with(frame, [10, 6])).collect()] == [
        date(2024, 1, 2)]


def test_declared_suites_have_the_known_size():
    def size(suite):
        return sum(r.not_null + r.unique + bool(r.accepted) for r in suite.columns)
    assert size(Q.SOURCE_SUITE) == 20 and size(Q.MART_SUITE) == 38


def test_suite_reports_failures_and_gates(frame):
    suite = Q.Suite(
        (Q.ColumnRules("t", "id", unique=True), Q.ColumnRules("t", "kind", accepted=("x",)),
         Q.ColumnRules("absent", "id")),
        (Q.ModelCheck("not_y", "t", lambda tables: tables["t"].where("kind = 'y'")),))
    bad = frame("id string, kind string", ("a", "x"), ("a", "y"), (None, "y"))
    report = by_key(Q.run_suite(suite, {"t": bad}), "check")
    assert {k: v["failures"] for k, v in report.items()} == {
        "not_null_id": 1, "not_null_kind": 0, "unique_id": 1, "accepted_values_kind": 1, "not_y": 2}
    assert report["not_null_kind"]["status"] == "pass" and report["not_y"]["status"] == "fail"
    with pytest.raises(Q.ChecksFailed, match="t.unique_id") as failure:
        Q.gate(suite, {"t": bad})
    assert failure.value.report.count() == 5
    good = frame("id string, kind string", ("a", "x"))
    assert Q.gate(suite, {"t": good}).where("status = 'pass'").count() == 5


def test_column_checks_read_a_table_once(spark, frame):
    """Whatever rules there are, and each as its own operator counts it."""
    from cartwheel.session import keep
    schema = "a string, b long, c date, d double"
    rows = [("x", 1, date(2024, 1, 1), 1.5), ("x", 1, None, None), (None, 2, date(2024, 1, 2), 1.5), ("y", None, date(2024, 1, 2), -0.0),
            ("z", 1, date(2024, 1, 3), 0.0), (None, 7, None, 9.0)] * 3 + [("once", 99, date(2020, 1, 1), 4.0)]
    df = keep(frame(schema, *rows), "checked")
    suite = Q.Suite((
        Q.ColumnRules("t", "a", unique=True, accepted=("x", "y")), Q.ColumnRules("t", "b", unique=True),
        Q.ColumnRules("t", "c", unique=True, not_null=False), Q.ColumnRules("t", "d", unique=True, accepted=(1.5, 4.0)),
        Q.ColumnRules("elsewhere", "a")))
    report = Q.run_suite(suite, {"t": df})
    got = {r.check: r.failures for r in report.collect()}
    expected = {f"unique_{c}": Q.unique(df, c).count() for c in "abcd"}
    expected |= {f"not_null_{c}": Q.not_null(df, c).count() for c in "abd"}
    expected |= {"accepted_values_a": Q.accepted_values(df, "a", ["x", "y"]).count(),
                 "accepted_values_d": Q.accepted_values(df, "d", [1.5, 4.0]).count()}
    assert got == expected and got["unique_b"] == 3 and got["not_null_a"] == 6
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert Q.run_suite(suite, {"t": df.limit(0)}).where("failures > 0").count() == 0

    for rules, exchanges in (((Q.ColumnRules("t", "a"), Q.ColumnRules("t", "d")), 1),
                             ((Q.ColumnRules("t", "a", unique=True), Q.ColumnRules("t", "b"), Q.ColumnRules("t", "c")), 2)):
        few = Q.run_suite(Q.Suite(rules), {"t": df})
        got = {r.check: r.failures for r in few.collect()}
        assert got == {check: n for check, n in (expected | {"not_null_c": Q.not_null(df, "c").count()}).items() if check in got}
        assert len(got) == len(rules) + sum(r.unique for r in rules)
        assert few._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
        assert few._jdf.queryExecution().sparkPlan().toString().count("Generate") <= exchanges
        assert Q.run_suite(Q.Suite(rules), {"t": df.limit(0)}).where("failures > 0 OR failures IS NULL").count() == 0


def test_the_mart_suite_enriches_orders_once(spark, monkeypatch):
    calls = []
    whole = inputs.orders.orders_enriched
    monkeypatch.setattr(inputs.orders, "orders_enriched", lambda *of: calls.append(1) or whole(*of))
    report = queries.QUERIES["q10_mart_suite"](spark, "/root/testdata/sf0.001")
    assert report.select("table").distinct().count() == 8
    assert len(calls) == 1
