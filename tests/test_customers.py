from datetime import date, timedelta

import pytest

from cartwheel.plans import customers as C
from conftest import by_key, rows_of

ENRICHED = ("order_id string, customer_unique_id string, order_status string, order_date date, "
            "total_payment_brl double")
SALES = ("order_id string, customer_unique_id string, order_date date, customer_state string, "
         "primary_category string, total_payment_brl double, actual_delivery_days int, "
         "is_on_time boolean, primary_payment_type string")
LIFETIME = ("customer_unique_id string, total_orders bigint, first_order_date date, "
            "last_order_date date, customer_age_days int, ltv_brl double, "
            "avg_order_value_brl double, days_since_last_order int")
REVIEWS = "order_id string, score bigint"
AS_OF = date(2024, 12, 31)


def bought(oid, who, day, paid=10.0, status="delivered"):
    return (oid, who, status, date.fromisoformat(day), paid)


def sale(oid, who, day, paid=10.0, state="S", category="k", days=3, on_time=True, kind="boleto"):
    return (oid, who, date.fromisoformat(day), state, category, paid, days, on_time, kind)


def test_lifetime_joins_accounts_of_a_person(frame):
    got = by_key(C.customers_lifetime(frame(
        ENRICHED, bought("o1", "u1", "2024-01-01", 10.1), bought("o2", "u1", "2024-01-11", 20.2),
        bought("o3", "u1", "2024-02-01", status="shipped"), bought("o4", "u2", "2024-01-01")),
        AS_OF), "customer_unique_id")
    one = got["u1"]
    assert (one["total_orders"], one["customer_age_days"]) == (2, 10)
    assert one["ltv_brl"] == 30.3 and one["avg_order_value_brl"] == 15.15
    assert one["days_since_last_order"] == 355
    assert got["u2"]["customer_age_days"] == 0


@pytest.mark.parametrize("scores, segment", [
    ((4, 3, 3), "champion"), ((3, 3, 3), "loyal"), ((1, 4, 4), "loyal"), ((2, 3, 2), "at_risk"),
    ((1, 2, 4), "hibernating"), ((3, 2, 4), "new"), ((4, 1, 1), "new"), ((3, 3, 2), "lost"),
    ((4, 4, 1), "lost"),
])
def test_segments(spark, scores, segment):
    from pyspark.sql import functions as F
    value = C.rfm_segment(*[F.lit(s) for s in scores])
    assert spark.range(1).select(value.alias("s")).first().s == segment


def test_mart_customers_scores_and_reviews(frame):
    people = [(f"u{i}", i, date(2024, 1, 1), date(2024, 1, 2), 1, 10.0 * i, 886731.09 / 6, 10 - i)
              for i in range(1, 6)]
    enriched = frame(ENRICHED, bought("o1", "u1", "2024-01-01"),
                     bought("o2", "u1", "2024-01-01", status="shipped"))
    reviews = frame(REVIEWS, ("o1", 5), ("o2", 2), ("o2", None))
    got = by_key(C.mart_customers(frame(LIFETIME, *people), enriched, reviews),
                 "customer_unique_id")
    assert [got[f"u{i}"]["f_score"] for i in range(1, 6)] == [1, 1, 2, 3, 4]
    assert got["u5"]["rfm_segment"] == "champion" and got["u5"]["rfm_total"] == 12
    # the review of the order that was not delivered counts, the one without a score does not
    assert got["u1"]["avg_review_score"] == 3.5 and got["u1"]["reviews_count"] == 2
    assert got["u2"]["reviews_count"] is None
    assert got["u1"]["avg_order_value_brl"] == 147788.52


def test_cohorts_offsets_and_first_month(frame):
    rows = C.mart_cohorts(frame(
        ENRICHED, bought("o1", "u1", "2023-01-31"), bought("o2", "u1", "2023-01-02"),
        bought("o3", "u1", "2024-01-01"), bought("o4", "u1", "2024-02-01"),
        bought("o5", "u2", "2023-01-15"), bought("o6", "u3", "2023-01-15"),
        bought("o7", None, "2023-01-15"), bought("o8", "u3", "2023-01-01", status="shipped")))
    got = [r.asDict() for r in rows.collect()]
    assert [(r["months_since_first_order"], r["cohort_size"], r["retained_customers"],
             r["retention_rate_pct"]) for r in got] == [(0, 3, 3, 100.0), (12, 3, 1, 33.33)]
    assert {r["cohort_month"] for r in got} == {date(2023, 1, 1)}


def test_features_of_a_single_order(frame):
    got = by_key(C.mart_customer_features(
        frame(SALES, sale("o1", "u1", "2024-12-01", days=None, on_time=None)),
        frame(REVIEWS), AS_OF), "customer_unique_id")["u1"]
    assert got["orders_per_month"] is None and got["avg_days_between_orders"] is None
    assert got["stddev_order_value_brl"] == 0.0 and got["avg_review_score"] == 0.0
    assert got["avg_delivery_days"] == 0.0 and got["on_time_rate"] == 0.0
    assert got["reviews_count"] == 0 and got["boleto_orders"] == 1


def test_features_combine_orders_and_reviews(frame):
    got = by_key(C.mart_customer_features(
        frame(SALES, sale("o1", "u1", "2024-01-01", 10.0, "A", "k1", 2, True, "voucher"),
              sale("o2", "u1", "2024-03-01", 30.0, "B", "k1", 4, False, "credit_card"),
              sale("o3", "u1", "2024-01-31", 20.0, "A", None, 6, None, "boleto")),
        frame(REVIEWS, ("o1", 5), ("o1", 2), ("o2", None), ("far", 1)), AS_OF),
        "customer_unique_id")["u1"]
    assert (got["total_orders"], got["days_since_first_order"]) == (3, 365)
    assert got["orders_per_month"] == 3 / 60 * 30 and got["avg_days_between_orders"] == 30.0
    assert (got["max_order_value_brl"], got["min_order_value_brl"]) == (30.0, 10.0)
    assert got["stddev_order_value_brl"] == pytest.approx(10.0)
    assert (got["avg_review_score"], got["reviews_count"]) == (3.5, 2)
    assert (got["five_star_reviews"], got["low_score_reviews"]) == (1, 1)
    assert (got["on_time_orders"], got["late_orders"]) == (1, 1)
    assert (got["unique_categories_count"], got["states_ordered_from"]) == (1, 2)
    assert [got[f"{k}_orders"] for k in ("credit_card", "boleto", "voucher")] == [1, 1, 1]


def test_features_of_unknown_persons_have_no_measures(frame):
    got = C.mart_customer_features(
        frame(SALES, sale("o1", None, "2024-12-01")), frame(REVIEWS, ("o1", 5)), AS_OF).first()
    assert got.total_orders == 1 and got.ltv_brl == 10.0
    assert got.max_order_value_brl is None and got.reviews_count == 0 and got.on_time_rate == 0.0


@pytest.mark.parametrize("days, churned, at_risk",
                         [(180, 0, 0), (181, 0, 1), (365, 0, 1), (366, 1, 1)])
def test_churn_edges(frame, days, churned, at_risk):
    day = (AS_OF - timedelta(days=days)).isoformat()
    got = C.mart_customer_features(frame(SALES, sale("o", "u", day)), frame(REVIEWS), AS_OF).first()
    assert (got.days_since_last_order, got.is_churned, got.is_at_risk) == (days, churned, at_risk)


def test_active_customers_include_the_last_day(frame):
    rows = [("a", AS_OF - timedelta(days=365)), ("b", AS_OF - timedelta(days=366))]
    got = C.active_customers(frame("customer_unique_id string, last_order_date date", *rows), AS_OF)
    assert rows_of(got.select("customer_unique_id")) == [{"customer_unique_id": "a"}]
