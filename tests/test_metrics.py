from datetime import date

import pytest
from pyspark.sql import functions as F

from cartwheel.plans import metrics as M
from conftest import by_key

SALES = ("order_id string, customer_state string, order_date date, total_payment_brl double, "
         "actual_delivery_days int, is_on_time boolean")


@pytest.fixture
def sales(frame):
    return frame(SALES, ("a", "X", date(2024, 1, 5), 10.1, 2, True),
                 ("b", "X", date(2024, 1, 9), 20.2, 5, False),
                 ("c", "Y", date(2024, 2, 1), 5.0, None, None))


def test_simple_and_ratio_metrics_in_one_pass(sales):
    got = by_key(M.evaluate(sales, "gross_revenue_brl", "order_count", "avg_order_value_brl",
                            "avg_delivery_days", "on_time_delivery_rate", by=["customer_state"]),
                 "customer_state")
    assert got["X"] == {"customer_state": "X", "gross_revenue_brl": 30.3, "order_count": 2,
                        "avg_order_value_brl": 15.15, "avg_delivery_days": 3.5,
                        "on_time_delivery_rate": 50.0}
    assert got["Y"]["on_time_delivery_rate"] is None and got["Y"]["avg_delivery_days"] is None


def test_filter_and_total(sales):
    assert M.evaluate(sales, "order_count", where=F.col("is_on_time")).first().order_count == 1
    months = by_key(M.revenue_by_month(sales), "order_month")
    assert months[date(2024, 1, 1)]["gross_revenue_brl"] == 30.3


def test_retention_and_ltv(frame):
    cohorts = frame("cohort_size bigint, retained_customers bigint", (10, 10), (10, 1), (3, 1))
    got = M.evaluate(cohorts, "monthly_retention_rate").first().monthly_retention_rate
    assert got == 1200 / 23
    people = frame("ltv_brl double", (10.0,), (20.0,))
    assert M.evaluate(people, "customer_ltv_brl").first().customer_ltv_brl == 15.0


def test_metrics_of_two_marts_are_refused(sales):
    with pytest.raises(ValueError, match="several models"):
        M.evaluate(sales, "order_count", "customer_ltv_brl")
