from datetime import date, timedelta

import pytest

from cartwheel.plans import calendar as K
from cartwheel.session import keep
from conftest import by_key


@pytest.fixture(scope="module")
def days(spark):
    return by_key(keep(K.dim_date(spark), "calendar"), "date_day")


def test_range_leaves_out_the_last_day(days, spark):
    assert len(days) == 5478 and max(days) == date(2030, 12, 30) and min(days) == date(2016, 1, 1)
    assert K.dim_date(spark, end_inclusive=True).count() == 5479


def test_every_day_against_the_standard_library(days):
    for day, row in days.items():
        assert row["week_of_year"] == int(day.strftime("%U"))
        assert row["day_of_week"] == day.isoweekday() % 7 + 1
        assert row["day_of_year"] == day.timetuple().tm_yday
        assert (row["month_name"], row["month_name_short"]) == (
            day.strftime("%B"), day.strftime("%b"))
        assert (row["day_name"], row["day_name_short"]) == (day.strftime("%A"), day.strftime("%a"))
        assert row["quarter_label"] == f"Q{(day.month + 2) // 3} {day.year}"
        assert row["month_label"] == day.strftime("%b %Y")
        assert row["is_weekend"] == (day.isoweekday() >= 6)
        assert row["is_first_day_of_month"] == (day.day == 1)
        assert row["is_last_day_of_month"] == ((day + timedelta(days=1)).day == 1)


def test_weeks_start_on_sunday(days):
    assert days[date(2016, 1, 1)]["week_of_year"] == 0
    assert days[date(2016, 1, 3)]["week_of_year"] == 1
    assert days[date(2016, 2, 29)]["is_last_day_of_month"]


def test_holidays(days):
    br = {(d.month, d.day) for d, r in days.items() if r["is_holiday_br"]}
    ar = {(d.month, d.day) for d, r in days.items() if r["is_holiday_ar"]}
    assert br == set(K.HOLIDAYS_BR) and len(br) == 8
    assert ar == set(K.HOLIDAYS_AR) and len(ar) == 9
    assert not days[date(2018, 9, 7)]["is_business_day_br"]   # a Friday
    assert days[date(2018, 7, 9)]["is_business_day_br"]       # a holiday elsewhere
    assert days[date(2016, 12, 25)]["is_weekend"] and days[date(2016, 12, 25)]["is_holiday_br"]


def test_sales_by_calendar(frame, spark):
    sales = frame("order_id string, order_date date, total_payment_brl double",
                  ("a", date(2024, 3, 1), 1.1), ("b", date(2024, 3, 2), 2.2),
                  ("c", date(2024, 3, 2), 3.3), ("d", date(2031, 1, 1), 9.9))
    got = by_key(K.sales_by_calendar(sales, K.dim_date(spark), "is_weekend"), "is_weekend")
    assert got[True]["order_count"] == 2 and got[True]["revenue_brl"] == 5.5
    assert got[False]["revenue_brl"] == 1.1
