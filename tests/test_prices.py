from datetime import date

import pytest

from cartwheel.plans import prices as P
from conftest import by_key, rows_of, ts

HISTORY = ("product_id string, category_id string, category_name string, product_name string, "
           "status string, price_ars double, currency string, dbt_valid_from timestamp, "
           "dbt_valid_to timestamp")
AS_OF = date(2024, 1, 31)


def versions(frame, *prices, pid="p", name="N", category="C"):
    days = [ts(f"2024-01-{i + 1:02}") for i in range(len(prices))] + [None]
    return P.mart_price_history(frame(HISTORY, *[
        (pid, "c", category, name, "active", price, "ARS", days[i], days[i + 1])
        for i, price in enumerate(prices)]), AS_OF)


def changes(df):
    return [(r.price_change_direction, r.price_delta_ars, r.price_change_pct)
            for r in df.orderBy("price_version").collect()]


def test_directions(frame):
    assert changes(versions(frame, None, 100.0, 150.0, 120.0, 120.0, None, 50.0)) == [
        ("first_record", None, None), ("first_record", 0.0, 0.0), ("increase", 50.0, 50.0),
        ("decrease", -30.0, -20.0), ("unchanged", 0.0, 0.0), ("unchanged", None, None),
        ("first_record", 0.0, 0.0)]


def test_zero_before_gives_no_percentage(frame):
    assert changes(versions(frame, 0.0, 10.0))[1] == ("increase", 10.0, None)


def test_durations_and_currency_of_versions(frame):
    rows = versions(frame, 1.0, 2.0).orderBy("price_version").collect()
    assert [(r.price_duration_days, r.is_current) for r in rows] == [(1, False), (29, True)]
    assert [(r.valid_from, r.valid_to) for r in rows] == [
        (date(2024, 1, 1), date(2024, 1, 2)), (date(2024, 1, 2), None)]


@pytest.fixture
def market(frame):
    parts = [versions(frame, 100.0, 150.0, 120.0, pid="a1", name="A" * 60),
             versions(frame, 100.0, 110.0, pid="b1", name="B"),
             versions(frame, 10.0, pid="b2", name="B"),
             versions(frame, 7.0, pid="single", name="S"),
             versions(frame, 0.0, 5.0, pid="zero", name="Z", category=None),
             versions(frame, 5.0, pid="nameless", name=None)]
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part)
    return df


def test_ranking_merges_products_of_one_name(market):
    got = [(r.product_name, r.price_versions, r.total_growth_pct)
           for r in P.price_ranking(market).collect()]
    assert got == [("B", 3, 1000.0), ("A" * 60, 3, 50.0), ("Z", 2, None)]
    assert [r.product_name for r in P.top_growth(P.price_ranking(market), 1).collect()] == ["B"]


def test_kpis_count_the_nameless_as_one(market, frame):
    got = P.price_kpis(market, P.price_ranking(market)).first()
    assert (got.products_tracked, got.price_changes, got.max_growth_pct) == (5, 4, 1000.0)
    empty = market.limit(0)
    got = P.price_kpis(empty, P.price_ranking(empty)).first()
    assert (got.products_tracked, got.price_changes, got.max_growth_pct) == (0, 0, 0.0)


def test_gallery_has_peak_and_current_price(market):
    got = by_key(P.price_gallery(market), "product_id")
    assert set(got) == {"a1", "b1", "zero"}
    assert (got["a1"]["peak_price"], got["a1"]["current_price"]) == (150.0, 120.0)
    assert got["a1"]["short_name"] == "A" * 50 + "..." and got["b1"]["short_name"] == "B"
    assert [r.product_id for r in P.price_gallery(market, 1).collect()] == ["a1"]


def test_drops_keep_risers_unless_directional(market):
    every = by_key(P.price_drops(market), "product_id")
    assert set(every) == {"a1", "b1", "zero"} and every["a1"]["drop_pct"] == -33.3
    real = by_key(P.price_drops(market, directional=True), "product_id")
    assert set(real) == {"a1"} and real["a1"]["drop_pct"] == -20.0


def test_volatility_skips_missing_categories_and_growth(market):
    got = P.category_volatility(P.price_ranking(market)).collect()
    assert [(r.category_name, r.products, r.avg_growth, r.max_growth) for r in got] == [
        ("C", 2, 525.0, 1000.0)]


def test_detail_names_history_and_waterfall(market):
    detail = P.product_detail(market, "A" * 60).collect()
    assert [r.label for r in detail] == ["01.01 (v1)", "02.01 (v2)", "03.01 (v3)"]
    ranking = P.price_ranking(market)
    assert P.product_names(market, ranking, True).count() == 5
    assert P.product_names(market, ranking, False).count() == 3
    assert [r.price_version for r in P.product_history(market, "a1").collect()] == [1, 2, 3]
    steps = [(r.label, r.measure, r.value) for r in P.product_waterfall(market, "a1").collect()]
    assert steps == [("Start", "absolute", 100.0), ("v2", "relative", 50.0),
                     ("v3", "relative", -30.0)]
    assert len(P.price_listing(market).columns) == 11
    capped = P.cap_rows(market, 2, "product_id", "price_version")
    assert rows_of(capped.select("price_version")) == [{"price_version": 1}, {"price_version": 2}]
