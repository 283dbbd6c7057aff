"""State that is merged equals what one pass over all orders gives."""

import math
import random
from datetime import date, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from cartwheel.plans import customers as C
from cartwheel.plans import person_state as S
from cartwheel.plans.sellers import mart_sellers
from cartwheel.session import scratch_path
from cartwheel.workload import queries

ORDERS = ("order_id string, customer_unique_id string, order_status string, order_date date, customer_state string, "
          "primary_category string, total_payment_brl double, actual_delivery_days int, is_on_time boolean, "
          "primary_payment_type string")
REVIEWS = "order_id string, score bigint"
AS_OF = date(2024, 12, 31)


def random_orders(seed, n):
    r = random.Random(seed)
    orders = [(f"o{k}", r.choice(["u1", "u1", "u2", "u3", f"v{k % 9}", None]), r.choice(["delivered", "delivered", "shipped"]),
               date(2024, 1, 1) + timedelta(days=r.randrange(300)), r.choice(["A", "B", None]), r.choice(["x", "y", None]),
               r.choice([None, 10.0, 0.1, 886731.09, 33.335, 1e6 + r.random()]), r.choice([None, 1, 4, 9]),
               r.choice([None, True, False]), r.choice([None, "boleto", "voucher", "credit_card"])) for k in range(n)]
    reviews = [(f"o{r.randrange(n)}", r.choice([None, 1, 2, 3, 4, 5])) for _ in range(n)]
    return orders, reviews


def close(got, expected):
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a.keys() == b.keys()
        for k in a:
            if isinstance(b[k], float) and not math.isnan(b[k]):
                assert a[k] == pytest.approx(b[k], rel=1e-9, abs=1e-9), (k, a, b)
            else:
                assert a[k] == b[k] or (a[k] != a[k] and b[k] != b[k]), (k, a, b)


def check(state, enriched, reviews):
    sales = enriched.where("order_status = 'delivered'")
    close(rows_of(S.lifetime(state, AS_OF), "customer_unique_id"), rows_of(C.customers_lifetime(enriched, AS_OF), "customer_unique_id"))
    close(rows_of(S.mart_customer_features(state, AS_OF), "customer_unique_id"),
          rows_of(C.mart_customer_features(sales, reviews, AS_OF), "customer_unique_id"))
    close(rows_of(S.mart_customers(state, AS_OF), "customer_unique_id"),
          rows_of(C.mart_customers(C.customers_lifetime(enriched, AS_OF), enriched, reviews), "customer_unique_id"))


def state_of(enriched, reviews):
    return S.monthly_state(enriched.where("order_status = 'delivered'"), enriched, reviews)


@pytest.mark.parametrize("seed", [1, 2])
def test_parts_in_any_grouping_merge_to_the_whole(frame, seed):
    orders, reviews = random_orders(seed, 150)
    enriched, reviews = frame(ORDERS, *orders), frame(REVIEWS, *reviews)
    check(S.merged(state_of(enriched, reviews)), enriched, reviews)
    part = F.crc32("order_id") % 3
    parts = [S.merged(state_of(enriched.where(part == k), reviews)) for k in range(3)]
    check(S.merged(S.merged(parts[0].unionByName(parts[1])).unionByName(parts[2])), enriched, reviews)


def test_only_touched_months_are_computed_anew(spark, frame):
    orders, reviews = random_orders(3, 120)
    enriched, some = frame(ORDERS, *orders), frame(REVIEWS, *reviews[:60])
    table = S.state_table(spark, scratch_path(spark, "state"))
    sales = enriched.where("order_status = 'delivered'")
    S.refresh_state(table, sales, enriched, some)
    before = table.version()
    months = sorted({o[3].replace(day=1) for o in orders if o[0] in {r[0] for r in reviews[60:]}})[:4]
    inside = {o[0] for o in orders if o[3].replace(day=1) in months}
    now = frame(REVIEWS, *reviews[:60], *(r for r in reviews[60:] if r[0] in inside))
    S.refresh_state(table, sales, enriched, now, months)
    moved = {name for _, name in set(before.parts) ^ set(table.version().parts)}
    assert moved == {f"order_month={m}" for m in months}
    check(S.merged(table.read()), enriched, now)
    S.refresh_state(table, sales, enriched, now, [])
    assert table.version().number == 2


@pytest.mark.parametrize("amount, shown", [(1e25, 1e25), (float("inf"), float("inf")), (float("nan"), float("nan"))])
def test_one_absurd_amount(frame, amount, shown):
    """It is shown as it is, in its person's and its seller's row alone."""
    day = date(2024, 5, 1)
    rows = [("o1", "u1", "delivered", day, "A", "x", amount, 1, True, "boleto"), ("o2", "u2", "delivered", day, "A", "x", 5.25, 1, True, "boleto")]
    enriched, reviews = frame(ORDERS, *rows), frame(REVIEWS, ("o1", 5))
    whole = C.mart_customers(C.customers_lifetime(enriched, AS_OF), enriched, reviews)
    for mart in (whole, S.mart_customers(S.merged(state_of(enriched, reviews)), AS_OF)):
        got = {r.customer_unique_id: r.ltv_brl for r in mart.collect()}
        assert got["u2"] == 5.25 and (got["u1"] == shown or math.isnan(shown) and math.isnan(got["u1"]))
    items = [("o1", "p", "s1", amount, "x"), ("o2", "p", "s2", 5.25, "x")]
    line = "order_id string, product_id string, seller_id string, price_brl double"
    orders = frame("order_id string, order_status string, purchased_at timestamp, delivered_to_customer_at timestamp, "
                   "estimated_delivery_at timestamp", *[(o, "delivered", None, None, None) for o in ("o1", "o2")])
    shops = mart_sellers(frame("seller_id string, city string, state string", ("s1", "c", "s"), ("s2", "c", "s")),
                         frame(line, *[i[:4] for i in items]), frame(line + ", category_name_en string", *items), orders, reviews)
    got = {r.seller_id: r.total_revenue_brl for r in shops.collect()}
    assert got["s2"] == 5.25 and (got["s1"] == shown or math.isnan(shown) and math.isnan(got["s1"]))


def test_a_month_is_not_a_file_of_each_task(spark, frame):
    orders, reviews = random_orders(4, 400)
    enriched, reviews = frame(ORDERS, *orders), frame(REVIEWS, *reviews)
    table = S.state_table(spark, scratch_path(spark, "state"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        S.refresh_state(table, enriched.where("order_status = 'delivered'"), enriched, reviews)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = table.read().select(F.input_file_name().alias("file"), S.MONTH).distinct().groupBy(S.MONTH).count()
    assert {r["count"] for r in files.collect()} == {1}
    check(S.merged(table.read()), enriched, reviews)


def test_a_person_and_month_is_grouped_once(frame):
    orders, reviews = random_orders(5, 40)
    state = state_of(frame(ORDERS, *orders), frame(REVIEWS, *reviews))
    plan = state._jdf.queryExecution().analyzed().toString()
    assert plan.count("Aggregate [customer_unique_id") == 1


def test_a_day_delta_stores_only_what_state_takes(spark, monkeypatch):
    """Items are summed up for their category alone, without a distinct count of products."""
    stored, keep = {}, queries.keep

    def noted(df, label):
        stored[label] = df
        return keep(df, label)

    monkeypatch.setattr(queries, "keep", noted)
    queries.QUERIES["m3_day_delta"](spark, "/root/testdata/sf0.001")
    plan = stored["sales"]._jdf.queryExecution().optimizedPlan().toString()
    assert set(stored["sales"].columns) == set(S.SALES)
    assert "lineitem" in plan or "l_partkey" in plan
    assert "distinct" not in plan
