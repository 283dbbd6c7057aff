from datetime import date

from cartwheel.operators import staging as S
from cartwheel.plans import orders as O
from cartwheel.session import keep
from conftest import by_key, rows_of, ts

ORDERS = ("order_id string, customer_id string, order_status string, purchased_at timestamp, "
          "approved_at timestamp, delivered_to_carrier_at timestamp, "
          "delivered_to_customer_at timestamp, estimated_delivery_at timestamp")
CUSTOMERS = "customer_id string, customer_unique_id string, city string, state string"
PAYMENTS = ("order_id string, payment_sequential bigint, payment_type string, "
            "installments bigint, payment_brl double")
ITEMS = ("order_id string, order_item_id bigint, product_id string, seller_id string, "
         "shipping_limit_at timestamp, price_brl double, freight_brl double, total_brl double")
PRODUCTS = "product_id string, category_name_pt string, weight_g double, photos_qty bigint"
CATEGORIES = "category_name_pt string, category_name_en string"
REVIEWS = "order_id string, score bigint"


def order(oid, delivered=None, estimated=None, status="delivered", bought="2024-01-01",
          customer="c1"):
    at = lambda t: None if t is None else ts(t)
    return (oid, customer, status, at(bought), None, None, at(delivered), at(estimated))


def enriched(frame, orders, payments=(("o1", 1, "boleto", 1, 10.0),),
             customers=(("c1", "u1", "X", "Y"),)):
    return O.orders_enriched(frame(ORDERS, *orders), frame(CUSTOMERS, *customers),
                             frame(PAYMENTS, *payments))


def test_on_time_is_three_valued(frame):
    got = by_key(enriched(frame, [
        order("same", "2024-01-05", "2024-01-05"),
        order("late", "2024-01-06", "2024-01-05"),
        order("open", None, "2024-01-05"),
        order("no_estimate", "2024-01-05", None),
    ]), "order_id")
    assert {k: v["is_on_time"] for k, v in got.items()} == {
        "same": True, "late": False, "open": None, "no_estimate": False}
    assert got["late"]["actual_delivery_days"] == 5
    assert got["open"]["actual_delivery_days"] is None
    assert got["open"]["estimated_delivery_days"] == 4


def test_days_ignore_the_time_of_day(frame):
    got = enriched(frame, [order("a", "2024-01-02T00:10:00", None, bought="2024-01-01T23:50:00")])
    assert got.first().actual_delivery_days == 1


def test_payments_add_up_and_the_primary_is_alphabetical(frame):
    got = by_key(enriched(frame, [order("o1"), order("o2"), order("o3", customer="none")], [
        ("o1", 1, "boleto", 1, 90.1), ("o1", 2, "voucher", 1, 10.2)]), "order_id")
    assert got["o1"]["total_payment_brl"] == 100.3
    assert got["o1"]["primary_payment_type"] == "voucher"
    assert got["o2"]["total_payment_brl"] == 0.0 and got["o2"]["payment_count"] is None
    assert got["o3"]["customer_unique_id"] is None


def test_category_falls_back_to_the_first_name(frame):
    got = by_key(O.order_items_enriched(
        frame(ITEMS, *[("o", i, p, "s", None, 1.0, 1.0, 2.0)
                       for i, p in enumerate(["p1", "p2", "p3", "p4"])]),
        frame(PRODUCTS, ("p1", "brinquedos", 1.0, 1), ("p2", "novo", 1.0, 1), ("p3", None, 1.0, 1)),
        frame(CATEGORIES, ("brinquedos", "toys"))), "product_id")
    assert [got[p]["category_name_en"] for p in ("p1", "p2", "p3", "p4")] == [
        "toys", "novo", None, None]


def test_sales_keep_the_order_grain(frame):
    orders = enriched(frame, [order("o1", "2024-01-05", "2024-01-06"), order("o2"),
                              order("x", status="shipped")])
    items = O.order_items_enriched(
        frame(ITEMS, ("o1", 1, "p1", "s", None, 1.1, 0.1, 1.2),
              ("o1", 1, "p2", "s", None, 2.2, 0.2, 2.4), ("o1", 2, "p1", "s", None, 1.1, 0.1, 1.2)),
        frame(PRODUCTS, ("p1", "a", 1.0, 1), ("p2", "b", 1.0, 1)), frame(CATEGORIES, ("b", "bb")))
    reviews = frame(REVIEWS, ("o1", 5), ("o1", 4), ("o1", None), ("o1", 4), ("o1", 4))
    got = by_key(O.mart_sales(orders, items, reviews), "order_id")
    assert set(got) == {"o1", "o2"}
    assert got["o1"]["items_value_brl"] == 4.4 and got["o1"]["unique_products"] == 2
    assert got["o1"]["primary_category"] == "bb"
    assert got["o1"]["review_score"] == 4.3 and got["o1"]["review_count"] == 5  # 4.25 rounds up
    assert got["o2"]["review_count"] is None and got["o2"]["items_value_brl"] is None


def test_range_builder_equals_the_whole_fact_cut(frame):
    orders = frame(ORDERS, order("o1", bought="2024-01-31"), order("o2", bought="2024-02-01"),
                   order("o3", bought="2024-03-01"), order("o4", bought="2024-02-03",
                                                           status="shipped"))
    customers = frame(CUSTOMERS, ("c1", "u1", "X", "Y"))
    payments = frame(PAYMENTS, *[(f"o{i}", 1, "boleto", 1, 10.0 * i) for i in range(1, 5)])
    items = frame(ITEMS, *[(f"o{i}", 1, "p1", "s", None, 1.0, 0.5, 1.5) for i in range(1, 5)])
    products, categories = frame(PRODUCTS, ("p1", "a", 1.0, 1)), frame(CATEGORIES, ("a", "aa"))
    reviews = frame(REVIEWS, ("o1", 1), ("o2", 2))
    build = O.sales_builder(orders, customers, payments, items, products, categories, reviews)
    whole = O.mart_sales(O.orders_enriched(orders, customers, payments),
                         O.order_items_enriched(items, products, categories), reviews)
    start, end = date(2024, 2, 1), date(2024, 2, 29)
    assert rows_of(build(start, end)) == rows_of(whole.where(whole.order_date.between(start, end)))
    assert rows_of(build(date(2024, 1, 1))) == rows_of(whole)


def test_staging_masks_zip_and_adds_totals(frame):
    raw = frame("customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                "customer_city string, customer_state string",
                ("c1", "u1", "01310", "X", "Y"), ("c2", "u2", None, "X", "Y"))
    got = by_key(S.stg_customers(raw, ts("2024-01-01")), "customer_id")
    assert got["c1"]["zip_code_masked"] == "013**" and got["c2"]["zip_code_masked"] is None
    assert got["c1"]["_loaded_at"] == ts("2024-01-01")
    items = frame("order_id string, order_item_id bigint, product_id string, seller_id string, "
                  "shipping_limit_date timestamp, price double, freight_value double",
                  ("o", 1, "p", "s", None, 1.5, 0.5), ("o", 2, "p", "s", None, 1.5, None))
    got = by_key(S.stg_order_items(items, ts("2024-01-01")), "order_item_id")
    assert got[1]["total_brl"] == 2.0 and got[2]["total_brl"] is None


def test_status_filter_reaches_the_scan(frame, spark):
    stored = keep(frame(ORDERS, order("o1")), "orders")
    sales = O.mart_sales(
        O.orders_enriched(stored, frame(CUSTOMERS, ("c1", "u1", "X", "Y")),
                          frame(PAYMENTS, ("o1", 1, "boleto", 1, 1.0))),
        frame(ITEMS + ", category_name_en string", ("o1", 1, "p", "s", None, 1.0, 1.0, 2.0, "a")),
        frame(REVIEWS, ("o1", 1)))
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_status,delivered)" in plan
    assert "approved_at" not in plan.split("ReadSchema")[1].splitlines()[0]
