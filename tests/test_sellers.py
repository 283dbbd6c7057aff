from cartwheel.plans.sellers import mart_sellers
from conftest import by_key, ts

SELLERS = "seller_id string, city string, state string"
ITEMS = "order_id string, product_id string, seller_id string, price_brl double"
ENRICHED = ITEMS + ", category_name_en string"
ORDERS = ("order_id string, order_status string, purchased_at timestamp, "
          "delivered_to_customer_at timestamp, estimated_delivery_at timestamp")
REVIEWS = "order_id string, score bigint"


def test_seller_measures(frame):
    lines = [("o1", "p1", "s1", 10.0, "a"), ("o1", "p2", "s1", 20.0, "b"),
             ("o2", "p1", "s1", 10.0, "a"), ("o3", "p3", "s1", 5.0, None),
             ("o2", "p9", "s2", 1.0, "a"), ("o4", "p9", "s3", 1.0, "a")]
    orders = frame(
        ORDERS,
        ("o1", "delivered", ts("2024-01-01"), ts("2024-01-03"), ts("2024-01-09")),
        ("o2", "delivered", ts("2024-01-01"), ts("2024-01-06"), ts("2024-01-05")),
        ("o3", "shipped", ts("2024-01-01"), None, ts("2024-01-05")),
        ("o4", "delivered", ts("2024-01-01"), None, ts("2024-01-05")))
    got = by_key(mart_sellers(
        frame(SELLERS, ("s1", "X", "Y"), ("s2", "X", "Y"), ("s3", "X", "Y"), ("idle", "X", "Y")),
        frame(ITEMS, *[line[:4] for line in lines]), frame(ENRICHED, *lines), orders,
        frame(REVIEWS, ("o1", 4), ("o2", 1), ("o4", None))), "seller_id")
    assert set(got) == {"s1", "s2", "s3"}  # no items, no row
    one = got["s1"]
    assert (one["total_orders"], one["unique_products"], one["categories_count"]) == (3, 3, 2)
    assert one["total_revenue_brl"] == 45.0 and one["avg_item_price_brl"] == 11.25
    # two items of o1 on time in 2 days, one of o2 late in 5; the order under way is left out
    assert one["avg_delivery_days"] == 3.0 and one["on_time_delivery_rate_pct"] == 66.67
    # the review of o1 counts for both its items
    assert one["reviews_count"] == 3 and one["avg_review_score"] == 3.0
    three = got["s3"]
    assert three["avg_delivery_days"] is None and three["on_time_delivery_rate_pct"] is None
    assert three["reviews_count"] == 0 and three["avg_review_score"] is None


def test_items_meet_reviews_only_as_sums(frame):
    """Many reviews of an order with many items give no row per pair."""
    items = frame(ITEMS, *[("o1", f"p{i}", "s1", 1.0) for i in range(40)])
    enriched = frame(ENRICHED, *[("o1", f"p{i}", "s1", 1.0, "a") for i in range(40)])
    orders = frame(ORDERS, ("o1", "delivered", ts("2024-01-01"), ts("2024-01-03"), None))
    reviews = frame(REVIEWS, *[("o1", 1 + i % 5) for i in range(50)])
    df = mart_sellers(frame(SELLERS, ("s1", "X", "Y")), items, enriched, orders, reviews)
    row = df.first()
    assert row.reviews_count == 2000 and row.avg_review_score == 3.0
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in optimized.splitlines() if "Join" in line]
    assert len(joins) == 4
    # each side of a join on orders is an aggregate or has one row per order
    assert optimized.count("Aggregate [order_id") + optimized.count("Aggregate [seller_id") >= 4
