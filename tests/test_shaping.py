from pyspark.sql import functions as F

from cartwheel.operators import shaping as R
from conftest import by_key, rows_of, ts

RESULTS = "product_id string, results array<struct<item_id string, price double>>"


def test_min_price_skips_missing_and_zero(frame):
    df = frame(RESULTS,
               ("a", [("1", 0.0), ("2", None), ("3", 5.0), ("4", 7.0)]),
               ("b", [("1", 0.0)]), ("c", []), ("d", None))
    got = by_key(df.select("product_id", R.min_listing_price(F.col("results")).alias("p")),
                 "product_id")
    assert [got[k]["p"] for k in "abcd"] == [5.0, None, None, None]


def test_flat_listings_agree_with_nested(frame):
    flat = frame("product_id string, price double",
                 ("a", 0.0), ("a", None), ("a", 5.0), ("a", 7.0), ("b", 0.0))
    assert rows_of(R.min_price_by_product(flat)) == [{"product_id": "a", "min_price_ars": 5.0}]


def test_top_n_takes_ten_and_limits_before_the_shuffle(frame):
    df = frame("cat string, pos int, id string",
               *[("a", i, f"p{i:02}") for i in range(12)], ("b", 1, "x"))
    top = R.top_n_per_group(df, "cat", ["pos"], 10)
    assert {r.id for r in top.where("cat = 'a'").collect()} == {f"p{i:02}" for i in range(10)}
    assert top.where("cat = 'b'").count() == 1
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_build_products(frame):
    categories = frame("id string, name string, position int",
                       *[(f"c{i}", f"Cat {i}", i) for i in range(7)])
    highlights = frame("category_id string, product_id string, position int",
                       *[("c0", f"p{i:02}", i) for i in range(12)],
                       ("c1", "p00", 1), ("c1", "gone", 2), ("c6", "far", 1))
    details = frame("product_id string, name string, status string, domain_id string",
                    *[(f"p{i:02}", f"N{i}", "active", "d") for i in range(12)],
                    ("far", "F", "active", "d"))
    listings = frame("product_id string, price double",
                     ("p00", 9.0), ("p00", 4.0), ("p01", 0.0), ("p11", 1.0))
    got = R.build_products(categories, highlights, details, listings, ts("2024-01-01"))
    rows = got.collect()
    assert sorted((r.category_id, r.product_id) for r in rows) == \
        [("c0", f"p{i:02}") for i in range(10)] + [("c1", "p00")]
    prices = {(r.category_id, r.product_id): r.min_price_ars for r in rows}
    assert prices["c0", "p00"] == prices["c1", "p00"] == 4.0
    assert prices["c0", "p01"] is None
    assert {r.currency for r in rows} == {"ARS"}
    assert {r.ingested_at for r in rows} == {ts("2024-01-01")}
