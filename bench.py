"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import re
import time

from cartwheel.session import local_session
from cartwheel.workload.queries import QUERIES

HEADLINE = [
    "m1_orders_enriched", "m2_order_items_enriched", "m3_customers_lifetime", "m4_mart_sales",
    "m5_mart_customers", "m6_mart_cohorts", "m7_mart_sellers", "m8_mart_customer_features",
    "m9_mart_price_history", "m10_dim_date", "m11_sales_by_calendar",
    "h1_snapshot_run", "h2_snap_products", "h3_snap_sellers", "h5_valid_at",
    "n1_global_ntile", "k1_revenue_by_month", "k6_monthly_retention_rate",
    "d2_price_ranking", "d8_price_gallery", "d10_price_drops",
    "i1_partitioned_mart", "i3_incremental_refresh", "i4_backfill",
    "q7_no_overlapping_periods", "q8_volume_anomaly", "q9_relationships", "q10_source_suite",
    "s1_csv_load", "s2_jsonl_load", "s7_load_all", "s13_schema_drift",
    "r4_marketplace_products", "g1_pii_documents", "g2_sql_guard", "g3_parse_answer",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["m1_orders_enriched"](spark, folder).count()  # start the JVM's workers

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else folder,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
