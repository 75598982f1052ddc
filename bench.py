"""Headline queries, warm, and the cold loads they read from, one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).
"""

from __future__ import annotations

import json
import os
import time

from tallyshelf.plans import inputs
from tallyshelf.plans.queries import QUERIES
from tallyshelf.session import build_session

HEADLINE = [
    "standardize", "dedupe_daily_snapshot", "gold_marketplace_summary", "etl_quality_summary", "platform_day_counts",
    "resolve_fact_keys", "new_facts", "new_products", "sales_key_lookup", "marketplace_snapshot", "platform_quality",
    "price_distribution", "facts_by_source_day", "products_by_category", "avg_price_per_currency",
    "latest_fact_per_product", "product_search_page", "product_search_total", "compare_products", "convert_currency",
    "recommend_products", "assign_surrogate_keys", "validate_price_snapshot", "extract_price_table", "extract_links",
    "visible_text", "keyword_normalize", "select_work", "stream_daily_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(run) -> float:
        began = time.perf_counter()
        run()
        return round(time.perf_counter() - began, 3)

    def drain(name: str):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    setup = {
        "stage_raw": seconds(lambda: inputs.raw_snapshots(spark, sf_dir)),
        "stage_processed": seconds(lambda: inputs.processed_snapshots(spark, sf_dir)),
        "load_warehouse": seconds(lambda: inputs.star(spark, sf_dir)),
    }
    for name in HEADLINE:
        drain(name)()
    # Single warm runs vary: each query's middle one of three counts.
    runs = [{name: seconds(drain(name)) for name in HEADLINE} for _ in range(3)]
    timed = {name: sorted(r[name] for r in runs)[1] for name in HEADLINE}
    print(json.dumps({
        "metric": "headline queries, warm, and loads", "value": round(sum(timed.values()) + sum(setup.values()), 3), "unit": "sec",
        "queries": {**timed, **setup}, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
