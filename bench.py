"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores.  Each
query is run to its last row, without collecting it; the best of
``BENCH_REPEATS`` runs counts.  One query is run before and not counted, and what the
runs write to the shared folder is removed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pricetide.plans.catalog import QUERIES
from pricetide.session import build_session, scratch_space

HEADLINE = (
    "price_changes",
    "daily_price_changes",
    "stability_score",
    "rain_premium",
    "weekend_premium",
    "temperature_effect",
    "category_sensitivity",
    "hourly_overall",
    "hourly_per_entity",
    "hourly_peak",
    "peak_offpeak",
    "sync_pairs_all",
    "sync_pairs_rain",
    "dynamic_pricing_index",
    "dynamic_pricing_index_zscore",
    "entity_condition_price",
    "market_condition_price",
    "category_hour_heatmap",
    "band_summary",
    "latest_prices",
    "price_history",
    "daily_prices",
    "market_summary",
    "mann_whitney",
    "kruskal_wallis",
    "slot_coverage",
    "min_gap_thinning",
    "nested_price_extract",
    "publish_set",
    "stream_changes",
    "stream_hourly",
    "stream_join",
    "stream_dedupe",
    "rank_test_report",
    "analysis_base",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    def run(name: str) -> float:
        start = time.perf_counter()
        with scratch_space(spark):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

    run("rain_premium")
    for name in names:
        seconds[name] = round(min(run(name) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of best query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
