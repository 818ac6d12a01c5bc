"""Times the headline queries and prints one JSON line.

Each query runs twice and the second run counts: the first one mostly measures
how long the JVM takes to compile the generated code.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.registry.queries import all_queries  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = [
    "silver_stg_sales_orders",
    "silver_trf_sales_summary",
    "pg_trf_sales_summary",
    "sales_top10_products",
    "sales_by_territory",
    "sales_top5_per_territory",
    "sales_category_share",
    "ingest_all_tables",
    "bronze_weather_hourly",
    "silver_weather_hourly",
    "gold_weather_daily",
    "gold_island_daily",
    "gold_alert_dashboard",
    "fact_weather_daily",
    "upsert_ignore",
    "upsert_replace",
    "landing_hourly_documents",
    "stream_landing_to_bronze",
    "stream_bronze_to_silver",
    "dq_gold",
    "dq_unique_keys",
    "hr_top5_pay",
    "hr_mover_pct",
    "vendor_ranking",
    "vendor_shipmethod_compare",
    "rfm_segment_distribution",
    "rfm_territory_profile",
    "rfm_winback",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "millrace-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(run(name), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
