"""Times the headline queries: one JSON line on stdout."""

from __future__ import annotations

import json
import os
import time

from checks.registry import all_queries
from headway.session import build_session

HEADLINE = [
    "silver_summary",
    "trip_stop_performance",
    "fact_trip_stop_performance",
    "route_daily_performance",
    "line_delay_concentration",
    "alert_delay_impact",
    "coverage_by_day",
    "on_time_by_line",
    "on_time_by_hour",
    "network_headline",
    "stg_stop_times",
    "flatten_updates",
    "delay_kpis",
    "risk_training_set",
    "risk_recent_delay",
    "rule_report",
    "file_ingest",
    "fact_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "headway-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
