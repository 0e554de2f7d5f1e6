"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tarmac.plans import registry  # noqa: E402

HEADLINE = [
    "stg_flights", "flights_enriched", "delay_classified", "route_month_stats", "route_stats", "dim_airport",
    "dim_route", "fact_flights", "fact_route_monthly", "executive_kpis", "monthly_otp_trend", "delay_distribution",
    "delay_describe", "cause_share_by_year", "profile_schema", "profile_summary", "verify_carriers",
    "verify_duplicates", "dq_not_null", "dq_unique", "dq_accepted_values", "dq_scorecard", "kpi_on_time_rate",
    "carrier_significance", "seasonality", "otp_projection", "ingest_flights", "load_reconcile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tarmac-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    queries["monthly_otp_trend"](spark, sf_dir).collect()  # start-up is not measured
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
