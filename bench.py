"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads. Each query is
planned and run in full (every row of every column, to a sink that drops them)
``BENCH_RUNS`` times after one unmeasured warm-up query; the best run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridtide.session import build_session  # noqa: E402
from gridtide.workloads.queries import QUERIES  # noqa: E402

HEADLINE = (
    "json_flatten", "csv_flatten", "silver_energy", "silver_weather_latest", "dedup_latest", "join_feeds",
    "upsert_orders", "insert_only_orders", "anchored_lookback", "round_hour", "calendar", "pivot_measures",
    "lag_rolling", "lag_rolling_sliced", "historic_gold", "historic_gold_batch", "bronze_to_gold", "forecast_gold",
    "training_rows", "chrono_split", "scoring_rows", "monitor_rmse", "gbt_fit_score",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "gridtide-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed("pivot_measures")
    seconds = {name: round(min(timed(name) for _ in range(runs)), 3) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
