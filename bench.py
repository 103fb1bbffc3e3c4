"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local cores. Each query runs
once to warm up and then once timed, its rows written to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from voltaria import queries
from voltaria.session import build_session

HEADLINE = (
    "district_kpis",
    "sessions_clean",
    "unified_hourly",
    "demand_features",
    "congestion_features",
    "pricing_features",
    "spatial_lags",
    "graph_windows",
    "chronological_split",
    "outliers_iqr",
    "roc_auc",
    "best_actions",
    "scenario_comparison",
    "metric_drift",
    "kpi_summary",
    "revenue_waterfall",
    "row_positions_split",
    "missing_interpolate_split",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    queries.load_all()
    spark = build_session(
        "voltaria-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
