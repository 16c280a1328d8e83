"""Time the headline queries; prints one JSON line.

Every query runs once to warm up and is then timed once, written to the noop
sink, which computes all rows and columns without moving them to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "daily_snapshot",
    "core_kpis",
    "campaign_performance",
    "measures_by_day",
    "rolling_7d",
    "acceptance_collapse",
    "reply_decay",
    "reply_decay_revenue",
    "modified_z",
    "iqr_flags",
    "capacity_limits",
    "dq_uniqueness",
    "dq_all_checks",
    "scd1_merge",
    "scd2_history",
    "resolve_keys",
    "fact_idempotent_load",
    "reject_split",
    "incremental_equals_full",
    "anomaly_scores",
    "account_health",
    "risk_report",
]


def main() -> None:
    from tallyloom.plans.registry import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus.replace("*", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of warm runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
