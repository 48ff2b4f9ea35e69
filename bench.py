"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
is run once in full into a sink that drops the rows; ``marts`` is the time to
derive and write the marts the queries read.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from scorewatch.workload import queries  # noqa: E402

HEADLINE = [
    "score_distribution", "static_deciles", "overall_summary", "score_drift", "feature_psi",
    "feature_quality", "feature_score_corr", "population_mix", "performance_v1", "calibration_v1",
    "cohort_info", "backfill_psi", "stability_status", "feature_stability", "psi_table", "csi_table",
    "column_quality", "mix_shift", "performance_report", "edr_rank_ordering", "calibration_m12",
    "ks_drop", "odds", "ks_table", "attribution", "governance", "checks",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("scorewatch-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    timed("marts", lambda: (queries.marts(spark, folder), queries.outcome_mart(spark, folder)))
    for name in HEADLINE:
        timed(name, lambda: queries.REGISTRY[name](spark, folder)
              .write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
