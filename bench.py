"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the folder of test tables, ``BENCH_CPUS`` the number of local cores.
Each query runs in full into a sink that keeps nothing; the second of two runs counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workload.queries import QUERIES  # noqa: E402

HEADLINES = (
    "bars", "return_table", "last_price", "last_volume", "reconstruct", "price_history",
    "roundtrip_diff", "max_date", "last_date", "param_query", "delete_matching", "insert_absent",
    "upsert", "replace_by_date", "drop_unchanged", "extend_enum_wide", "encode_enums",
    "normalise_bars", "refresh_prices", "update_all_prices",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINES:
        run(name)
        seconds[name] = round(run(name), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
