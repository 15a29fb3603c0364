"""Time the headline queries; prints one line of JSON."""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from showpulse.plans.catalog import QUERIES  # noqa: E402
from showpulse.plans.session import SETTINGS  # noqa: E402

HEADLINE = [
    "gated_totals",
    "idle_gate",
    "idle_gate_flagged",
    "session_first",
    "first_per_batch",
    "running_total",
    "running_total_idle",
    "running_total_updates",
    "sliding_counts",
    "window_latest",
    "watchers_per_window",
    "total_latest_by_user",
    "view_rows",
    "view_key_roundtrip",
    "view_counts",
    "watchers_per_show",
    "json_roundtrip",
    "stream_idle_gate",
    "stream_running_total_idle",
    "stream_sliding_counts",
    "stream_total",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    )
    spark = builder.config(map=SETTINGS).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    times = {}
    for name in HEADLINE:
        query, _ = QUERIES[name]
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
