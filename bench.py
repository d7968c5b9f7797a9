"""Time the headline queries end to end; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.  One run on
the smallest tables warms the JVM up; then every query is planned and run once into a
sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "technical_frame",
    "technical_range",
    "sma",
    "ema_reference",
    "bollinger",
    "rsi",
    "dedup_ticker",
    "latest_n_per_ticker",
    "chart_json_explode",
    "technical_join",
    "batch_view",
    "request_prices",
    "resolve_requests",
    "daily_refresh",
    "refresh_indicators",
    "stream_ingest",
    "watchlist_nested",
    "watchlist_add",
    "export_combined",
]


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 8))
    warm = Path(sf_dir).parent / "sf0.001"
    for name in ("technical_frame", "watchlist_nested"):
        QUERIES[name](spark, str(warm if warm.exists() else sf_dir)).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    line = {
        "metric": "headline queries, end to end",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
