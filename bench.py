"""Time the headline queries and print one JSON line.

Each query is run once to warm up and then BENCH_RUNS times into the noop sink; the median
counts. The given tables are single files of one row group, so a plan that broadcasts the small
side would leave all texts to one task; the low broadcast threshold lets the joins spread them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pairloom.queries.catalog import REGISTRY  # noqa: E402

HEADLINE = (
    "metadata_report",
    "split_stratified",
    "fraction_sweep",
    "batch_manifest",
    "sft_view",
    "reward_view",
    "ppo_prompts",
    "length_cap",
    "median_reading_time",
    "category_eval",
    "power_report",
    "win_rate",
    "kl_join",
    "response_tokens",
    "sequence_mean_kl",
    "advantages",
    "reward_baseline",
    "clip_fraction",
    "run_metrics",
    "preference_fit",
)


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pairloom-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.autoBroadcastJoinThreshold", "1MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = session(cpus)
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
