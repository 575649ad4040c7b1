"""Time the headline queries on local[$BENCH_CPUS] and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from traitvote.starschema import QUERIES

HEADLINE = [
    "scan_traits",
    "standardize_attributions",
    "homonym_genera",
    "correct_names",
    "species_obs",
    "species_consensus",
    "genus_consensus",
    "family_consensus",
    "family_confidence",
    "impute_cascade",
    "build_and_label",
]


def run(spark: SparkSession, sf_dir: str, name: str) -> float:
    """Seconds to plan a query and compute every row of its result."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    for name in HEADLINE:  # once each, so that compiled code is there for all
        run(spark, sf_dir, name)
    seconds = {
        name: round(statistics.median(run(spark, sf_dir, name) for _ in range(repeats)), 3)
        for name in HEADLINE
    }
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
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
