"""Times every query at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

A query runs once unmeasured and then three times; the median counts. All rows
and columns of the result are computed (noop sink)."""

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from checks.catalog import QUERIES  # noqa: E402

RUNS = 3


def seconds(spark, run, sf_dir):
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    medians = {}
    for name in sys.argv[1:] or QUERIES:
        run = QUERIES[name]
        seconds(spark, run, sf_dir)
        medians[name] = round(
            statistics.median(seconds(spark, run, sf_dir) for _ in range(RUNS)), 4
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of the median query times",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
