"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pricelens.plans.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("pricelens-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        # Small test tables: let partitions stay small enough to use every core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or list(QUERIES)
    QUERIES["clean_listings"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
