"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query is run to the end
into a sink that drops the rows, BENCH_RUNS times; the median counts. The index is built
before the searches, by the entry ``build_index``: searches read the stored tables.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from lettersieve.plans import catalog, session_index
from lettersieve.sources import tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
NAMES = [
    "build_postings",
    "search_batch",
    "apply_ops",
    "search_topk",
    "search_body",
    "search_text",
    "search_capped",
    "search_wildcard",
    "search_fuzzy",
    "verify_maybe",
    "uid_ranges",
    "assemble_documents",
    "bulk_export",
    "bulk_batches",
    "decode_hits",
    "apply_ops_stream",
    "index_backlog",
    "index_gaps",
    "update_postings",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(tables.table(spark, SF_DIR, "documents"))  # starts the executor threads
    seconds = {"build_index": timed(lambda: session_index.build_index(spark, SF_DIR))}
    session_index.open_index(spark, SF_DIR)
    for name in os.environ.get("BENCH_QUERIES", ",".join(NAMES)).split(","):
        query = catalog.QUERIES[name]
        seconds[name] = statistics.median(timed(lambda: run(query(spark, SF_DIR))) for _ in range(RUNS))
    print(
        json.dumps(
            {
                "metric": "total time of headline queries (median of runs)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
