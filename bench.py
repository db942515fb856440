"""Times every registered query once and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Each query is run to the end into the noop
sink, jobs that it starts while being built included. The session is warmed up by one untimed query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from lodestrata.plans.catalogue import QUERIES  # noqa: E402
from lodestrata.sources.tables import load  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# headline queries and the table whose rows they work through
RATES = {
    "chunks": "documents",
    "stream_chunks": "documents",
    "index_sync": "documents",
    "html_elements": "pages",
    "topk_cosine": "embeddings",
    "history_pairs": "conversations",
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lodestrata-bench")
        .config("spark.sql.shuffle.partitions", CPUS if CPUS.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR", "/tmp/lodestrata-bench"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    run(spark, "embed_chunks")  # JVM and Python workers up
    wanted = sys.argv[1:] or list(QUERIES)
    times = {name: round(run(spark, name), 3) for name in wanted}
    rows = {t: load(spark, SF_DIR, t).count() for t in RATES.values()}
    print(
        json.dumps(
            {
                "metric": "total seconds over registered queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_sec": {q: round(rows[t] / times[q]) for q, t in RATES.items() if q in times},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
