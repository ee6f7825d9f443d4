"""Time the headline queries and print one JSON line.

Some given tables are one file with one row group, which one task reads. They
are laid out anew, in as many files as there are cores, in a scratch folder
before anything is timed, as a table of any size has splits; ``as_given`` has
the times of ``BENCH_AS_GIVEN`` queries on the given files.

``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_REPEATS`` set data, cores and runs
per query (the best one counts).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.registry import QUERIES  # noqa: E402
from termflow.session import build_session, shared_folder  # noqa: E402

HEADLINES = (
    "comment_tokens",
    "word_statistics",
    "comment_statistics",
    "trending_terms",
    "topic_terms_job",
    "topic_map",
    "sum_column",
    "size_percentiles",
    "latest_key_per_group",
)
#: What the headline queries read.
TABLES = ("documents", "pages", "lineitem", "orders")
AS_GIVEN = "comment_tokens comment_statistics"


def best_time(query, spark, sf_dir: str, repeats: int) -> float:
    """Seconds of the fastest run, every row computed and none kept."""
    times = []
    for _ in range(repeats):
        spark.catalog.clearCache()
        started = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - started)
    return round(min(times), 3)


def laid_out(spark, sf_dir: str, files: int) -> str:
    """A copy of the tables the queries read, each in ``files`` files."""
    folder = shared_folder(spark, "bench")
    for name in TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        table.repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = laid_out(spark, sf_dir, int(cpus))
    seconds = {n: best_time(QUERIES[n], spark, folder, repeats) for n in names}
    given = os.environ.get("BENCH_AS_GIVEN", AS_GIVEN).split()
    as_given = {n: best_time(QUERIES[n], spark, sf_dir, 1) for n in given if n in names}
    line = {
        "metric": "total seconds of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "as_given": as_given,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
