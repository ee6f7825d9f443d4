"""Run registered queries beside their SQL: ``python -m checks.compare``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracles import oracle_sql
from checks.registry import QUERIES
from termflow.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in a fixed order."""
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'"
        )
    sql, failed = oracle_sql(), 0
    for name in names or QUERIES:
        started = time.time()
        try:
            ours = canonical(QUERIES[name](spark, sf_dir).toPandas())
            middle = time.time()
            theirs = canonical(con.execute(sql[name]).df())
            note = f"spark {middle - started:.1f}s sql {time.time() - middle:.1f}s"
            pd.testing.assert_frame_equal(
                ours, theirs, check_exact=True, check_dtype=False
            )
            print(f"ok   {name} {len(ours)} rows {note}", flush=True)
        except Exception as error:  # noqa: BLE001
            failed += 1
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
