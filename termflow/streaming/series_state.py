"""The last rows of every series, kept beside the stored statistics.

A table of at most four rows per (topic, word): what the rolling columns of the
next day need. A run on appended days reads it instead of the stored history.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termflow.operators.rates import AVERAGE, RATE, ROLLING_ROWS
from termflow.sources.writers import drop_path, list_names, touch

SERIES = ("topic", "word")
STATE = T.StructType(
    [T.StructField(name, T.StringType()) for name in (*SERIES, "date")]
    + [T.StructField(name, T.DoubleType()) for name in (RATE, AVERAGE)]
)
READY = ".ready"


def latest_rows(rows: DataFrame, n: int = ROLLING_ROWS - 1) -> DataFrame:
    """The last ``n`` rows of each series, without other columns than STATE.

    Spark keeps ``n`` rows per series in each task before the shuffle.
    """
    return _ranked(rows, F.desc("date"), n).select(*STATE.names)


def next_rows(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each series."""
    return _ranked(rows, F.asc("date"), n)


def _ranked(rows: DataFrame, order, n: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("word", "topic").orderBy(order))
    return rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def next_state(
    state: DataFrame, rewritten: DataFrame, seeds: DataFrame, first: str, last: str
) -> DataFrame:
    """The state after the days from ``first`` to ``last`` changed.

    ``rewritten`` are the new rows of these days and the later ones that changed
    with them, ``seeds`` the four rows before ``first`` of the series they are
    of: where a series lost its last rows, these come into the state again.
    """
    kept = state.where(~F.col("date").between(first, last)).unionByName(seeds)
    values = F.struct("newer", RATE, AVERAGE)
    together = (
        kept.withColumn("newer", F.lit(False))
        .unionByName(rewritten.select(*STATE.names).withColumn("newer", F.lit(True)))
        .groupBy(*SERIES, "date")
        .agg(F.max(values).alias("values"))
        .select(*SERIES, "date", f"values.{RATE}", f"values.{AVERAGE}")
    )
    return latest_rows(together)


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state that the last run left, None if it did not get so far."""
    ready = [name for name in list_names(spark, path) if name.endswith(READY)]
    if not ready:
        return None
    version = ready[0].removesuffix(READY)
    return spark.read.schema(STATE).parquet(f"{path}/{version}")


def withdraw_state(spark: SparkSession, path: str) -> None:
    """From here on until ``write_state``, no run finds a state.

    Its files stay, for a frame that was read from them.
    """
    for name in list_names(spark, path):
        if name.endswith(READY):
            drop_path(spark, f"{path}/{name}")


def write_state(state: DataFrame, path: str) -> None:
    """Write a new version, publish it, then delete the others."""
    spark = state.sparkSession
    version = uuid.uuid4().hex
    state.write.parquet(f"{path}/{version}")
    touch(spark, f"{path}/{version}{READY}")
    for name in list_names(spark, path):
        if not name.startswith(version):
            drop_path(spark, f"{path}/{name}")
