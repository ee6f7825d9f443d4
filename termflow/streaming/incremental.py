"""Batch-incremental refresh of stored statistics.

The unit of change is a day: rates of a day depend on all comments of that day.
The rolling columns carry a change to later rows, but not far: a series (topic,
word) with a row on a changed day gets new means in its next four rows and a new
change in the fifth, and a series without one stays as it is. So a refresh
writes the partitions of its days and those of later days that hold such a row.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow.functions.dates import Bound, day_bounds
from termflow.operators.rates import (
    AVERAGE,
    CHANGE,
    RATE,
    ROLLING_ROWS,
    add_statistics_id,
    rolling_average,
    series,
)
from termflow.schemas import WORD_STATISTICS, enforce_schema
from termflow.sources.readers import read_statistics
from termflow.sources.writers import drop_path
from termflow.streaming.series_state import SERIES, latest_rows, next_rows

WAS_AVERAGE, WAS_CHANGE = f"stored_{AVERAGE}", f"stored_{CHANGE}"


@dataclass(frozen=True)
class Refresh:
    """What a refresh writes, and what the state of the series needs of it."""

    statistics: DataFrame
    #: New rows of the days, and later rows whose rolling columns changed.
    rewritten: DataFrame
    #: The rows before the days that their rolling columns reach back to.
    seeds: DataFrame


def _rolled(rows: DataFrame, first: str) -> DataFrame:
    """Rolling columns; means that are there already stand."""
    return (
        rows.withColumn(AVERAGE, F.coalesce(AVERAGE, rolling_average()))
        .withColumn(CHANGE, F.col(AVERAGE) - F.lag(AVERAGE).over(series()))
        .where(F.col("date") >= first)
    )


def _finished(rows: DataFrame) -> DataFrame:
    return rows.transform(add_statistics_id).transform(
        enforce_schema, WORD_STATISTICS, distinct=False
    )


def appended(changed: DataFrame, state: DataFrame, first: str) -> Refresh:
    """Statistics of days after all stored ones.

    ``changed`` are their counts and rates. The state of the series is all that
    is read of what came before.
    """
    rows = changed.unionByName(state, allowMissingColumns=True)
    statistics = _finished(_rolled(rows, first))
    return Refresh(statistics, statistics, state.limit(0))


def corrected(
    stored: DataFrame, changed: DataFrame, first: str, last: str, scratch: str
) -> Refresh:
    """Statistics of stored days that changed, and of later rows with them.

    Of history and of later days, the series that have a row on a changed day,
    before or after the change, are read in a few columns: four rows back and
    five ahead. What their rolling columns become is kept in ``scratch``; then
    only the later partitions in which one of them differs are read in full.
    """
    spark = stored.sparkSession
    is_later = F.col("date") > last
    of_days = stored.where(F.col("date").between(first, last))
    touched = (
        changed.select(*SERIES).unionByName(of_days.select(*SERIES)).distinct()
    )
    narrow = stored.select(*SERIES, "date", RATE, AVERAGE, CHANGE)
    seeds = latest_rows(
        narrow.where(F.col("date") < first).join(touched, [*SERIES], "left_semi")
    )
    ahead = next_rows(
        narrow.where(is_later).join(touched, [*SERIES], "left_semi"), ROLLING_ROWS
    ).withColumnsRenamed({AVERAGE: WAS_AVERAGE, CHANGE: WAS_CHANGE})
    differs = ~(
        F.col(AVERAGE).eqNullSafe(F.col(WAS_AVERAGE))
        & F.col(CHANGE).eqNullSafe(F.col(WAS_CHANGE))
    )
    rolled = _rolled(
        changed.unionByName(seeds, allowMissingColumns=True).unionByName(
            ahead, allowMissingColumns=True
        ),
        first,
    ).where(~is_later | differs)
    rolled.write.parquet(f"{scratch}/rolled")
    rolled = spark.read.schema(rolled.schema).parquet(f"{scratch}/rolled")
    seeds.write.parquet(f"{scratch}/seeds")
    seeds = spark.read.schema(seeds.schema).parquet(f"{scratch}/seeds")

    update = rolled.where(is_later).select(
        *SERIES,
        "date",
        F.col(AVERAGE).alias("new_average"),
        F.col(CHANGE).alias("new_change"),
        F.lit(True).alias("is_new"),
    )
    # At most a value per stored day; it prunes the partitions to read.
    days = [row["date"] for row in update.select("date").distinct().collect()]
    partitions = update.select("topic", "date").distinct()
    later = (
        stored.where(F.col("date").isin(days))
        .join(partitions, ["topic", "date"], "left_semi")
        .join(update, [*SERIES, "date"], "left")
        .withColumns(
            {
                AVERAGE: F.when(F.col("is_new"), F.col("new_average")).otherwise(
                    F.col(AVERAGE)
                ),
                CHANGE: F.when(F.col("is_new"), F.col("new_change")).otherwise(
                    F.col(CHANGE)
                ),
            }
        )
        .select(*WORD_STATISTICS.names)
    )
    statistics = _finished(rolled.where(~is_later))
    if days:
        statistics = statistics.unionByName(later)
    return Refresh(statistics, rolled, seeds)


def partitions_of_days(
    spark: SparkSession, path: str, start: Bound, end: Bound
) -> DataFrame:
    """(topic, date, folder) of the stored partitions of a range of days."""
    first, last = (str(day) for day in day_bounds(start, end))
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    return (
        read_statistics(spark, path)
        .where(F.col("date").between(first, last))
        .select("topic", "date", folder.alias("folder"))
        .distinct()
    )


def drop_vanished(
    spark: SparkSession, before: DataFrame, counted: DataFrame
) -> int:
    """Delete the partitions of ``before`` that got no rows this time.

    Replacing only touched partitions keeps those of a topic and day that has
    no comments any more. The driver streams their folders, and holds one task's
    share of them at a time.
    """
    vanished = before.join(counted, ["topic", "date"], "left_anti")
    # File paths are URIs: percent signs of directory names come encoded.
    return sum(
        drop_path(spark, unquote(row["folder"]))
        for row in vanished.toLocalIterator()
    )
