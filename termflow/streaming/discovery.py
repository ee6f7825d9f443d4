"""Refresh of the days that new files of comments touch.

A file stream only says which files are new: its checkpoint remembers the ones
that were taken. The days they hold are then refreshed from all files, as a day
is the unit of change.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from termflow.functions.dates import epoch_day
from termflow.plans.job import JobSettings, run_job
from termflow.schemas import COMMENTS
from termflow.sources.readers import read_source
from termflow.sources.writers import path_exists


def runs_of_days(days: Iterable[date]) -> list[tuple[date, date]]:
    """First and last day of each run of consecutive days."""
    runs: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        if runs and day - runs[-1][1] == timedelta(1):
            runs[-1] = runs[-1][0], day
        else:
            runs.append((day, day))
    return runs


def refresh_from_new_files(
    spark: SparkSession,
    folder: str,
    topic_map: DataFrame,
    settings: JobSettings,
    checkpoint: str,
    file_format: str = "json",
) -> list[tuple[date, date]]:
    """Run the job for the days of the files that came since the last call.

    ``folder`` holds comments in ``file_format``; ``checkpoint`` is a folder of
    its own, always the same for one target. Bounds of ``settings`` are replaced
    by each run of consecutive days, which are returned; without a target yet,
    by one run from the first to the last of them. At most one value per day
    reaches the driver. A call that failed takes the same files again, and a
    refresh can be repeated.
    """
    done: list[tuple[date, date]] = []

    def take(batch: DataFrame, _: int) -> None:
        # The batch's own session has the stream's settings.
        session = batch.sparkSession
        found = batch.select(epoch_day("created_utc").alias("day")).distinct()
        runs = runs_of_days(row["day"] for row in found.collect() if row["day"])
        if runs and not path_exists(session, settings.target_path):
            runs = [(runs[0][0], runs[-1][1])]
        comments = read_source(session, folder, file_format, COMMENTS)
        for first, last in runs:
            ranged = replace(
                settings,
                include_start_date=first,
                include_end_date=last,
                incremental=True,
            )
            run_job(session, comments, topic_map, ranged)
            done.append((first, last))

    stream = spark.readStream.schema(COMMENTS).format(file_format).load(folder)
    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done
