"""Sinks: partitioned parquet, catalog tables, topic map CSV, audit."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from termflow.schemas import AUDIT, enforce_schema

PARTITION_BY = ("topic", "date")


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = PARTITION_BY,
    sort_by: Sequence[str] = ("word",),
    only_touched: bool = False,
    table: str | None = None,
    touched: DataFrame | None = None,
    written: Observation | None = None,
) -> None:
    """Write parquet as ``topic=…/date=…/`` and optionally register a table.

    Rows are gathered per partition value, so each gets few files, but AQE
    splits a value that is too big for one task and joins small ones. Rows are
    sorted within files, which lets readers skip row groups by word.
    ``only_touched`` replaces the partitions that occur in ``df`` and no other;
    of these the catalog learns the ones in ``touched``, by default all of them.
    ``written`` observes ``rows``, ``min_date`` and ``max_date`` in the tasks that
    write, so a record of the run costs no second look at the files.
    """
    gathered = df.hint("rebalance", *partition_by)
    if written is not None:
        gathered = gathered.observe(
            written,
            F.count(F.lit(1)).alias("rows"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
        )
    sorted_rows = gathered.sortWithinPartitions(*partition_by, *sort_by)
    writer = (
        sorted_rows.write.format("parquet")
        .mode("overwrite")
        .partitionBy(*partition_by)
        .option(
            "partitionOverwriteMode", "dynamic" if only_touched else "static"
        )
    )
    if table is None:
        writer.save(path)
    elif only_touched and df.sparkSession.catalog.tableExists(table):
        writer.save(path)
        values = df if touched is None else touched
        add_partitions(df.sparkSession, table, values, partition_by)
    else:
        writer.option("path", path).saveAsTable(table)


def add_partitions(
    spark: SparkSession,
    table: str,
    touched: DataFrame,
    partition_by: Sequence[str] = PARTITION_BY,
    together: int = 500,
) -> None:
    """Make the catalog know the partitions that occur in ``touched``.

    Only their values reach the driver, in batches; stored ones are not listed.
    """
    def quoted(value) -> str:
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    batch: list[str] = []

    def flush() -> None:
        if batch:
            spark.sql(
                f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(batch)}"
            )
            batch.clear()

    for row in touched.select(*partition_by).distinct().toLocalIterator():
        values = ", ".join(
            f"{name} = {'NULL' if row[name] in (None, '') else quoted(row[name])}"
            for name in partition_by
        )
        batch.append(f"PARTITION ({values})")
        if len(batch) == together:
            flush()
    flush()


def write_tokens(
    tokens: DataFrame,
    path: str,
    days: Sequence[str] | None = None,
    with_tokens: Collection[str] = (),
) -> None:
    """Store tokens by day, as ``date=…/``.

    ``days`` are those the tokens are of: only they are replaced, and those of
    them that are not in ``with_tokens`` lose their folder. Without ``days`` the
    whole store is replaced.
    """
    spark = tokens.sparkSession
    tokens.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").option(
        "partitionOverwriteMode", "static" if days is None else "dynamic"
    ).parquet(path)
    stored = set(list_names(spark, path))
    for day in days or ():
        if day not in with_tokens and f"date={day}" in stored:
            drop_path(spark, f"{path}/date={day}")


def write_topic_map(topic_map: DataFrame, path: str) -> None:
    """CSV with a header and no index column; topic lists hold commas."""
    topic_map.select("topics", "subreddit").write.mode("overwrite").options(
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def append_audit(spark: SparkSession, path: str, run: dict) -> None:
    """Append a run's (min_date, max_date, rows) to a parquet audit folder."""
    record = spark.range(1).select(
        F.lit(uuid.uuid4().hex).alias("run_id"),
        *(F.lit(run[name]).alias(name) for name in ("min_date", "max_date", "rows")),
        F.current_timestamp().alias("processed_at"),
    )
    enforce_schema(record, AUDIT, distinct=False).coalesce(1).write.mode(
        "append"
    ).parquet(path)


# Hadoop's file system, which Python reaches through the JVM gateway only: these
# do not work over Spark Connect.


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder."""
    system, target = _file_system(spark, path)
    return system.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    return [status.getPath().getName() for status in system.listStatus(target)]


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    system, target = _file_system(spark, path)
    system.create(target).close()
