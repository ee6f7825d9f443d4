"""The batch job: comments and topic map to stored statistics."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from termflow.functions.dates import Bound, day_bounds
from termflow.plans.comment_tokens import comment_tokens
from termflow.plans.word_statistics import comment_statistics, topic_word_rates
from termflow.session import shared_folder
from termflow.sources.readers import read_audit, read_statistics, read_tokens
from termflow.sources.writers import (
    append_audit,
    drop_path,
    path_exists,
    write_partitioned,
    write_tokens,
)
from termflow.streaming.incremental import (
    Refresh,
    appended,
    corrected,
    drop_vanished,
    partitions_of_days,
)
from termflow.streaming.series_state import (
    latest_rows,
    next_state,
    read_state,
    withdraw_state,
    write_state,
)


@dataclass(frozen=True)
class JobSettings:
    """What a run reads and where it writes.

    ``incremental`` refreshes only the days from ``include_start_date`` to
    ``include_end_date`` of the statistics stored at ``target_path``; otherwise
    they are replaced as a whole. Without a start, an incremental run begins at
    the last day the audit names. ``table`` also registers the statistics in the
    catalog; ``tokens_path`` stores the tokens by day, and an incremental run
    replaces only its days there. ``state_path`` holds the last rows of every
    series, by default beside the target. ``scratch_path`` is a folder all
    executors share, by default that of checkpoints. ``options`` go to
    ``comment_words``.
    """

    include_start_date: Bound | None
    include_end_date: Bound
    target_path: str
    table: str | None = None
    audit_path: str | None = None
    incremental: bool = False
    tokens_path: str | None = None
    state_path: str | None = None
    scratch_path: str | None = None
    options: dict = field(default_factory=dict)


def run_job(
    spark: SparkSession,
    comments: DataFrame,
    topic_map: DataFrame,
    settings: JobSettings,
) -> dict[str, DataFrame]:
    """Write the statistics, record the run, return tokens and statistics.

    Counts are kept in the scratch folder until the statistics are written. The
    tokens are those stored, if they are, else lazy: the statistics do not need
    them. The statistics are those read back. An incremental run on a target
    that does not exist yet is a full one.
    """
    if settings.incremental and settings.include_start_date is None:
        settings = replace(
            settings, include_start_date=last_audited_day(spark, settings.audit_path)
        )
    if settings.incremental and not path_exists(spark, settings.target_path):
        settings = replace(settings, incremental=False)
    start, end = settings.include_start_date, settings.include_end_date
    scratch = settings.scratch_path or shared_folder(spark, "job")
    scratch = f"{scratch.rstrip('/')}/{uuid.uuid4().hex}"
    written = Observation("written")
    tokens = comment_tokens(
        comments,
        topic_map,
        start,
        end,
        count_ids=settings.tokens_path is not None,
        **settings.options,
    )
    try:
        if settings.incremental:
            _refresh(spark, comments, topic_map, settings, scratch, written)
        else:
            _replace(spark, comments, topic_map, settings, scratch, written)
        if settings.tokens_path is not None:
            _store_tokens(spark, tokens, settings, scratch)
            tokens = read_tokens(spark, settings.tokens_path)
    finally:
        drop_path(spark, scratch)
    if settings.audit_path is not None:
        append_audit(spark, settings.audit_path, written.get)
    statistics = read_statistics(spark, settings.target_path)
    return {"comment_tokens": tokens, "word_statistics": statistics}


def _state_path(settings: JobSettings) -> str:
    return settings.state_path or f"{settings.target_path.rstrip('/')}-state"


def _replace(
    spark: SparkSession,
    comments: DataFrame,
    topic_map: DataFrame,
    settings: JobSettings,
    scratch: str,
    written: Observation,
) -> None:
    """All statistics anew."""
    path = settings.target_path
    statistics = comment_statistics(
        comments,
        topic_map,
        settings.include_start_date,
        settings.include_end_date,
        counts_path=f"{scratch}/counts",
        **settings.options,
    )
    withdraw_state(spark, _state_path(settings))
    write_partitioned(statistics, path, table=settings.table, written=written)
    write_state(latest_rows(read_statistics(spark, path)), _state_path(settings))


def _refresh(
    spark: SparkSession,
    comments: DataFrame,
    topic_map: DataFrame,
    settings: JobSettings,
    scratch: str,
    written: Observation,
) -> None:
    """Statistics of a range of days, and what changes with them.

    Between the first file that goes and the new state there is no state, so a
    run that failed is repeated from the stored rows.
    """
    path, state_path = settings.target_path, _state_path(settings)
    start, end = settings.include_start_date, settings.include_end_date
    first, last = (str(day) for day in day_bounds(start, end))
    listed = f"{scratch}/partitions-before"
    partitions_of_days(spark, path, start, end).write.parquet(listed)
    state = read_state(spark, state_path)
    refresh = _refreshed(spark, comments, topic_map, settings, scratch, state)
    counted = _counts(spark, scratch).select("topic", "date").distinct()
    withdraw_state(spark, state_path)
    # Partitions of later days are known already; new ones are of counted days.
    write_partitioned(
        refresh.statistics,
        path,
        only_touched=True,
        table=settings.table,
        touched=counted,
        written=written,
    )
    drop_vanished(spark, spark.read.parquet(listed), counted)
    stored = read_statistics(spark, path)
    if state is None:
        write_state(latest_rows(stored), state_path)
        return
    rewritten = refresh.rewritten
    if rewritten is refresh.statistics:  # as written, not computed again
        rewritten = stored.where(F.col("date").between(first, last))
    write_state(next_state(state, rewritten, refresh.seeds, first, last), state_path)


def _refreshed(
    spark: SparkSession,
    comments: DataFrame,
    topic_map: DataFrame,
    settings: JobSettings,
    scratch: str,
    state: DataFrame | None,
) -> Refresh:
    start, end = settings.include_start_date, settings.include_end_date
    first, last = (str(day) for day in day_bounds(start, end))
    changed = topic_word_rates(
        comments,
        topic_map,
        start,
        end,
        counts_path=f"{scratch}/counts",
        **settings.options,
    ).withColumn("date", F.col("date").cast("string"))
    if state is not None:
        newest = state.agg(F.max("date").alias("day")).first()["day"]
        if newest is None or newest < first:
            return appended(changed, state, first)
    stored = read_statistics(spark, settings.target_path)
    return corrected(stored, changed, first, last, scratch)


def _counts(spark: SparkSession, scratch: str) -> DataFrame:
    """Topic and day, as string, of the counts in the scratch folder."""
    counts = spark.read.parquet(f"{scratch}/counts")
    return counts.select("topic", F.col("date").cast("string").alias("date"))


def _store_tokens(
    spark: SparkSession, tokens: DataFrame, settings: JobSettings, scratch: str
) -> None:
    """The tokens of the range; days that have none any more go."""
    if not settings.incremental:
        write_tokens(tokens, settings.tokens_path)
        return
    first, last = day_bounds(
        settings.include_start_date, settings.include_end_date
    )
    days = [str(first + timedelta(n)) for n in range((last - first).days + 1)]
    rows = _counts(spark, scratch).select("date").distinct().collect()
    write_tokens(tokens, settings.tokens_path, days, {row["date"] for row in rows})


def last_audited_day(spark: SparkSession, audit_path: str | None) -> str:
    """The latest day that the audit at ``audit_path`` says was written."""
    if audit_path is None or not path_exists(spark, audit_path):
        raise ValueError("an incremental run without a start needs an audit")
    day = read_audit(spark, audit_path).agg(F.max("max_date")).first()[0]
    if day is None:
        raise ValueError("the audit names no day")
    return day
