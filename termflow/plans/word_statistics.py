"""Daily word statistics per topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termflow.functions.dates import Bound, day_bounds
from termflow.operators.counts import (
    add_daily_frequency,
    add_daily_totals,
    add_word_counts,
    count_topic_words,
)
from termflow.operators.rates import (
    add_change_in_average,
    add_five_row_average,
    add_rates_and_specificity,
    add_statistics_id,
)
from termflow.plans.comment_tokens import comment_words
from termflow.schemas import WORD_STATISTICS, enforce_schema


def word_statistics(tokens: DataFrame) -> DataFrame:
    """Statistics of a table of comment tokens, which is read once, at once.

    Its counts are stored in the shared folder; the rest is lazy.
    """
    rates = add_rates_and_specificity(add_word_counts(tokens))
    return _finish(rates)


def topic_word_rates(
    comments: DataFrame,
    topic_map: DataFrame,
    start: Bound,
    end: Bound,
    *,
    counts_path: str | None = None,
    **options,
) -> DataFrame:
    """Counts and rates straight from comments, which are read once.

    The counts are used twice, for totals and for details. With ``counts_path``
    they are written to that new folder first and read back, so that nothing
    before them can run again, whatever happens to executors. Without it the
    result is lazy, and one pass over the comments depends on Spark reusing the
    shuffle of the counts: it does, unless the map is a cached frame.
    """
    first, last = day_bounds(start, end)
    days = max((last - first).days + 1, 0)
    # The map is measured here, once, for its own join and for the totals.
    map_bytes, topic_bytes = measure_map(topic_map)
    counts = comment_words(
        comments,
        topic_map,
        start,
        end,
        map_bytes=map_bytes,
        mark_repeated=True,
        **options,
    ).transform(count_topic_words)
    if counts_path is not None:
        # The rows are dealt by day and word here, not when they are read back.
        counts = add_daily_frequency(counts)
        counts.write.parquet(counts_path)
        reader = comments.sparkSession.read.schema(counts.schema)
        counts = reader.parquet(counts_path)
    return counts.transform(
        add_daily_totals, days * topic_bytes
    ).transform(add_rates_and_specificity)


def comment_statistics(
    comments: DataFrame,
    topic_map: DataFrame,
    start: Bound,
    end: Bound,
    **options,
) -> DataFrame:
    """``word_statistics`` of ``comment_tokens``, without storing tokens.

    Every comment is read and tokenised once and its words are shuffled once;
    what follows works on counts. Options are those of ``comment_words`` and
    ``topic_word_rates``.
    """
    return topic_word_rates(
        comments, topic_map, start, end, **options
    ).transform(_finish)


def _finish(rates: DataFrame) -> DataFrame:
    """Rolling columns and key; unique by (topic, date, word) already."""
    return (
        rates.withColumn("date", F.col("date").cast("string"))
        .transform(add_five_row_average)
        .transform(add_change_in_average)
        .transform(add_statistics_id)
        .transform(enforce_schema, WORD_STATISTICS, distinct=False)
    )


def measure_map(topic_map: DataFrame) -> tuple[int, int]:
    """Bytes of the map, and of a row of totals for each of its topics.

    A row of totals has the topic's name and four numbers of a day; names that
    occur in several lists count each time, so this is an upper bound.
    """
    commas = F.length("topics") - F.length(F.replace("topics", F.lit(",")))
    text = F.coalesce(F.octet_length("topics"), F.lit(0))
    name = F.coalesce(F.octet_length("subreddit"), F.lit(0))
    row = topic_map.agg(
        F.sum(text + name + 64).alias("map"),
        F.sum(text + 64 * (F.coalesce(commas, F.lit(0)) + 1)).alias("totals"),
    ).first()
    return row["map"] or 0, row["totals"] or 0
