"""Comments and topic map to unique (id, topic, word, date)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termflow.functions.dates import Bound
from termflow.functions.text import STOP_WORDS
from termflow.operators.broadcasts import BROADCAST_BYTES
from termflow.operators.comments import (
    add_comment_id,
    add_date,
    add_topics,
    filter_dates,
    mark_repeated_ids,
    split_repeated_ids,
)
from termflow.operators.tokens import (
    explode_topics,
    explode_words,
    remove_stop_words,
    split_topic_lists,
    tokenize,
)
from termflow.schemas import COMMENT_TOKENS, COMMENTS, enforce_schema


def dated_comments(
    comments: DataFrame,
    topic_map: DataFrame,
    start: Bound,
    end: Bound,
    *,
    normalize_left: bool = False,
    drop_empty_topics: bool = False,
    day_column: str | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    map_bytes: int | None = None,
) -> DataFrame:
    """(id, date, body, topics) of the comments in range that have topics."""
    if day_column is not None:
        comments = filter_dates(comments, start, end, day_column)
    return (
        comments.select(*COMMENTS.names)
        .transform(add_comment_id)
        .transform(add_date)
        .transform(filter_dates, start, end)
        .select("id", "date", "body", "subreddit")
        .transform(
            add_topics,
            split_topic_lists(topic_map, drop_empty_topics),
            normalize_left,
            max_broadcast_bytes,
            map_bytes,
        )
        .select("id", "date", "body", "topics")
    )


def words_of(joined: DataFrame, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """A row per word of each row's body."""
    return (
        joined.transform(tokenize)
        .transform(remove_stop_words, stop_words)
        .transform(explode_words)
    )


def comment_words(
    comments: DataFrame,
    topic_map: DataFrame,
    start: Bound,
    end: Bound,
    *,
    stop_words: Iterable[str] = STOP_WORDS,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    mark_repeated: bool = False,
    **options,
) -> DataFrame:
    """(id, word, date, topics) with an array of topics; no wide shuffle.

    Rows repeat where a comment occurs more than once in the input or in the
    map; ``mark_repeated`` adds the column ``is_repeated`` that says so.
    ``date`` is a DATE. ``map_bytes`` is the size of the map where it is known,
    else it is measured. ``day_column`` names a column of ``comments`` that holds the day of
    ``created_utc``; given a table partitioned by it, only the days in range
    are read. These and ``normalize_left`` and ``drop_empty_topics`` are options
    of ``dated_comments``.
    """
    options["max_broadcast_bytes"] = max_broadcast_bytes
    joined = dated_comments(comments, topic_map, start, end, **options)
    if mark_repeated:
        joined = mark_repeated_ids(joined, max_broadcast_bytes)
    return words_of(joined, stop_words)


def comment_tokens(
    comments: DataFrame,
    topic_map: DataFrame,
    start: Bound,
    end: Bound,
    *,
    stop_words: Iterable[str] = STOP_WORDS,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    count_ids: bool = True,
    **options,
) -> DataFrame:
    """Unique word tokens per comment and topic; one shuffle in all.

    Words and topics are distinct in the row. The ids are counted at once,
    without the bodies: only tokens of ids that occur more than once are made
    distinct over all and shuffled, after topics are split. With ``count_ids``
    off nothing runs yet, and all tokens are shuffled. Other options are those
    of ``dated_comments``.
    """
    options["max_broadcast_bytes"] = max_broadcast_bytes
    joined = dated_comments(comments, topic_map, start, end, **options)

    def tokens(rows: DataFrame, distinct: bool) -> DataFrame:
        split = words_of(rows, stop_words).transform(explode_topics)
        return enforce_schema(split, COMMENT_TOKENS, distinct)

    if not count_ids:
        return tokens(joined, True)
    once, repeated = split_repeated_ids(joined, max_broadcast_bytes)
    return tokens(once, False).unionByName(tokens(repeated, True))
