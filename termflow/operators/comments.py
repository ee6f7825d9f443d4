"""Comment-level steps: key, day, day filter, topic look-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termflow.functions.dates import Bound, day_bounds, epoch_day
from termflow.operators.broadcasts import (
    BROADCAST_BYTES,
    broadcast_if_small,
    measured_bytes,
)
from termflow.sources.scratch import stored


def add_comment_id(comments: DataFrame) -> DataFrame:
    """``id = author_created_utc``; NULL in either part gives a NULL id."""
    return comments.withColumn(
        "id", F.concat("author", F.lit("_"), "created_utc")
    )


def add_date(comments: DataFrame) -> DataFrame:
    """UTC day of ``created_utc``."""
    return comments.withColumn("date", epoch_day("created_utc"))


def filter_dates(
    df: DataFrame, start: Bound, end: Bound, date_column: str = "date"
) -> DataFrame:
    """Rows whose day, taken as midnight, lies within the bounds."""
    first, last = day_bounds(start, end)
    return df.where(F.col(date_column).between(F.lit(first), F.lit(last)))


def add_topics(
    comments: DataFrame,
    topic_map: DataFrame,
    normalize_left: bool = False,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    map_bytes: int | None = None,
) -> DataFrame:
    """Attach ``topics`` by community name; comments without any are dropped.

    Only the names of the map are lower-cased, so a comment whose name has
    capitals finds no topics unless ``normalize_left``. A name that occurs in
    several rows of the map multiplies its comments. ``map_bytes`` is the size of
    the map where it is known.
    """
    names = topic_map.select(
        F.lower("subreddit").alias("subreddit"), "topics"
    )
    if normalize_left:
        comments = comments.withColumn("subreddit", F.lower("subreddit"))
    return comments.join(
        broadcast_if_small(names, max_broadcast_bytes, map_bytes), "subreddit"
    )


def repeated_ids(comments: DataFrame) -> DataFrame:
    """``repeated_id``: the ids, or NULL, that more than one row has.

    They are counted at once, without the bodies, and stored.
    """
    return stored(
        comments.groupBy(F.col("id").alias("repeated_id"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("repeated_id"),
        "repeated-ids",
    )


def split_repeated_ids(
    comments: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES
) -> tuple[DataFrame, DataFrame]:
    """The rows whose id no other row has, and all others."""
    repeated = broadcast_if_small(repeated_ids(comments), max_broadcast_bytes)
    same = F.col("id").eqNullSafe(F.col("repeated_id"))
    return (
        comments.join(repeated, same, "left_anti"),
        comments.join(repeated, same, "left_semi"),
    )


def mark_repeated_ids(
    comments: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``is_repeated``: another row has the same id (or NULL, as this one).

    Ids are counted at once, without the bodies, and the repeated ones stored.
    Without any nothing is joined. They are usually few; only a large size of
    them moves the bodies.
    """
    repeated = repeated_ids(comments).withColumn("is_repeated", F.lit(True))
    size = measured_bytes(repeated)
    if not size:
        return comments.withColumn("is_repeated", F.lit(False))
    return comments.join(
        broadcast_if_small(repeated, max_broadcast_bytes, size),
        F.col("id").eqNullSafe(F.col("repeated_id")),
        "left",
    ).withColumn(
        "is_repeated", F.coalesce("is_repeated", F.lit(False))
    ).drop("repeated_id")
