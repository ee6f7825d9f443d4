"""Table schemas and their enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


COMMENTS = _columns(
    author=T.StringType(),
    body=T.StringType(),
    created_utc=T.StringType(),
    subreddit=T.StringType(),
)

TOPIC_MAP = _columns(subreddit=T.StringType(), topics=T.StringType())

COMMENT_TOKENS = _columns(
    id=T.StringType(),
    topic=T.StringType(),
    word=T.StringType(),
    date=T.StringType(),
)

WORD_STATISTICS = _columns(
    id=T.StringType(),
    topic=T.StringType(),
    word=T.StringType(),
    date=T.StringType(),
    daily_word_frequency_in_topic=T.LongType(),
    daily_word_frequency=T.LongType(),
    total_daily_word_count=T.LongType(),
    topic_daily_word_count=T.LongType(),
    rate=T.DoubleType(),
    rate_in_topic=T.DoubleType(),
    topic_specificity=T.DoubleType(),
    five_day_average_of_rate_in_topic=T.DoubleType(),
    change_in_average_of_rate_in_topic=T.DoubleType(),
)

AUDIT = _columns(
    run_id=T.StringType(),
    min_date=T.StringType(),
    max_date=T.StringType(),
    rows=T.LongType(),
    processed_at=T.TimestampType(),
)

LISTING = _columns(
    key=T.StringType(), last_modified=T.TimestampType(), size=T.LongType()
)


def enforce_schema(
    df: DataFrame, schema: T.StructType, distinct: bool = True
) -> DataFrame:
    """Select and cast the columns of a schema, in its order.

    ``distinct`` also removes repeated rows. It costs a shuffle of the whole
    frame, so pass False for frames that are unique by construction.
    """
    out = df.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema)
    )
    return out.distinct() if distinct else out


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    )
