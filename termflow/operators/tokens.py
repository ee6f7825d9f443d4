"""From comment bodies to unique words per comment and topic."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from termflow.functions.names import topic_parts
from termflow.functions.text import (
    STOP_WORDS,
    distinct_words,
    has_letter,
    whitespace_tokens,
    without_stop_words,
)


def tokenize(df: DataFrame) -> DataFrame:
    """``body`` becomes ``words_token``, its lower-case whitespace tokens."""
    return df.withColumn("words_token", whitespace_tokens(F.col("body"))).drop(
        "body"
    )


def remove_stop_words(
    df: DataFrame, stop_words: Iterable[str] = STOP_WORDS
) -> DataFrame:
    """``words_token`` becomes ``words_no_stops``.

    Punctuation is still attached here: ``don't`` goes, ``the,`` stays and
    turns into the word ``the`` later on.
    """
    return df.withColumn(
        "words_no_stops", without_stop_words(F.col("words_token"), stop_words)
    ).drop("words_token")


def explode_words(df: DataFrame) -> DataFrame:
    """One row per distinct ``word`` of each row's ``words_no_stops``.

    Words are unique per input row only; ``split_words`` is the step that is
    unique over the frame.
    """
    kept = [name for name in df.columns if name != "words_no_stops"]
    return df.select(
        *kept, F.explode(distinct_words(F.col("words_no_stops"))).alias("word")
    ).where(has_letter(F.col("word")))


def split_words(df: DataFrame) -> DataFrame:
    """Distinct (id, topics, word, date): a word counts once per comment."""
    return explode_words(df).select("id", "topics", "word", "date").distinct()


def add_words(
    df: DataFrame, stop_words: Iterable[str] = STOP_WORDS
) -> DataFrame:
    """Tokenise, drop stop words and split into distinct words."""
    return (
        df.transform(tokenize)
        .transform(remove_stop_words, stop_words)
        .transform(split_words)
    )


def split_topic_lists(
    topic_map: DataFrame, drop_empty: bool = False
) -> DataFrame:
    """Turn the comma-separated ``topics`` into an array of clean topics.

    Done on the map, the work is per community instead of per word.
    """
    return topic_map.withColumn(
        "topics", topic_parts(F.col("topics"), drop_empty)
    )


def explode_topics(df: DataFrame, drop_empty: bool = False) -> DataFrame:
    """One row per ``topic`` of ``topics``, trimmed and in lower case.

    ``topics`` is a comma-separated string or an array of clean topics. In a
    string a repeated topic gives repeated rows and an empty part gives the
    empty topic, unless ``drop_empty``; NULL topics give no row.
    """
    kept = [name for name in df.columns if name != "topics"]
    if isinstance(df.schema["topics"].dataType, ArrayType):
        return df.select(*kept, F.explode("topics").alias("topic"))
    parts = F.explode(F.split("topics", ",")).alias("topic")
    out = df.select(*kept, parts).withColumn("topic", F.trim(F.lower("topic")))
    return out.where(F.col("topic") != "") if drop_empty else out
