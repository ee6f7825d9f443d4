"""Rates, their rolling mean and its change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROLLING_ROWS = 5

RATE = "rate_in_topic"
AVERAGE = "five_day_average_of_rate_in_topic"
CHANGE = "change_in_average_of_rate_in_topic"


def series() -> Window:
    """A (topic, word) series in day order: at most one row per day.

    The word comes first, for a sort decides most by the start of its first key.
    """
    return Window.partitionBy("word", "topic").orderBy("date")


def add_rates_and_specificity(df: DataFrame) -> DataFrame:
    """Share of the word overall and in the topic, and the ratio of the two."""
    return (
        df.withColumn(
            "rate",
            F.col("daily_word_frequency") / F.col("total_daily_word_count"),
        )
        .withColumn(
            RATE,
            F.col("daily_word_frequency_in_topic")
            / F.col("topic_daily_word_count"),
        )
        .withColumn("topic_specificity", F.col(RATE) / F.col("rate"))
    )


def rolling_average(value: str = RATE) -> Column:
    """Mean over this and the four previous rows of the series.

    Rows, not calendar days: a day without the word is skipped.
    """
    return F.avg(value).over(series().rowsBetween(1 - ROLLING_ROWS, 0))


def add_five_row_average(df: DataFrame) -> DataFrame:
    return df.withColumn(AVERAGE, rolling_average())


def add_change_in_average(df: DataFrame) -> DataFrame:
    """Mean minus the mean of the previous row; NULL on the first."""
    return df.withColumn(
        CHANGE, F.col(AVERAGE) - F.lag(AVERAGE).over(series())
    )


def add_five_calendar_day_average(
    df: DataFrame, new_col: str = "five_calendar_day_average_of_rate_in_topic"
) -> DataFrame:
    """Mean over the rows of the last five calendar days."""
    days = (
        Window.partitionBy("word", "topic")
        .orderBy(F.unix_date(F.col("date").cast("date")))
        .rangeBetween(1 - ROLLING_ROWS, 0)
    )
    return df.withColumn(new_col, F.avg(RATE).over(days))


def add_statistics_id(df: DataFrame) -> DataFrame:
    """``topic_date_word``; unique, as neither date nor word holds ``_``."""
    return df.withColumn(
        "id", F.concat("topic", F.lit("_"), "date", F.lit("_"), "word")
    )
