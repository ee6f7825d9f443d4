"""Rising, topic-specific words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termflow.operators.rates import CHANGE


def trending_terms(
    statistics: DataFrame,
    min_specificity: float,
    k: int,
    date: str | None = None,
) -> DataFrame:
    """Top ``k`` words per topic and day by rise of the rolling mean.

    Only words at least ``min_specificity`` specific that rose; ties go by
    word. Spark keeps ``k`` rows per group in each task before the shuffle.
    """
    if date is not None:
        statistics = statistics.where(F.col("date") == date)
    ranked = Window.partitionBy("topic", "date").orderBy(
        F.col(CHANGE).desc(), "word"
    )
    return (
        statistics.where(
            (F.col("topic_specificity") >= min_specificity)
            & (F.col(CHANGE) > 0)
        )
        .withColumn("place", F.row_number().over(ranked))
        .where(F.col("place") <= k)
    )
