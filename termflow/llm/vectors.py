"""Vectors of whole numbers from a table of embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_vectors(
    vectors: DataFrame, scale: int, offset: int, most: float, multiple: int = 1
) -> DataFrame:
    """vec_id, label, x: each component as floor(scale * component) + offset.

    Rows are left out whose vector is NULL or holds NULL or non-finite
    components, or components beyond ``most``, with which exact sums would not
    fit. So are vectors whose length is no multiple of ``multiple`` or is not
    the most common one (of equally common ones the least).
    """
    numbers = vectors.select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("v")
    ).where(
        F.forall(
            "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(most))
        )
    )
    size = F.size("v")
    numbers = numbers.where((size > 0) & (size % multiple == 0))
    common = (
        numbers.groupBy(size.alias("size"))
        .count()
        .orderBy(F.desc("count"), "size")
        .first()
    )
    whole = F.transform(
        "v", lambda c: F.floor(c * scale).cast("bigint") + F.lit(offset)
    )
    return numbers.where(size == F.lit(common["size"] if common else 0)).select(
        "vec_id", "label", whole.alias("x")
    )


def matrix(column, width: int):
    """The rows of an Arrow list column as a two-dimensional array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
