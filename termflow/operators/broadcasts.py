"""Joins behind a measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
#: Tasks over which a salted join spreads the rows of one key.
SALTS = 32


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows take; one number reaches the driver."""
    row_bytes = sum(
        (
            F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
            for name in df.columns
        ),
        F.lit(16 * len(df.columns)),
    )
    return df.select(F.sum(row_bytes).alias("bytes")).first()["bytes"] or 0


def broadcast_if_small(
    df: DataFrame,
    max_bytes: int = BROADCAST_BYTES,
    known_bytes: int | None = None,
) -> DataFrame:
    """``df`` with a broadcast hint if its rows take at most ``max_bytes``.

    Without ``known_bytes`` they are measured, by an aggregate that runs at once;
    so not for frames that are costly to compute. A larger ``df`` is returned
    without a hint: the join then shuffles, and AQE splits partitions of hot keys.
    """
    if max_bytes <= 0:
        return df
    size = measured_bytes(df) if known_bytes is None else known_bytes
    return F.broadcast(df) if size <= max_bytes else df


def join_totals(
    rows: DataFrame,
    totals: DataFrame,
    keys: Sequence[str],
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``rows`` with the row of ``totals`` of their keys; no key has two.

    The totals, which should be cheap to read, are measured and broadcast, so
    that ``rows`` stay where they are. If they are larger than ``max_bytes``,
    each total goes to ``SALTS`` tasks, and the rows of a key are spread over
    these by a hash of all their columns. Rows with a NULL key go.
    """
    if measured_bytes(totals) <= max_bytes:
        return rows.join(F.broadcast(totals), [*keys])
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return (
        rows.withColumn("_salt", spread)
        .join(totals.withColumn("_salt", copies), [*keys, "_salt"])
        .drop("_salt")
    )
