"""Checks on a listing of files: (key, last_modified, size)."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from datetime import datetime
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from termflow.functions.paths import partition_value

PERCENTS = (10, 25, 50, 75, 90)

# Leading bits by which the first pass tells sizes apart, and bits by which each
# further pass narrows a range down: both bound the rows of a window.
LEADING_BITS = 11
FURTHER_BITS = 21


def freshness_counts(
    listing: DataFrame, start: datetime | str | None = None
) -> DataFrame:
    """``num_old_keys`` modified before ``start``, and ``num_new_keys``.

    Without a start every key is new.
    """
    old = F.lit(False)
    if start is not None:
        kind = listing.schema["last_modified"].dataType
        bound = F.lit(str(start)).cast(kind)
        old = F.coalesce(F.col("last_modified") < bound, F.lit(False))
    return listing.agg(
        F.count_if(old).alias("num_old_keys"),
        F.count_if(~old).alias("num_new_keys"),
    )


def size_percentiles(
    listing: DataFrame, percents: Sequence[int] = PERCENTS
) -> DataFrame:
    """Minimum, exact percentiles and maximum of ``size``, in one row.

    Percentile ``p`` of ``n`` sizes is the one at index ``int(p / 100.0 * n)``
    of the sorted sizes. No sort over all rows: the first pass counts rows by
    the leading bits of their size, which makes ranges as wide as their sizes are
    large, and the next by what is left in the ranges that hold an index. That is
    all for sizes below 2^32; further passes narrow larger ones. The passes run
    at once. What is counted and windowed is bounded by the number of ranges; the
    driver gets those of the first pass and a row per wanted size of each other.
    """
    sizes = listing.select(F.col("size").cast("bigint").alias("size")).where(
        F.col("size").isNotNull()
    )
    names = ["size_min", *(f"p{p}" for p in percents), "size_max"]
    shares = [0.0, *(p / 100.0 for p in percents)]
    size = F.col("size")
    # Of negative sizes the bits that differ from the sign count.
    bits = F.length(F.bin(size.bitwiseXOR(F.shiftright(size, 63))))
    shift = F.greatest(bits - LEADING_BITS, F.lit(0))
    # At most 64 * 2^(LEADING_BITS - 1) ranges.
    ranges = (
        _counted(sizes.select(size, F.lit(0).alias("of"), shift.alias("shift")))
        .select("shift", "rows", "least", "most")
        .collect()
    )
    found = _first_ranges(sorted(ranges, key=lambda row: row["least"]), shares)
    while any(row["least"] != row["most"] for row in found):
        found = _narrowed(sizes, found)
    by_place = {row["place"]: row["least"] for row in found}
    return listing.sparkSession.range(1).select(
        *(
            F.lit(by_place.get(place)).cast("bigint").alias(name)
            for place, name in enumerate(names)
        )
    )


def _counted(sizes: DataFrame) -> DataFrame:
    """Rows, least and greatest size of each range of 2^shift sizes.

    ``sizes`` has (size, of, shift).
    """
    return (
        sizes.groupBy("of", "shift", F.expr("shiftright(size, shift)").alias("range"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("size").alias("least"),
            F.max("size").alias("most"),
        )
    )


def _first_ranges(ranges: list[Row], shares: Sequence[float]) -> list[Row]:
    """For each share of all rows, and for the last row, the range it is in.

    ``index`` counts from the range's first row.
    """
    ends = list(accumulate(row["rows"] for row in ranges))
    if not ends:
        return []
    found = []
    for place, index in enumerate([*(int(s * ends[-1]) for s in shares), ends[-1] - 1]):
        at = bisect_right(ends, index)
        row = ranges[at].asDict()
        start = ends[at] - row.pop("rows")
        found.append(Row(place=place, index=index - start, **row))
    return found


def _holding(counted: DataFrame, wanted: DataFrame) -> list[Row]:
    """For each wanted (of, place, index) the range that holds it."""
    upto = (
        Window.partitionBy("of")
        .orderBy("least")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    start = F.col("end") - F.col("rows")
    return (
        counted.withColumn("end", F.sum("rows").over(upto))
        # A row per wanted size, hence the broadcast.
        .join(F.broadcast(wanted), "of")
        .where((F.col("index") >= start) & (F.col("index") < F.col("end")))
        .select(
            "place", (F.col("index") - start).alias("index"), "shift", "least", "most"
        )
        .collect()
    )


def _narrowed(sizes: DataFrame, found: list[Row]) -> list[Row]:
    """The same indexes in ranges that are narrower by ``FURTHER_BITS``."""
    done = [row for row in found if row["least"] == row["most"]]
    open_rows = [row for row in found if row["least"] != row["most"]]
    wide = sorted({(r["least"], r["most"], r["shift"]) for r in open_rows})
    number = {least: k for k, (least, _, _) in enumerate(wide)}
    of, shift = F.lit(None), F.lit(None)
    for least, most, bits in wide:
        within = F.col("size").between(least, most)
        of = F.when(within, number[least]).otherwise(of)
        shift = F.when(within, max(bits - FURTHER_BITS, 0)).otherwise(shift)
    ranged = sizes.select("size", of.alias("of"), shift.alias("shift"))
    wanted = sizes.sparkSession.createDataFrame(
        [(number[r["least"]], r["place"], r["index"]) for r in open_rows],
        "of int, place int, index bigint",
    )
    counted = _counted(ranged.where(F.col("of").isNotNull()))
    return done + _holding(counted, wanted)


def add_id_group(listing: DataFrame, strict: bool = False) -> DataFrame:
    return listing.withColumn(
        "id_group", partition_value(F.col("key"), strict)
    )


def latest_key_per_group(
    listing: DataFrame, strict: bool = False
) -> DataFrame:
    """Last key, in key order, of every partition group."""
    return (
        listing.transform(add_id_group, strict)
        .where(F.col("id_group").isNotNull())
        .groupBy("id_group")
        .agg(F.max("key").alias("key"))
    )
