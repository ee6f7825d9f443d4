"""Operator 8: best-fit decreasing packing of documents into sequences.

Documents become pieces of at most ``SEQUENCE`` ids; only longer ones are cut.
Pieces of one length are interchangeable, and so are open bins with the same
room left. So best-fit decreasing runs on counts: a segment tree over the
remaining capacities finds the tightest open bins for a length in logarithmic
time, and takes as many of them as it has pieces. Its input is a histogram of
at most ``SEQUENCE`` rows, its output a table of runs (length, ranks) to
(sequences, offset) of a size that depends on ``SEQUENCE`` and not on the number
of documents. Pieces are ranked within their length where they are, and look up
their run.

Defined cases: NULL and empty texts hold the end id only; repeated rows are
packed each; further columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termflow.llm.storage import documents, stored
from termflow.llm.token_blocks import arrow_schema
from termflow.llm.vocabulary import (
    WORD_BPE,
    WordBpe,
    loaded,
    vocabulary_path,
)

SEQUENCE = 2048
END_ID = 0

PIECES = (
    "part int, nth bigint, doc_id bigint, piece int, start bigint, "
    "length bigint, ids_crc32 bigint"
)


def cut_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    size: int = SEQUENCE,
) -> DataFrame:
    """A row per piece; ``nth`` counts pieces of its length in its task."""
    vocabulary = vocabulary or vocabulary_path(WORD_BPE)
    schema = arrow_schema(PIECES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(WordBpe, vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        seen = [0] * (size + 1)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encoder.encode(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    own = ids[at : at + 4 * size]
                    length = len(own) // 4
                    row = (
                        part,
                        seen[length],
                        doc_id.as_py(),
                        piece,
                        at // 4,
                        length,
                        zlib.crc32(own),
                    )
                    rows.append(row)
                    seen[length] += 1
            columns = zip(*rows) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column, field.type)
                    for column, field in zip(columns, schema)
                ],
                schema=schema,
            )

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


class OpenBins:
    """Open bins by remaining capacity, under a segment tree."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [False] * (2 * self.leaves)
        self.runs = [deque() for _ in range(size + 1)]

    def _set(self, capacity: int, value: bool) -> None:
        node = capacity + self.leaves
        self.open[node] = value
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def add(self, capacity: int, first: int, count: int) -> None:
        if capacity and count:
            self.runs[capacity].append((first, count))
            self._set(capacity, True)

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        """Up to ``most`` bins of the oldest run: (first, count)."""
        first, count = self.runs[capacity].popleft()
        if count > most:
            self.runs[capacity].appendleft((first + most, count - most))
            count = most
        if not self.runs[capacity]:
            self._set(capacity, False)
        return first, count

    def tightest(self, length: int) -> int | None:
        """The least capacity of an open bin that holds ``length``."""
        node = length + self.leaves
        while not self.open[node]:
            while node & 1:  # a right child: nothing further below its parent
                node //= 2
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node + (not self.open[2 * node])
        return node - self.leaves


def best_fit_decreasing(
    histogram: dict[int, int], size: int = SEQUENCE
) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, pieces per bin, first sequence, offset).

    A run holds the ranks up to the next run of its length.
    """
    bins, runs, sequences = OpenBins(size), [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            capacity = bins.tightest(length)
            room = capacity or size
            # A bin stays the tightest one until the length fits no more.
            each = min(room // length, left)
            wanted = left // each
            if capacity is None:
                first, count = sequences, wanted
                sequences += wanted
            else:
                first, count = bins.take(capacity, wanted)
            runs.append((length, rank, each, first, size - room))
            bins.add(room - each * length, first, count)
            rank += each * count
            left -= each * count
    return runs


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Add sequence_id and offset to pieces (part, nth, length, ...)."""
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {
        row["length"]: row["n"]
        for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    runs = np.array(
        best_fit_decreasing(histogram, size) or np.zeros((0, 5)), np.int64
    )
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    earlier = (
        Window.partitionBy("length")
        .orderBy("part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = counts.select(
        "part",
        "length",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    ranked = pieces.join(before, ["part", "length"]).withColumn(
        "rank", F.col("before") + F.col("nth")
    )
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    out = (
        "doc_id bigint, piece int, start bigint, length bigint, "
        "ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
    schema = arrow_schema(out)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = runs[:, 0] << 48 | runs[:, 1]
        for batch in batches:
            length = batch["length"].to_numpy()
            rank = batch["rank"].to_numpy()
            run = runs[np.searchsorted(keys, length << 48 | rank, "right") - 1]
            nth = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[name] for name in kept[:-1]),
                    pa.array(run[:, 3] + nth // run[:, 2]),
                    pa.array(run[:, 4] + nth % run[:, 2] * length),
                ],
                schema=schema,
            )

    return ranked.select(*kept).mapInArrow(place, out)


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    The pieces are stored first: ranks need them twice, from the same tasks.
    """
    return pack(
        stored(cut_documents(docs, **options), "pieces"),
        options.get("size", SEQUENCE),
    )


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: pack all documents."""
    return pack_documents(documents(spark, sf_dir))
