"""Operator 12: product quantisation with memoised grid cells.

Vectors are cut into equal parts, and each part becomes the index of the nearest
entry of its position's codebook. A part's numbers, divided by the cell width,
name a cell of a coarse grid. For a cell the entries are found once that can be
nearest to any point in its box: an entry is dominated if its least distance to
the box is over the greatest distance of some other entry. Tasks remember these
entries by cell; only they are evaluated exactly, so codes, ties included, are
those of a full search. What a task remembers is bounded and then begun anew.

All numbers are whole, so codebooks do not depend on how rows are spread: each
round sums the parts of every entry in the tasks and brings one number for each
codebook component to the driver (positions x entries x components of a part).

Defined cases: rows that ``whole_vectors`` leaves out have no code; with fewer
vectors than entries, codebooks are that much smaller; rows with one vec_id are
vectors of their own, ordered by their numbers where codebooks start; extra
columns are ignored; an empty table gives an empty one. Sums of errors that fit
no long are NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow.llm.storage import stored
from termflow.llm.token_blocks import arrow_schema
from termflow.llm.vectors import matrix, whole_vectors
from termflow.operators.broadcasts import broadcast_if_small

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Up to here, squared distances of 64 components fit a long.
MOST = float(1 << 19)
CELL = 32
#: Cells a task remembers for a position; cells worked on together.
REMEMBERED = 1 << 16
TOGETHER = 1 << 12


def not_dominated(cells: np.ndarray, book: np.ndarray) -> np.ndarray:
    """For each cell, which entries can be nearest to a point of its box."""
    low = (cells * CELL)[:, None, :]
    high = low + (CELL - 1)
    outside = np.maximum(low - book, 0) + np.maximum(book - high, 0)
    across = np.maximum(np.abs(book - low), np.abs(book - high))
    least, greatest = (outside**2).sum(axis=2), (across**2).sum(axis=2)
    return least <= greatest.min(axis=1, keepdims=True)


class CellMemo:
    """Entries worth evaluating, by cell, for the codebook of one position."""

    def __init__(self, book: np.ndarray):
        self.book = book
        self.known: dict[bytes, int] = {}
        self.masks = np.zeros((0, len(book)), bool)

    def candidates(self, points: np.ndarray) -> np.ndarray:
        """A mask of entries for every point."""
        cells = np.ascontiguousarray(points // CELL)
        names = cells.view(f"V{cells.shape[1] * cells.itemsize}")[:, 0]
        _, first, of_point = np.unique(names, return_index=True, return_inverse=True)
        if len(self.known) + len(first) > REMEMBERED:
            self.known, self.masks = {}, self.masks[:0]
        keys = [names[at].tobytes() for at in first]
        new = [k for k, key in enumerate(keys) if key not in self.known]
        found = [self.masks]
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            found.append(not_dominated(cells[first[some]], self.book))
        base = len(self.masks)
        self.masks = np.concatenate(found)
        self.known.update((keys[k], base + nth) for nth, k in enumerate(new))
        return self.masks[[self.known[key] for key in keys]][of_point]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lower of equal ones, and the square."""
        point, entry = np.nonzero(self.candidates(points))
        apart = ((points[point] - self.book[entry]) ** 2).sum(axis=1)
        starts = np.flatnonzero(np.diff(point, prepend=-1))
        least = np.minimum.reduceat(apart, starts)
        best = np.flatnonzero(apart == least[point])
        _, lowest = np.unique(point[best], return_index=True)
        return entry[best[lowest]], least


class Coder:
    """Codes of batches, with a memo for each position."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.memos = [CellMemo(book) for book in books]

    def code(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parts (row, position, component), entries and squares."""
        positions, _, wide = self.books.shape
        x = matrix(batch["x"], positions * wide).reshape(-1, positions, wide)
        found = [
            memo.nearest(np.ascontiguousarray(x[:, p]))
            for p, memo in enumerate(self.memos)
        ]
        return x, *(np.stack(column, axis=1) for column in zip(*found))


def first_books(vectors: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Codebooks (position, entry, component) from the least vec_ids."""
    rows = vectors.select("vec_id", "x").orderBy("vec_id", "x").limit(entries)
    x = np.array([row["x"] for row in rows.collect()], np.int64)
    return x.reshape(len(x), parts, x.size // max(len(x) * parts, 1)).swapaxes(0, 1)


def next_books(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries replaced by the floor of the mean of the parts nearest to them.

    Tasks send sums of components and, as component -1, counts.
    """
    out = "position int, entry int, component int, total decimal(38,0)"
    schema = arrow_schema(out)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, positions = Coder(books), np.arange(books.shape[0])
        totals = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                x, entry, _ = coder.code(batch)
                np.add.at(totals[:, :, 1:], (positions, entry), x)
                np.add.at(totals[:, :, 0], (positions, entry), 1)
        at = np.nonzero(totals[:, :, 0])
        places = [(p, e, c) for p, e in zip(*at) for c in range(totals.shape[2])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _, _ in places], pa.int32()),
                pa.array([e for _, e, _ in places], pa.int32()),
                pa.array([c - 1 for _, _, c in places], pa.int32()),
                pa.array([Decimal(int(totals[x])) for x in places], schema[3].type),
            ],
            schema=schema,
        )

    sums = {
        (row["position"], row["entry"], row["component"]): int(row["total"])
        for row in vectors.select("x")
        .mapInArrow(add, out)
        .groupBy("position", "entry", "component")
        .agg(F.sum("total").alias("total"))
        .collect()
    }
    made = books.copy()
    for (p, e, c), total in sums.items():
        if c >= 0:
            made[p, e, c] = total // sums[p, e, -1]
    return made


def grid_codes(
    embeddings: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes, error) of each vector, and the codebooks.

    ``codes`` are the bytes of the indexes in part order; 256 entries at most.
    """
    vectors = stored(
        whole_vectors(embeddings, scale, 0, MOST, parts), "whole-vectors"
    )
    books = first_books(vectors, parts, entries)
    if books.size:
        for _ in range(rounds):
            books = next_books(vectors, books)
    out = f"vec_id bigint, label {vectors.schema['label'].dataType.simpleString()}"
    out += ", codes binary, error bigint"
    schema = arrow_schema(out)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        for batch in batches:
            if batch.num_rows:
                _, entry, square = coder.code(batch)
                codes = [row.tobytes() for row in entry.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["vec_id"].cast(pa.int64()),
                        batch["label"],
                        pa.array(codes, pa.binary()),
                        pa.array(square.sum(axis=1)),
                    ],
                    schema=schema,
                )

    return vectors.mapInArrow(encode, out), books


def grid_codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: codes of all embeddings, errors by vector and by label."""
    found, books = grid_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    found = stored(found, "codes")
    numbers = ",".join(map(str, books.reshape(-1).tolist()))
    by_label = broadcast_if_small(
        found.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    ).withColumnRenamed("label", "of")
    return found.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id",
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )
