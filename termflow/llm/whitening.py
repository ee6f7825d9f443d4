"""Operator 13: whitened embeddings by spectrum slicing of their covariance.

1. Tasks sum the whole numbers of each dimension; then, centred on the rounded
   mean, the products of each two dimensions. Both are exact, so the covariance
   is rounded once and does not depend on how rows are spread. What reaches the
   driver is one number for each pair of dimensions.
2. Each leading eigenpair is found in a task of its own (``spectrum``); those
   whose eigenvalues lie close get one basis.
3. Rows are centred, projected and divided by the root of the eigenvalue, and
   the covariance of what came out is summed again and compared with 1.

Defined cases: rows that ``whole_vectors`` leaves out are neither fitted nor
returned; eigenvalues that rounding cannot tell from zero (fewer rows than
components, dimensions that depend on others, one row) have no component; rows
with one vec_id are vectors of their own; deviations that fit no long are NULL;
extra columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow.llm.spectrum import EPS, eigenpair, with_clusters
from termflow.llm.storage import stored
from termflow.llm.token_blocks import arrow_schema
from termflow.llm.vectors import matrix, whole_vectors

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Up to here, sums of products over 2^30 rows fit a decimal of 38 digits.
MOST = float(1 << 40)
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """What maps vectors to components; ``explained`` are shares of the trace."""

    n: int
    sums: list[int]
    axes: np.ndarray
    explained: list[float]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n; near whole numbers are subtracted as such."""
        near = np.array(nearest_means(self.n, self.sums), np.int64)
        rest = [float(Fraction(s, self.n) - int(m)) for s, m in zip(self.sums, near)]
        return (x - near) - np.array(rest)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - sums)^2, NULL if beyond a long."""
        widest = max(
            (abs(self.n * int(v) - s) for side in (x.min(axis=0), x.max(axis=0))
             for v, s in zip(side, self.sums)), default=0
        )
        if x.shape[1] * widest**2 <= LONG and self.n * int(np.abs(x).max()) <= LONG:
            apart = self.n * x - np.array(self.sums, np.int64)
            return (apart**2).sum(axis=1).tolist()
        apart = self.n * x.astype(object) - np.array(self.sums, object)
        return [v if v <= LONG else None for v in (apart**2).sum(axis=1)]


def nearest_means(n: int, sums: list[int]) -> list[int]:
    return [(2 * s + n) // (2 * n) for s in sums]


def summed(rows: DataFrame, width: int, partial, column: str) -> np.ndarray:
    """Whole numbers of ``partial`` (batch to array), added over all batches."""
    out = "place int, total decimal(38,0)"
    schema = arrow_schema(out)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(matrix(batch[column], width)).astype(object).reshape(-1)
                total = part if total is None else total + part
        values = [] if total is None else [Decimal(int(v)) for v in total]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(values)), pa.int32()), pa.array(values, schema[1].type)],
            schema=schema,
        )

    found = (
        rows.select(column).mapInArrow(add, out).groupBy("place").agg(F.sum("total"))
    )
    return np.array([int(v) for _, v in sorted(map(tuple, found.collect()))], object)


def products(x: np.ndarray) -> np.ndarray:
    """xᵀx of whole numbers, exact."""
    widest = int(np.abs(x).max())
    if widest**2 * len(x) < 1 << 53:
        return (x.astype(float).T @ x.astype(float)).astype(np.int64)
    if widest**2 * len(x) < LONG:
        return x.T @ x
    return x.astype(object).T @ x.astype(object)


def covariance(vectors: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums and the covariance, each entry rounded once."""
    counted = summed(
        vectors,
        width,
        # Sums of a batch in Python's whole numbers: they may pass a long.
        lambda x: np.append(x.astype(object).sum(axis=0), len(x)),
        "x",
    )
    *sums, n = map(int, counted)
    near = np.array(nearest_means(n, sums), np.int64)
    crossed = summed(vectors, width, lambda x: products(x - near), "x")
    rest = [s - n * int(m) for s, m in zip(sums, near)]
    v = np.empty((width, width))
    for i in range(width):
        for j in range(i, width):
            whole = n * int(crossed[i * width + j]) - rest[i] * rest[j]
            v[i, j] = v[j, i] = whole / (n * n)
    return n, sums, v


def leading_pairs(
    spark: SparkSession, v: np.ndarray, components: int
) -> list[tuple[float, np.ndarray]]:
    """Eigenpairs by falling eigenvalue, each found in a task of its own."""
    most = min(components, len(v))
    out = "number bigint, value double, axis array<double>"
    schema = arrow_schema(out)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch["id"].to_pylist()
            pairs = [eigenpair(v, number) for number in numbers]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array([value for value, _ in pairs], pa.float64()),
                    pa.array(
                        [x if x is None else x.tolist() for _, x in pairs],
                        schema[2].type,
                    ),
                ],
                schema=schema,
            )

    rows = spark.range(1, most + 1, numPartitions=most).mapInArrow(find, out).collect()
    rows.sort(key=lambda row: row["number"])
    pairs = [
        (row["value"], None if row["axis"] is None else np.array(row["axis"]))
        for row in rows
    ]
    # An eigenvalue is uncertain by about this; its root must be good to 1e-4.
    least = 1e5 * len(v) * EPS * float(np.linalg.norm(v))
    pairs = [pair for pair in pairs if pair[0] > least]
    return with_clusters(v, pairs)


def fit(vectors: DataFrame, width: int, components: int) -> Whitening:
    n, sums, v = covariance(vectors, width)
    pairs = leading_pairs(vectors.sparkSession, v, components)
    axes = [axis / value**0.5 for value, axis in pairs]
    trace = float(np.trace(v))
    return Whitening(
        n,
        sums,
        np.array(axes).T.reshape(width, len(axes)),
        [value / trace for value, _ in pairs],
    )


def projected(vectors: DataFrame, whitening: Whitening) -> DataFrame:
    """vec_id, deviation and the whitened components of each vector."""
    out = "vec_id bigint, deviation bigint, whitened array<double>"
    schema = arrow_schema(out)
    width, many = whitening.axes.shape

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch["x"], width)
                values = whitening.centred(x) @ whitening.axes
                ends = np.arange(len(x) + 1, dtype=np.int32) * many
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["vec_id"].cast(pa.int64()),
                        pa.array(whitening.deviations(x), pa.int64()),
                        pa.ListArray.from_arrays(ends, values.reshape(-1)).cast(
                            schema[2].type
                        ),
                    ],
                    schema=schema,
                )

    return vectors.select("vec_id", "x").mapInArrow(project, out)


def identity_error(whitened: DataFrame, n: int, components: int) -> float:
    """Largest entry of the covariance of ``whitened`` minus the identity.

    Its rows are centred already: their mean is zero by construction.
    """
    out = "place int, total double"
    schema = arrow_schema(out)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components, components))
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch["whitened"], components)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(components**2), pa.int32()), pa.array(total.reshape(-1))],
            schema=schema,
        )

    sums = (
        whitened.select("whitened").mapInArrow(add, out).groupBy("place")
        .agg(F.sum("total")).collect()
    )
    found = np.array([v for _, v in sorted(map(tuple, sums))])
    apart = found.reshape(components, components) / n - np.eye(components)
    return float(np.abs(apart).max())


def whitened_vectors(
    embeddings: DataFrame, components: int = COMPONENTS
) -> tuple[DataFrame, Whitening | None]:
    """(vec_id, deviation, whitened) of each vector, stored, and the fit."""
    vectors = stored(whole_vectors(embeddings, SCALE, OFFSET, MOST), "whole-vectors")
    first = vectors.select(F.size("x").alias("width")).first()
    if first is None:
        return vectors.selectExpr(
            "vec_id", "0L AS deviation", "CAST(NULL AS array<double>) AS whitened"
        ), None
    whitening = fit(vectors, first["width"], components)
    return stored(projected(vectors, whitening), "whitened"), whitening


def whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: whitened components of all embeddings, a row each."""
    rows, fitted = whitened_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    explained = fitted.explained if fitted else []
    error = identity_error(rows, fitted.n, len(explained)) if explained else 0.0
    return rows.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n if fitted else 0).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.lit(explained or [0.0]), F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
