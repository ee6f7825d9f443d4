"""Operator 7: near copies among embeddings, by iterative quantisation.

A rotation is learned from a bounded sample so that the signs of the rotated
coordinates are balanced and lose little (iterative quantisation). All vectors
are coded by it. Codes are cut into four substrings, each the key of a Hamming
table; a vector looks up its substrings and those one bit away, so every pair of
codes within seven bits meets. What meets is compared by cosine of the original
vectors in double precision.

Equal vectors form one class, compared once and counted by its size. A pair is
tested in the first table where it meets, so pairs need not be made distinct.
Vectors of buckets of up to ``LARGE_BUCKET`` meet as pairs, at most so many for
each of a vector's 17 keys in a table; larger buckets and what is within one bit
of them are compared in tiles, which give out counts and components only.

Defined cases: vectors that are NULL, zero or hold NULL or non-finite numbers,
and NULL labels, link with nothing; rows with a NULL vec_id link with nothing
either, have no component_id and are kept; vectors of different lengths do not
link; rows that share a vec_id are one vector each, and a link between them
changes n_links only; extra columns are ignored; an empty table gives an empty
one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow.llm.components import components
from termflow.llm.storage import stored
from termflow.llm.token_blocks import arrow_schema
from termflow.llm.vector_tiles import (
    BUCKET,
    cosine_at_least,
    large_buckets,
    partners_of,
    tile_counts,
)
from termflow.llm.vectors import matrix
from termflow.operators.broadcasts import broadcast_if_small, join_totals

LEAST_COSINE = 0.98
BITS = 64
TABLES = 4
SUBSTRING = BITS // TABLES
#: Vectors the rotation is learned from, chosen by a hash, and their bytes.
SAMPLE = 20_000
SAMPLE_BYTES = 64 << 20
ROUNDS = 40
#: Buckets up to this size are compared pair by pair.
LARGE_BUCKET = 256
#: A key itself and the keys one bit away.
FLIPS = [0, *(1 << k for k in range(SUBSTRING))]


def classes_of(vectors: DataFrame) -> DataFrame:
    """Distinct usable vectors: class_id, least (vec_id), n, label, vector.

    Two of them may have one vec_id, so class_id is a number of its own; it is
    fixed only once the rows are stored.
    """
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    square = F.aggregate(numbers, F.lit(0.0), lambda total, x: total + x * x)
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return (
        vectors.where(
            F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite
        )
        .where((square > 0) & (square < float("inf")))
        .groupBy("label", F.col("embedding").alias("vector"))
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumn("class_id", F.monotonically_increasing_id())
    )


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def learn_rotation(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): signs of (x - mean) @ projection are the code."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    reduced = axes[:BITS].T
    # With fewer dimensions than bits, codes are that much shorter.
    projected = centred @ reduced
    random = np.random.default_rng(7).normal(size=(projected.shape[1],) * 2)
    rotation, _ = np.linalg.qr(random)
    for _ in range(ROUNDS):
        signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ projected)
        rotation = (left @ right).T
    return mean, reduced @ rotation


def fit(classes: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A rotation for every vector length in the sample."""
    longest = classes.agg(F.max(F.size("vector")).alias("n")).first()["n"] or 1
    rows = (
        classes.select("least", "label", "vector")
        .orderBy(F.xxhash64("least"), "least", "label", "vector")
        .limit(max(1, min(SAMPLE, SAMPLE_BYTES // (8 * longest))))
        .select("vector")
        .toArrow()
    )
    by_length: dict[int, list] = {}
    for row in rows["vector"]:
        by_length.setdefault(len(row), []).append(row.values.to_numpy())
    return {
        length: learn_rotation(unit(np.array(found, float)))
        for length, found in by_length.items()
    }


def coded(classes: DataFrame, rotations: dict) -> DataFrame:
    """class_id, label, length and the code as substrings s0, s1, ..."""
    names = [f"s{k}" for k in range(TABLES)]
    out = "class_id bigint, label bigint, length int, " + ", ".join(
        f"{name} int" for name in names
    )
    schema = arrow_schema(out)
    weights = 1 << np.arange(SUBSTRING)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch["vector"]
            lengths = found.value_lengths().to_numpy()
            bits = np.zeros((len(found), BITS), np.int64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                x = unit(matrix(found.take(pa.array(at)), length).astype(float))
                mean, projection = rotations.get(length, (0.0, np.eye(length)))
                values = ((x - mean) @ projection)[:, :BITS]
                bits[at, : values.shape[1]] = values >= 0
            parts = bits.reshape(len(found), TABLES, SUBSTRING) @ weights
            yield pa.RecordBatch.from_arrays(
                [
                    batch["class_id"],
                    batch["label"].cast(pa.int64()),
                    pa.array(lengths, pa.int32()),
                    *(pa.array(parts[:, j], pa.int32()) for j in range(TABLES)),
                ],
                schema=schema,
            )

    return classes.select("class_id", "label", "vector").mapInArrow(code, out)


def in_buckets(codes: DataFrame) -> DataFrame:
    """A row for each class and table: the bucket columns, class_id, code."""
    code = F.array(*(f"s{k}" for k in range(TABLES)))
    tables = [
        codes.select(
            "label",
            "length",
            F.lit(j).alias("table"),
            F.col(f"s{j}").alias("key"),
            "class_id",
            code.alias("code"),
        )
        for j in range(TABLES)
    ]
    return reduce(DataFrame.unionByName, tables)


def meeting_pairs(placed: DataFrame) -> DataFrame:
    """Pairs a < b of classes that meet in buckets, each once."""

    def side(name: str) -> DataFrame:
        return placed.select(
            *BUCKET,
            F.col("class_id").alias(name),
            F.col("code").alias(f"{name}_code"),
        )

    flips = F.array(*map(F.lit, FLIPS))
    looking = side("b").withColumn("flip", F.explode(flips)).withColumn(
        "key", F.col("key").bitwiseXOR(F.col("flip"))
    )

    def met_at(j: int) -> Column:
        apart = F.get("a_code", F.lit(j)).bitwiseXOR(F.get("b_code", F.lit(j)))
        return F.bit_count(apart) <= 1

    earlier = [met_at(j) & (F.col("table") > j) for j in range(TABLES - 1)]
    return (
        side("a")
        .join(looking.drop("flip"), BUCKET)
        .where(F.col("a") < F.col("b"))
        .where(~reduce(lambda x, y: x | y, earlier))
        .select("a", "b")
    )


def linked(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose vectors have the least cosine or more."""
    for side in "ab":
        pairs = pairs.join(
            classes.select(
                F.col("class_id").alias(side), F.col("vector").alias(f"{side}_vector")
            ),
            side,
        )
    out = "a bigint, b bigint"
    schema = arrow_schema(out)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch["a_vector"], batch["b_vector"]
            lengths = a.value_lengths().to_numpy()
            keep = np.zeros(len(a), bool)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                x, y = (
                    matrix(v.take(pa.array(at)), length).astype(float) for v in (a, b)
                )
                keep[at] = cosine_at_least(x, y, LEAST_COSINE)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch["a"].filter(mask), batch["b"].filter(mask)], schema=schema
            )

    return pairs.select("a", "b", "a_vector", "b_vector").mapInArrow(compare, out)


def counted_links(codes: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(class_id, n of the rows each links with), (a, b of the components)."""
    placed = in_buckets(codes)
    buckets = stored(placed.groupBy(*BUCKET).agg(F.count("*").alias("size")), "buckets")
    large = large_buckets(buckets, LARGE_BUCKET)
    gone = broadcast_if_small(large.drop("size"))
    pairs = meeting_pairs(placed.join(gone, BUCKET, "left_anti"))
    links = stored(linked(pairs, classes), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("class_id").alias("b"), "n")
    counts = both.join(sizes, "b").select(F.col("a").alias("class_id"), "n")
    if large.isEmpty():
        return counts, links
    flips = F.array(*map(F.lit, FLIPS))
    partners = stored(partners_of(buckets, large, flips), "partners")
    is_large = broadcast_if_small(large.select(*BUCKET, F.lit(True).alias("large")))
    marked = placed.join(is_large, BUCKET, "left").withColumn(
        "large", F.coalesce("large", F.lit(False))
    )
    told = stored(tile_counts(marked, partners, classes, LEAST_COSINE), "told")
    return (
        counts.unionByName(told.select(F.col("node").alias("class_id"), "n")),
        links.unionByName(
            told.where("node != other").select(
                F.col("node").alias("a"), F.col("other").alias("b")
            )
        ),
    )


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    classes = stored(classes_of(vectors), "classes")
    codes = stored(coded(classes, fit(classes)), "codes")
    counts, links = counted_links(codes, classes)
    others = counts.groupBy("class_id").agg(F.sum("n").alias("others"))
    found = components(links).withColumnRenamed("node", "class_id")
    linked_rows = stored(
        classes.join(others, "class_id", "left")
        .join(found, "class_id", "left")
        .select(
            "label",
            "vector",
            "least",
            (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            "component",
        ),
        "links",
    )
    in_one = linked_rows.where("component IS NOT NULL")
    names = stored(in_one.groupBy("component").agg(F.min("least").alias("name")), "names")
    per_class = (
        join_totals(in_one, names, ["component"])
        .unionByName(
            linked_rows.where("component IS NULL").withColumn("name", F.col("least"))
        )
        .select("label", "vector", "n_links", F.col("name").alias("component"))
    )
    named = F.col("vec_id").isNotNull()
    component = F.when(named, F.coalesce("component", "vec_id"))
    return (
        vectors.select("vec_id", "label", F.col("embedding").alias("vector"))
        .join(per_class, ["label", "vector"], "left")
        .select(
            "vec_id",
            F.when(named, F.coalesce("n_links", F.lit(0)))
            .otherwise(F.lit(0))
            .alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )


def near_vectors_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: links and components of all embeddings."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
