"""Vectors of large Hamming buckets compared in tiles, without a row per pair.

A block is a large bucket and its partners: all vectors whose key is within one
bit of the bucket's. Members and partners are dealt by hash to tiles, and a task
gets one tile of either. It gives out, for each vector that has links there, how
many rows it links with and a vector of its component, so what moves are the
vectors, each as often as the other side has tiles, and one number for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termflow.llm.token_blocks import arrow_schema
from termflow.llm.vectors import matrix
from termflow.operators.broadcasts import broadcast_if_small

#: Vectors and bytes of vectors in a tile, about.
TILE = 512
TILE_BYTES = 8 << 20
#: Cosines so close to the limit are computed again one by one.
CLOSE = 1e-9

BUCKET = ["label", "length", "table", "key"]
CELL = ["label", "length", "table", "block", "i", "j"]


def cosine_at_least(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Whether x[k] and y[k] have the least cosine, in double precision."""
    dot = (x * y).sum(axis=1)
    scale = np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))
    return dot / scale >= least


def linked_in_tile(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which rows of x have the least cosine with which rows of y."""
    unit_x, unit_y = (
        v / np.sqrt((v * v).sum(axis=1, keepdims=True)) for v in (x, y)
    )
    cosines = unit_x @ unit_y.T
    link = cosines >= least
    a, b = np.nonzero(np.abs(cosines - least) < CLOSE)
    link[a, b] = cosine_at_least(x[a], y[b], least)
    return link


def met_before(x: np.ndarray, y: np.ndarray, table: int) -> np.ndarray:
    """Which codes of x met which of y in a table before this one."""
    met = np.zeros((len(x), len(y)), bool)
    for j in range(table):
        met |= np.bitwise_count(x[:, j][:, None] ^ y[:, j][None, :]) <= 1
    return met


def least_labels(
    link: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each row and column of links, the least id reachable by them."""
    most = np.iinfo(np.int64).max
    a, b = ids_a.copy(), ids_b.copy()
    while True:
        to_b = np.minimum(b, np.where(link, a[:, None], most).min(axis=0))
        to_a = np.minimum(a, np.where(link, to_b[None, :], most).min(axis=1))
        if (to_a == a).all() and (to_b == b).all():
            return a, b
        a, b = to_a, to_b


class Side:
    """Members or partners of one cell."""

    def __init__(self, batch: pa.Table, length: int):
        self.ids = batch["class_id"].to_numpy()
        self.n = batch["n"].to_numpy()
        code = batch["code"].combine_chunks()
        self.code = matrix(code, len(code[0])).astype(np.int64)
        self.large = batch["large"].to_numpy()
        vectors = matrix(batch["vector"].combine_chunks(), length)
        self.vectors = vectors.astype(np.float64)


def compare_cell(cell: pa.Table, least: float) -> list[np.ndarray]:
    """(node, other, n) of the vectors that have links in the cell."""
    length, table = cell["length"][0].as_py(), cell["table"][0].as_py()
    partner = cell["partner"].to_numpy()
    if partner.all() or not partner.any():  # hashing left a tile empty
        return [np.zeros(0, np.int64)] * 3
    members, partners = (
        Side(cell.filter(pa.array(mask)), length) for mask in (~partner, partner)
    )
    link = linked_in_tile(members.vectors, partners.vectors, least)
    itself = members.ids[:, None] == partners.ids[None, :]
    a, b = least_labels(link | itself, members.ids, partners.ids)
    counted = link & ~itself & ~met_before(members.code, partners.code, table)
    of_a = counted @ partners.n
    # Partners in a large bucket are members of its block, and counted there.
    of_b = np.where(partners.large, 0, members.n @ counted)
    ids = np.concatenate([members.ids, partners.ids])
    other, n = np.concatenate([a, b]), np.concatenate([of_a, of_b])
    told = (ids != other) | (n > 0)
    return [ids[told], other[told], n[told]]


def large_buckets(buckets: DataFrame, most: int) -> DataFrame:
    return buckets.where(F.col("size") > most).select(*BUCKET, "size")


def partners_of(buckets: DataFrame, large: DataFrame, flips) -> DataFrame:
    """Each bucket within one bit of a large one, with that one's key as block,
    whether it is large itself, and the numbers of tiles of the block."""
    near = (
        buckets.select(*BUCKET, "size")
        .withColumn("flip", F.explode(flips))
        .withColumn("block", F.col("key").bitwiseXOR(F.col("flip")))
        .drop("flip")
    )
    own = large.withColumnRenamed("key", "block").withColumnRenamed("size", "members")
    near = near.join(broadcast_if_small(own), ["label", "length", "table", "block"])
    sizes = near.groupBy("label", "length", "table", "block").agg(
        F.sum("size").alias("partners")
    )

    def tiles(size: str):
        wide = F.col(size) * F.col("length") * 8
        return F.greatest(
            F.ceil(F.col(size) / TILE), F.ceil(wide / TILE_BYTES), F.lit(1)
        ).cast("int")

    return near.join(sizes, ["label", "length", "table", "block"]).select(
        *BUCKET,
        "block",
        tiles("members").alias("i_tiles"),
        tiles("partners").alias("j_tiles"),
    )


def tile_counts(
    placed: DataFrame, partners: DataFrame, classes: DataFrame, least: float
) -> DataFrame:
    """node, other, n: links of nodes in the blocks, and a node of the component.

    ``placed`` has the bucket columns, class_id, code and large (whether the
    bucket is); ``classes`` the class_id, n and vector.
    """
    met = placed.join(broadcast_if_small(partners), BUCKET)
    hashed = F.xxhash64("class_id")
    own_i = F.pmod(hashed, F.col("i_tiles")).cast("int")
    own_j = F.pmod(hashed, F.col("j_tiles")).cast("int")

    def all_of(tiles: str):
        return F.explode(F.sequence(F.lit(0), F.col(tiles) - 1))

    shared = ["label", "length", "table", "block", "class_id", "code", "large"]
    members = met.where(F.col("key") == F.col("block")).select(
        *shared, F.lit(False).alias("partner"), own_i.alias("i"), all_of("j_tiles").alias("j")
    )
    others = met.select(
        *shared, F.lit(True).alias("partner"), own_j.alias("j"), all_of("i_tiles").alias("i")
    )
    # Vectors join last, when it is known where each has to go.
    dealt = (
        members.unionByName(others)
        .join(classes.select("class_id", "n", "vector"), "class_id")
        .select(*CELL, "partner", "class_id", "code", "large", "n", "vector")
        .repartition(*CELL)
        .sortWithinPartitions(*CELL)
    )
    out = "node bigint, other bigint, n bigint"
    schema = arrow_schema(out)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            found = compare_cell(pa.Table.from_batches(parts), least)
            columns = [pa.array(x.astype(np.int64)) for x in found]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        parts, held = [], None
        for batch in batches:
            keys = np.stack([batch[name].to_numpy() for name in CELL])
            new = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for low, high in zip([0, *new], [*new, batch.num_rows]):
                cell = tuple(keys[:, low]) if low < high else held
                if parts and cell != held:
                    yield told(parts)
                    parts = []
                held = cell
                if low < high:
                    parts.append(batch.slice(low, high - low))
        if parts:
            yield told(parts)

    return dealt.mapInArrow(compare, out)
