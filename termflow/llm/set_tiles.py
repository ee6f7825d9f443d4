"""Sets of large groups compared all with all, in tiles, without a row per pair.

A block of sets is dealt by hash to tiles. For each two tiles a task gets the
sets of both, counts what each two share by a product of incidence matrices, and
gives out links that join components: at most one less than there are components
in the two tiles. What moves are the sets, each as often as its block has tiles;
what a task holds are two tiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termflow.llm.components import components
from termflow.llm.shingles import U64
from termflow.llm.storage import stored
from termflow.llm.token_blocks import arrow_schema

PERCENT = 80
#: Sets and bytes of sets in a tile, about.
TILE = 512
TILE_BYTES = 16 << 20
#: Columns of an incidence matrix that is held at once.
COLUMNS = 4096


def supers_of(large: DataFrame, kept: str = "label") -> tuple[DataFrame, DataFrame]:
    """(supers, blocks) of the rows of large groups.

    ``supers`` has node, super, whole, in_large of all sets in them. A super joins
    groups that have sets in common. It is ``whole`` if comparing all its sets
    takes no more pairs than comparing each group's. ``in_large`` is what a set's
    rows in large groups count. ``blocks`` has block, b and ``kept``, a column with
    one value for a set: what is compared with each other, a super that is whole,
    else each of its groups.
    """
    large = stored(large.select("least", "b", kept, "n"), "large")
    # A set joins its groups. It is in no edge itself: groups go with its first one.
    first = large.withColumn("first", F.min("least").over(Window.partitionBy("b")))
    found = components(first.select(F.col("first").alias("a"), F.col("least").alias("b")))
    found = found.select("node", F.col("component").alias("super"))

    def with_super(rows: DataFrame, group: str) -> DataFrame:
        rows = rows.join(found, F.col(group) == F.col("node"), "left").drop("node")
        return rows.withColumn("super", F.coalesce("super", group))

    sets = large.groupBy("b", kept).agg(
        F.min("least").alias("first"), F.sum("n").alias("in_large")
    )
    per_set = stored(
        with_super(sets, "first").select(
            "super", F.col("b").alias("node"), kept, "in_large"
        ),
        "per-set",
    )
    groups = large.groupBy("least").agg(F.count("*").alias("members"))
    by_group = (
        with_super(groups, "least")
        .groupBy("super")
        .agg(F.sum(F.col("members") * F.col("members")).alias("by_group"))
    )
    at_once = per_set.groupBy("super").agg(F.count("*").alias("sets"))
    whole = stored(
        by_group.join(at_once, "super").select(
            "super", (F.col("sets") * F.col("sets") <= F.col("by_group")).alias("whole")
        ),
        "whole",
    )
    supers = per_set.join(whole, "super")
    at_once = supers.where("whole").select(
        (-1 - F.col("super")).alias("block"), F.col("node").alias("b"), kept
    )
    one_by_one = large.join(
        supers.where("NOT whole").select(F.col("node").alias("b")), "b"
    ).select(F.col("least").alias("block"), "b", kept)
    blocks = at_once.unionByName(one_by_one)
    return supers.select("node", "super", "whole", "in_large"), blocks


def shared_counts(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """How many elements each two sets of the two lists have in common."""
    sets = first + second
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, place, counts = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    # What one set alone has counts for no pair, what all have for each.
    in_all = int((counts == len(sets)).sum())
    mixed = (counts > 1) & (counts < len(sets))
    column = np.cumsum(mixed) - 1
    use = mixed[place]
    owner, column = owner[use], column[place[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.full((len(first), len(second)), in_all, np.float32)
    for low in range(0, int(mixed.sum()), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        shared += held[: len(first)] @ held[len(first) :].T
    return np.rint(shared).astype(np.int64)


def joining_links(
    first: list[tuple[int, int, np.ndarray]],
    second: list[tuple[int, int, np.ndarray]],
) -> list[tuple[int, int]]:
    """Links (a, b) between members (row, label, set) that join their labels.

    Both lists are the same one, or have no row in common.
    """
    (rows_a, labels_a, sets_a), (rows_b, labels_b, sets_b) = (
        map(list, zip(*side)) for side in (first, second)
    )
    a, b = np.array(labels_a), np.array(labels_b)
    apart = a[:, None] != b[None, :]
    if not apart.any():
        return []
    shared = shared_counts(sets_a, sets_b)
    sizes_a = np.array([len(x) for x in sets_a])[:, None]
    sizes_b = np.array([len(x) for x in sets_b])[None, :]
    union = sizes_a + sizes_b - shared
    x, y = np.nonzero(apart & (100 * shared >= PERCENT * union))
    _, one = np.unique(np.stack([a[x], b[y]]), axis=1, return_index=True)
    root: dict[int, int] = {}

    def find(label: int) -> int:
        while root.setdefault(label, label) != label:
            root[label] = label = root[root[label]]
        return label

    out = []
    for k in one:
        u, v = find(labels_a[x[k]]), find(labels_b[y[k]])
        if u != v:
            root[v] = u
            out.append((rows_a[x[k]], rows_b[y[k]]))
    return out


def tile_links(
    blocks: DataFrame, sets: DataFrame, tile: int = TILE, tile_bytes: int = TILE_BYTES
) -> DataFrame:
    """Links a, b that join the components (label) in each block."""
    sized = blocks.join(
        sets.select("row", F.octet_length("shingles").alias("bytes")),
        F.col("b") == F.col("row"),
    ).drop("row")
    tiles = sized.groupBy(F.col("block").alias("of")).agg(
        F.greatest(
            F.ceil(F.count("*") / tile), F.ceil(F.sum("bytes") / tile_bytes), F.lit(1)
        ).cast("int").alias("tiles")
    )
    own = F.pmod(F.xxhash64("b"), F.col("tiles")).cast("int")
    # Sets join last, when it is known where each has to go.
    dealt = (
        sized.join(tiles, F.col("block") == F.col("of"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .join(sets, F.col("b") == F.col("row"))
        .select(
            "block",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "own",
            "b",
            "label",
            "shingles",
        )
        .repartition("block", "i", "j")
        .sortWithinPartitions("block", "i", "j")
    )
    out = "a bigint, b bigint"
    schema = arrow_schema(out)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), found in groupby(members(batches), key=lambda m: m[:3]):
            sides: dict[int, list] = {}
            for *_, own, row, label, held in found:
                sides.setdefault(own, []).append((row, label, np.frombuffer(held, U64)))
            if len(sides) < 1 + (i != j):  # a tile that hashing left empty
                continue
            links = joining_links(sides[i], sides[j])
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in zip(*links)],
                    schema=schema,
                )

    return dealt.mapInArrow(compare, out).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
