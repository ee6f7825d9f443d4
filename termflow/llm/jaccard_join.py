"""Operator 3: n-gram Jaccard join by a partitioned universe.

Documents are sets of five-word shingles; see ``set_segments`` for the index.
The job goes from cheap, linear steps to exact completion:

0. Equal sets, by a digest of 128 bits, are one set from here on: that of their
   first row.
1. Signatures of all sets meet in shards. Within a signature every set is paired
   with the least one only. Equal signatures within a batch of documents are
   paired there and travel once, so a hot signature costs a shard one entry per
   batch.
2. Linked sets share more signatures than their slack. Pairs of step 1 that do are
   verified on the sets themselves: first the best one of each set, then those
   that still join two components.
3. What could be missing are links that show in no pair of step 1, because some
   third set is the least of their common signatures. Those sets have rows with
   the same least sets, and share at most the smaller count of both rows with
   each. By prefix filtering, a set leaves out its rows with the most frequent
   least sets, as long as all left out together are too few for a link: the
   rarest common least set of a link is among the rows that both sets keep.
   First each set is verified with the most central one beside it, which joins
   groups of copies in a linear number of pairs; then all pairs of still
   different components whose bound is large enough.
4. Least sets with many rows would give pairs by the square of their number.
   Their sets are compared in tiles instead (``set_tiles``): a task holds two
   tiles of sets, counts what all of them share, and gives out only links that
   join components. Sets whose large groups overlap are compared as one block if
   that is less work than group by group. Blocks are made before step 3 pairs
   sets, so a set of a block has one row from there on, however many of its
   groups the block joins.

Links are decided on exact intersections of 64-bit shingle hashes.

Defined cases: NULL and empty texts, and those without words, have no shingles
and link with nothing; rows that share a doc_id are nodes of their own, ordered
by their place in the input; rows with NULL doc_id link with nothing and have a
NULL component; extra columns are kept; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termflow.llm.components import components
from termflow.llm.frames import free_name
from termflow.llm.line_runs import numbered
from termflow.llm.quality import quoted
from termflow.llm.set_segments import bands, signatures
from termflow.llm.set_tiles import supers_of, tile_links
from termflow.llm.shingles import U64, shingle_set
from termflow.llm.storage import documents, stored
from termflow.llm.token_blocks import arrow_schema

PERCENT = 80
#: Signatures gathered by a task before they are dealt to shards.
TOGETHER = 1 << 20
SHARDS = 1024
#: Shingles whose signatures a task of the index should hold, at most.
IN_TASK = 1_000_000
#: Row numbers or signatures sent to all tasks, at most; more are joined.
MOST_BROADCAST = 4_000_000

#: Least sets with more rows, those left out included, are compared in tiles.
LARGE = 32

#: A signature found so often in one batch is paired there and travels once: one that
#: would give its shard as much as all others together. Members of rarer ones travel
#: each by itself, for pairing names only the batch's least set, and a set then has a
#: row for whatever that one shares with others.
HOT_IN_BATCH = TOGETHER // SHARDS

SETS = "row bigint, shingles binary"
DEALT = "shard int, keys binary, rows binary, notes binary"
STARS = "a bigint, b bigint, in_batch boolean, n bigint, remaining bigint"


def sizes_of(docs: DataFrame, row: str) -> DataFrame:
    """row, n_shingles of every document, with a digest of a set that can link."""
    out = "row bigint, n_shingles bigint, digest binary"
    schema = arrow_schema(out)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for text, is_named in zip(batch["text"], batch["is_named"].to_pylist()):
                elements = shingle_set(text.as_py())
                sizes.append(len(elements))
                can_link = is_named and len(elements)
                digest = blake2b(elements.tobytes(), digest_size=16).digest()
                digests.append(digest if can_link else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                ],
                schema=schema,
            )

    is_named = F.col("doc_id").isNotNull().alias("is_named")
    return docs.select(F.col(row).alias("row"), "text", is_named).mapInArrow(measure, out)


def equal_sets(sizes: DataFrame) -> DataFrame:
    """copy, first: rows whose set another row has, with the first of these."""
    firsts = stored(
        sizes.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("row").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first"),
        "firsts",
    )
    return (
        sizes.join(sent_if_small(firsts), "digest")
        .where("row != first")
        .select(F.col("row").alias("copy"), "first")
    )


def with_equal_sets(labels: DataFrame, equal: DataFrame) -> DataFrame:
    """node, component for the rows in ``equal`` too."""
    copies = (
        equal.join(labels, F.col("first") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "first"))
    )
    alone = copies.where("node IS NULL").select(
        F.col("first").alias("node"), "component"
    )
    return (
        labels.select("node", "component")
        .unionByName(copies.select(F.col("copy").alias("node"), "component"))
        .unionByName(alone.distinct())
    )


def sets_of(docs: DataFrame) -> DataFrame:
    """row and its sorted shingles as bytes."""
    schema = arrow_schema(SETS)

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x.as_py()).tobytes() for x in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(sets, pa.binary())], schema=schema
            )

    return docs.select("row", "text").mapInArrow(shingle, SETS)


def star_rows(keys, rows, notes, in_batch: bool) -> list[np.ndarray]:
    """Columns of STARS for entries ordered by key and row.

    A row for each member, the least one included, of the signatures that
    several share, added up. A note is four times what is left of the slack,
    plus the signature's units.
    """
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[starts, len(keys)])
    several = np.repeat(size, size) > 1
    a, b = np.repeat(rows[starts], size)[several], rows[several]
    notes = notes[several]
    order = np.lexsort((b, a))
    a, b, notes = a[order], b[order], notes[order]
    starts = np.flatnonzero(
        np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)]
    )
    if not len(starts):
        return [a, b, a > b, notes, notes]
    return [
        a[starts],
        b[starts],
        np.full(len(starts), in_batch),
        np.add.reduceat(notes & 3, starts),
        np.minimum.reduceat(notes >> 2, starts),
    ]


class Gathered:
    """Signatures of a batch of documents, dealt to shards."""

    def __init__(self):
        self.keys, self.rows, self.notes, self.size = [], [], [], 0

    def add(self, elements: np.ndarray, row: int) -> None:
        for band in bands(len(elements)):
            keys, units, remaining = signatures(elements, band)
            self.keys.append(keys)
            self.rows.append(np.full(len(keys), row, np.int64))
            self.notes.append(units + 4 * remaining)
            self.size += len(keys)

    def dealt(self, schema: pa.Schema) -> pa.RecordBatch:
        """Entries by shard; star rows of hot signatures, packed, as shard -1."""
        keys, rows, notes = map(np.concatenate, (self.keys, self.rows, self.notes))
        order = np.lexsort((rows, keys))
        keys, rows, notes = keys[order], rows[order], notes[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[starts, len(keys)])
        hot = np.repeat(size >= HOT_IN_BATCH, size)
        out = []
        if hot.any():
            a, b, _, n, left = star_rows(keys[hot], rows[hot], notes[hot], True)
            out.append((-1, n, np.stack([a, b], 1), left))
        keep = ~hot
        keep[starts] = True
        keys, rows, notes = keys[keep], rows[keep], notes[keep]
        shard = (keys >> U64(64 - 10)).astype(np.int64)
        edges = np.searchsorted(shard, np.arange(SHARDS + 1))
        for k in range(SHARDS):
            part = slice(edges[k], edges[k + 1])
            if edges[k] < edges[k + 1]:
                out.append((k, keys[part], rows[part], notes[part]))
        columns = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(next(columns), pa.int32())]
            + [
                pa.array([x.tobytes() for x in column], pa.binary())
                for column in columns
            ],
            schema=schema,
        )


def star_table(docs: DataFrame, row: str, tasks: int) -> DataFrame:
    """STARS: units n that b shares with the least set a.

    Where ``in_batch``, a is only the least one of b's batch.
    """
    dealt_schema, out_schema = arrow_schema(DEALT), arrow_schema(STARS)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = Gathered()
        for batch in batches:
            for number, text in zip(batch["row"], batch["text"]):
                elements = shingle_set(text.as_py())
                if len(elements):
                    gathered.add(elements, number.as_py())
                if gathered.size >= TOGETHER:
                    yield gathered.dealt(dealt_schema)
                    gathered = Gathered()
        if gathered.size:
            yield gathered.dealt(dealt_schema)

    def rows_of(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, out_schema)],
            schema=out_schema,
        )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for shard, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                keys, rows, notes = (np.frombuffer(x, np.int64) for x in parts)
                if shard >= 0:
                    held.append((keys.view(U64), rows, notes))
                    continue
                a, b = rows.reshape(-1, 2).T
                yield rows_of([a, b, np.full(len(a), True), keys, notes])
        if held:
            keys, rows, notes = map(np.concatenate, zip(*held))
            held.clear()
            order = np.lexsort((rows, keys))
            yield rows_of(
                star_rows(keys[order], rows[order], notes[order], False)
            )

    linkable = docs.where(F.col("doc_id").isNotNull())
    dealt = linkable.select(F.col(row).alias("row"), "text").mapInArrow(index, DEALT)
    return (
        dealt.repartition(tasks, "shard")
        .mapInArrow(meet, STARS)
        .groupBy("a", "b", "in_batch")
        .agg(F.sum("n").alias("n"), F.min("remaining").alias("remaining"))
    )


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b whose sets are similar enough."""
    for side in "ab":
        pairs = pairs.join(
            sets.select(
                F.col("row").alias(side), F.col("shingles").alias(f"{side}_set")
            ),
            side,
        )
    out = "a bigint, b bigint"
    schema = arrow_schema(out)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["a_set"], batch["b_set"]):
                x = np.frombuffer(x.as_buffer(), U64)
                y = np.frombuffer(y.as_buffer(), U64)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                union = len(both) - common
                keep.append(100 * common >= PERCENT * union)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch["a"].filter(mask), batch["b"].filter(mask)], schema=schema
            )

    return pairs.select("a", "b", "a_set", "b_set").mapInArrow(compare, out)


def between_components(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs a, b that are not in one component yet."""
    for side in "ab":
        pairs = pairs.join(
            labels.select(
                F.col("node").alias(side), F.col("component").alias(f"{side}_label")
            ),
            side,
            "left",
        )
    return pairs.where(
        F.coalesce("a_label", "a") != F.coalesce("b_label", "b")
    ).select("a", "b")


def sent_if_small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= MOST_BROADCAST else keys


def plausible_pairs(stars: DataFrame) -> DataFrame:
    """a < b, n: rows of step 1 that share more units than either has left."""
    own = stars.groupBy(F.col("b").alias("a")).agg(
        F.min("remaining").alias("a_remaining")
    )
    return (
        stars.where("a != b")
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"), F.min("remaining").alias("b_remaining"))
        .join(own, "a")
        .where("n > greatest(a_remaining, b_remaining)")
        .select("a", "b", "n")
    )


def rare_rows(stars: DataFrame) -> DataFrame:
    """Step 3: least, b, n, remaining, dropped, total after prefix filtering.

    ``size`` is how many rows the least set had before.
    """
    in_batch = stars.where("in_batch and a != b")
    through = in_batch.select(
        F.col("a").alias("least"), "b", "n", "remaining"
    ).join(
        stars.where("not in_batch").select(
            "a", F.col("b").alias("least"), F.col("n").alias("other")
        ),
        "least",
    )
    rows = (
        stars.select("a", "b", "n", "remaining")
        .unionByName(
            through.select("a", "b", F.least("n", "other").alias("n"), "remaining")
        )
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"), F.min("remaining").alias("remaining"))
    )
    sizes = rows.groupBy("a").agg(F.count("*").alias("size"))
    whole = Window.partitionBy("b")
    frequent_first = whole.orderBy(F.desc("size"), F.desc("a")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    dropped = F.col("so_far") <= F.col("remaining")
    rows = (
        rows.join(sizes, "a")
        .withColumn("remaining", F.min("remaining").over(whole))
        .withColumn("total", F.sum("n").over(whole))
        .withColumn("so_far", F.sum("n").over(frequent_first))
        .withColumn(
            "dropped", F.sum(F.when(dropped, F.col("n")).otherwise(0)).over(whole)
        )
        .where(~dropped)
    )
    return rows.select(
        F.col("a").alias("least"), "b", "n", "remaining", "dropped", "total", "size"
    )


def labelled(rows: DataFrame, labels: DataFrame, side: str, name: str) -> DataFrame:
    """The rows with the component of the set in column ``side``."""
    return rows.join(
        labels.select(F.col("node").alias(side), F.col("component").alias(name)),
        side,
        "left",
    ).withColumn(name, F.coalesce(name, side))


def labelled_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with the components of b (label) and of the least set."""
    rows = labelled(rows, labels, "least", "least_label")
    return labelled(rows, labels, "b", "label")


def central_pairs(rows: DataFrame) -> DataFrame:
    """Each set with the most central one of all its least sets' rows.

    That is the one that shares most in all, in a group of copies the one the
    others were made from. And the sets that are not in its component with the
    most central among them. A set has two pairs at most, however many groups it
    is in.
    """

    def with_leader(rows: DataFrame) -> DataFrame:
        leaders = rows.groupBy("least").agg(
            F.max_by(
                F.struct("b", "label"), F.struct("total", -F.col("b"))
            ).alias("leader"),
            F.max("total").alias("leader_total"),
        )
        return rows.join(leaders, "least").where(
            F.col("label") != F.col("leader.label")
        )

    def most_central(rows: DataFrame) -> DataFrame:
        best = F.struct("leader_total", -F.col("leader.b"))
        return rows.groupBy("b").agg(F.max_by("leader", best).alias("leader"))

    first = with_leader(rows)
    second = with_leader(first.drop("leader", "leader_total"))
    return (
        most_central(first)
        .unionByName(most_central(second))
        .select(
            F.least("b", "leader.b").alias("a"),
            F.greatest("b", "leader.b").alias("b"),
        )
        .distinct()
    )


def in_blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, supers) of ``rare_rows``, stored.

    ``groups`` has the rows of small groups and, with ``in_block``, what is compared
    in tiles: a row for a set in a block. ``supers`` is as in ``supers_of``.
    """
    supers, blocks = supers_of(rows.where(F.col("size") > LARGE), "total")
    blocks = blocks.select(
        F.col("block").alias("least"), "b", "total", F.lit(True).alias("in_block")
    )
    groups = (
        rows.where(F.col("size") <= LARGE)
        .drop("size")
        .withColumn("in_block", F.lit(False))
        .unionByName(blocks, allowMissingColumns=True)
    )
    return stored(groups, "groups"), stored(supers, "supers")


def open_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (with label) of least sets at which components meet, with the number of
    these rows (members) and whether the set is not of the least set's component.

    Two sets of different components have no least set in common but these.
    """
    groups = (
        rows.groupBy("least")
        .agg(
            F.count("*").alias("members"),
            (F.min("label") != F.max("label")).alias("is_open"),
        )
        .where("is_open")
        .drop("is_open")
    )
    return rows.join(labelled(groups, labels, "least", "least_label"), "least").withColumn(
        "apart", F.col("label") != F.col("least_label")
    )


def hidden_pairs(rows: DataFrame, supers: DataFrame | None = None) -> DataFrame:
    """Pairs of different components that may share enough.

    All sets leave out rows in one order of least sets. So the set that goes on
    longer has left out every common least set that is not in ``kept``, those that
    only the other one kept included; its ``dropped`` bounds them.

    With ``supers`` (node, super, whole, in_large) the rows are those of small
    groups. Sets of one super have been compared if it is ``whole``, else what
    they may share in large groups comes to the bound; others share no large one.
    """
    if "apart" not in rows.columns:
        rows = rows.withColumn("apart", F.col("label") != F.col("least_label"))
    if supers is None:
        rows = rows.selectExpr(
            "*", "-1L AS super", "false AS whole", "0L AS in_large"
        )
    else:
        rows = (
            rows.join(supers, F.col("b") == F.col("node"), "left")
            .drop("node")
            .withColumn("super", F.coalesce("super", -1 - F.col("b")))
            .fillna(False, ["whole"])
            .fillna(0, ["in_large"])
        )
    rows = stored(rows, "rows")
    x, y = rows.where("apart").alias("x"), rows.alias("y")
    once = ~F.col("y.apart") | (F.col("x.b") < F.col("y.b"))
    together = F.col("x.super") == F.col("y.super")

    def bound(side: str):
        beside = F.when(together, F.col(f"{side}.in_large")).otherwise(0)
        return F.col(f"{side}.dropped") + beside

    return (
        x.join(y, "least")
        .where((F.col("x.label") != F.col("y.label")) & once)
        .where(~(together & F.col("x.whole")))
        .groupBy(
            F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b")
        )
        .agg(
            F.sum(F.least("x.n", "y.n")).alias("kept"),
            F.max(F.greatest(bound("x"), bound("y"))).alias("dropped"),
            F.max(F.greatest("x.remaining", "y.remaining")).alias("remaining"),
        )
        .where("kept + dropped > remaining")
        .select("a", "b")
    )


def sets_in(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The stored sets of the documents whose row numbers these are."""
    nodes = stored(nodes.distinct(), "nodes")
    return stored(sets_of(docs.join(sent_if_small(nodes), "row")), "sets")


def nodes_of(pairs: DataFrame) -> DataFrame:
    """The rows that the pairs name, each side's made distinct by itself."""
    first, second = (pairs.select(F.col(side).alias("row")) for side in "ab")
    return first.distinct().unionByName(second.distinct())


def all_links(docs: DataFrame, row: str, n_shingles: int) -> DataFrame:
    """node, component by least row number, for rows with links."""
    wanted = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    tasks = max(int(wanted), n_shingles // IN_TASK)
    stars = stored(star_table(docs, row, tasks), "stars")
    plain = docs.select(F.col(row).alias("row"), "text")

    plausible = stored(plausible_pairs(stars), "pairs")
    sets = sets_in(nodes_of(plausible), plain)
    best = plausible.groupBy("b").agg(
        F.max_by("a", F.struct("n", -F.col("a"))).alias("a")
    )
    links = stored(verified(best.select("a", "b"), sets), "links")
    rest = between_components(
        plausible.select("a", "b").join(best, ["a", "b"], "left_anti"),
        components(links),
    )
    links = stored(links.unionByName(verified(rest, sets)), "links")

    groups, supers = in_blocks(stored(rare_rows(stars), "rows"))
    # Central pairs read these rows several times.
    central = central_pairs(
        stored(labelled(groups, components(links), "b", "label"), "labelled")
    )
    central = stored(
        central.join(plausible, ["a", "b"], "left_anti").select("a", "b"), "pairs"
    )
    found = verified(central, sets_in(nodes_of(central), plain))
    links = stored(links.unionByName(found), "links")

    labels = components(links)
    rows = stored(open_rows(labelled(groups, labels, "b", "label"), labels), "rows")
    blocks = rows.where("in_block").select(F.col("least").alias("block"), "b", "label")
    in_tiles = tile_links(blocks, sets_in(blocks.select(F.col("b").alias("row")), plain))

    tested = plausible.select("a", "b").unionByName(central)
    hidden = hidden_pairs(rows.where("NOT in_block"), supers).join(
        tested, ["a", "b"], "left_anti"
    )
    hidden = stored(hidden, "pairs")
    found = verified(hidden, sets_in(nodes_of(hidden), plain)).unionByName(in_tiles)
    return components(stored(links.unionByName(found), "links"))


def near_documents(docs: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` with a struct column ``name``.

    It has n_shingles, component_id (least doc_id of the component) and is_first
    (the component's first row in the order of doc_id and place in the input).
    """
    own, row = list(docs.columns), free_name(docs, "row_number")
    docs = numbered(docs, row)
    sizes = stored(sizes_of(docs, row), "sizes")
    total = sizes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    equal = stored(equal_sets(sizes), "equal")
    copies = sent_if_small(equal.select(F.col("copy").alias(row)))
    linked = all_links(docs.join(copies, row, "left_anti"), row, int(total))
    labels = stored(with_equal_sets(linked, equal), "labels")
    ids = docs.select(F.col(row).alias("node"), "doc_id")
    first = F.min(F.struct("doc_id", "node"))
    firsts = (
        labels.join(ids, "node")
        .groupBy("component")
        .agg(first.alias("first"))
        .select(
            "component",
            F.col("first.doc_id").alias("component_id"),
            F.col("first.node").alias("first_node"),
        )
    )
    found = sizes.join(
        labels.join(firsts, "component"), F.col("row") == F.col("node"), "left"
    ).select(
        F.col("row").alias("found_row"),
        "n_shingles",
        "component_id",
        "first_node",
    )
    number = free_name(docs, "found")
    found = found.select(
        F.col("found_row").alias(number), F.struct("*").alias(number + "s")
    )
    f = F.col(number + "s")
    return docs.join(found, F.col(row) == F.col(number)).select(
        *map(quoted, own),
        F.struct(
            f["n_shingles"].alias("n_shingles"),
            F.coalesce(f["component_id"], F.col("doc_id")).alias("component_id"),
            F.coalesce(f["first_node"] == F.col(row), F.lit(True)).alias("is_first"),
        ).alias(name),
    )


def first_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows that are the first of their component, with their own columns."""
    name = free_name(docs, "near")
    return (
        near_documents(docs, name)
        .where(F.col(name)["is_first"])
        .select(*map(quoted, docs.columns))
    )


def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: shingles and component of all documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return near_documents(docs, "near").select(
        "doc_id", "near.n_shingles", "near.component_id"
    )
