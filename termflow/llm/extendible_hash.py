"""Operator 11: exact copies by an extendible-hash index on shared files.

Texts are equal if they are identical without white space. Their 64-bit hashes
are the keys of an index:

1. Directory: bytes of distinct keys are summed by key prefix. A bucket whose
   texts take too many bytes is split by the next bit of its keys; where its
   depth is that of the directory, the directory doubles. What Spark sums are
   the 2^16 longest prefixes, so the directory is built from at most 65,536 rows
   and says nothing about single texts. A bucket of one key is not split.
2. Buckets, in key order, are dealt to owner tasks: each owns a key range. Every
   Arrow batch of documents first merges its own equal texts and sends one entry
   for each, with their number and the best of them, so a text that a third of
   all rows hold costs its owner one entry a batch.
3. An owner walks its entries sorted by key. Entries of one key are chained and
   their bytes compared, so texts that only share a hash stay apart. It writes
   the index file of its range: each text once, and for every entry its group.
4. Rows look up their group by batch and entry, which spreads a hot text over as
   many keys as there are batches.

The index stays readable: ``known_texts`` tells which texts of another table it
holds.

Defined cases: NULL and empty texts are equal, also to texts of white space only;
of equal texts the longest row (in code points) stays, then the least doc_id
(NULL last), then the first in input order, so exactly one of repeated rows is
kept; extra columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow.llm.storage import documents, new_folder, stored
from termflow.llm.token_blocks import arrow_schema

BLANKS = b" \t\n\x0b\x0c\r"
KEY_BITS = 64
#: Longest prefix that the directory tells apart.
MOST_DEPTH = 16
#: Bytes of text that an owner task and a bucket should hold, at most.
OWNER_BYTES = 64 << 20
BUCKETS_PER_OWNER = 4
#: Entries an owner gives out together.
TOGETHER = 4096

SENT = (
    "owner int, entry boolean, key bigint, part bigint, class int, doc_id bigint, "
    "n_chars int, row int, n bigint, text binary"
)
HELD = (
    "entry boolean, bucket int, key bigint, part bigint, class int, doc_id bigint, "
    "row int, keep_id bigint, keep_part bigint, keep_row int, group_size bigint, "
    "text_sha256 string, text binary"
)


def key_of(text: bytes, key_bits: int = KEY_BITS) -> int:
    """The key, in the leading ``key_bits`` of 64 bits."""
    return xxhash.xxh64_intdigest(text) >> (64 - key_bits) << (64 - key_bits)


def signed(keys: list[int]) -> pa.Array:
    return pa.array(np.array(keys, np.uint64).view(np.int64))


class Directory:
    """Which bucket holds the keys of each prefix of ``depth`` bits."""

    def __init__(self) -> None:
        self.depth = 0
        self.slots = [0]
        #: Depth and prefix of each bucket.
        self.buckets = [(0, 0)]

    def double(self) -> None:
        self.slots = [bucket for bucket in self.slots for _ in range(2)]
        self.depth += 1

    def split(self, bucket: int) -> int:
        """Deal the bucket's keys by their next bit; the new bucket's number."""
        depth, prefix = self.buckets[bucket]
        if depth == self.depth:
            self.double()
        new = len(self.buckets)
        self.buckets[bucket] = depth + 1, 2 * prefix
        self.buckets.append((depth + 1, 2 * prefix + 1))
        wide = self.depth - depth - 1
        first = (2 * prefix + 1) << wide
        self.slots[first : first + (1 << wide)] = [new] * (1 << wide)
        return new

    def bucket_of(self, key: int) -> int:
        return self.slots[key >> (64 - self.depth)] if self.depth else 0

    @classmethod
    def of_loads(
        cls, loads: dict[int, tuple[int, int]], bucket_bytes: int
    ) -> "Directory":
        """Split until no bucket of several keys takes more bytes.

        ``loads`` has keys and bytes for each prefix of ``MOST_DEPTH`` bits.
        """
        leaves = [loads.get(k, (0, 0)) for k in range(1 << MOST_DEPTH)]
        keys = [0, *accumulate(n for n, _ in leaves)]
        size = [0, *accumulate(n for _, n in leaves)]

        def load(bucket: int) -> tuple[int, int]:
            depth, prefix = made.buckets[bucket]
            wide = MOST_DEPTH - depth
            low, high = prefix << wide, (prefix + 1) << wide
            return keys[high] - keys[low], size[high] - size[low]

        made, full = cls(), [0]
        while full:
            bucket = full.pop()
            n, taken = load(bucket)
            if taken > bucket_bytes and n > 1:
                if made.buckets[bucket][0] < MOST_DEPTH:
                    full += [bucket, made.split(bucket)]
        made.loads = [load(bucket)[1] for bucket in range(len(made.buckets))]
        return made

    def owners(self, n: int) -> list[int]:
        """The owner of each bucket: ranges of keys of about the same bytes."""
        in_order = sorted(
            range(len(self.buckets)),
            key=lambda b: self.buckets[b][1] << (MOST_DEPTH - self.buckets[b][0]),
        )
        total, before, out = max(sum(self.loads), 1), 0, [0] * len(in_order)
        for bucket in in_order:
            middle = before + self.loads[bucket] // 2
            out[bucket] = min(n * middle // total, n - 1)
            before += self.loads[bucket]
        return out


def plain(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.length(text).alias("n_chars"),
        text.cast("binary").alias("text"),
    )


def prefix_loads(docs: DataFrame, key_bits: int) -> dict[int, tuple[int, int]]:
    """Distinct keys and their bytes by prefix of ``MOST_DEPTH`` bits."""
    out = "key bigint, bytes bigint"
    schema = arrow_schema(out)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes: dict[int, int] = {}
            for text in batch["text"].to_pylist():
                text = text.translate(None, BLANKS)
                key = key_of(text, key_bits)
                sizes[key] = max(sizes.get(key, 0), len(text))
            yield pa.RecordBatch.from_arrays(
                [signed(list(sizes)), pa.array(sizes.values(), pa.int64())],
                schema=schema,
            )

    found = (
        plain(docs)
        .select("text")
        .mapInArrow(keyed, out)
        .groupBy("key")
        .agg(F.max("bytes").alias("bytes"))
        .groupBy(F.shiftrightunsigned("key", 64 - MOST_DEPTH).alias("prefix"))
        .agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    )
    return {row["prefix"]: (row["n"], row["bytes"]) for row in found.collect()}


def rank(n_chars: int, doc_id: int | None, row: int) -> tuple:
    """The least rank is the row that stays."""
    return -n_chars, doc_id is None, doc_id or 0, row


def entries_of(
    docs: DataFrame, directory: Directory, owners: int, key_bits: int
) -> DataFrame:
    """A member for every row, and an entry for each text of a batch."""
    schema = arrow_schema(SENT)
    owner = directory.owners(owners)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for nth, batch in enumerate(batches):
            part = task << 32 | nth
            classes: dict[bytes, list] = {}
            rows = []
            for row, (doc_id, n_chars, text) in enumerate(
                zip(*(column.to_pylist() for column in batch.columns))
            ):
                text = text.translate(None, BLANKS)
                own = rank(n_chars, doc_id, row)
                held = classes.setdefault(text, [len(classes), 0, own])
                held[1] += 1
                held[2] = min(held[2], own)
                rows.append(
                    ((task + nth) % owners, False, 0, part, held[0], doc_id, n_chars, row, 1, None)
                )
            keys = [0] * len(rows)
            for text, (number, n, (less, no_id, doc_id, row)) in classes.items():
                key = key_of(text, key_bits)
                keys.append(key)
                rows.append(
                    (owner[directory.bucket_of(key)], True, key, part, number,
                     None if no_id else doc_id, -less, row, n, text)
                )
            columns = [list(column) for column in zip(*rows)] or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [
                    signed(keys) if field.name == "key" else pa.array(column, field.type)
                    for column, field in zip(columns, schema)
                ],
                schema=schema,
            )

    return plain(docs).mapInArrow(enter, SENT)


def chained(entries: DataFrame, directory: Directory) -> DataFrame:
    """The index: entries in key order with their group, members as they are.

    A group holds its text once; what grows with the copies is three numbers for
    each batch that has the text.
    """
    schema = arrow_schema(HELD)

    def closed(chain: dict[bytes, list], key: int) -> Iterator[tuple]:
        bucket = directory.bucket_of(key % (1 << 64))
        for text, (keep, size, refs) in chain.items():
            digest = sha256(text).hexdigest()
            for at, (part, number) in enumerate(refs):
                yield (
                    True, bucket, key, part, number, None, None, *keep, size,
                    digest, None if at else text,
                )

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple | pa.RecordBatch]:
        chain: dict[bytes, list] = {}
        last = None
        for batch in batches:
            members = batch.filter(pa.compute.invert(batch["entry"]))
            if members.num_rows:
                nothing = {f.name: pa.nulls(members.num_rows, f.type) for f in schema}
                kept = {n: members[n] for n in ("entry", "part", "class", "doc_id", "row")}
                columns = {**nothing, **kept}
                yield pa.RecordBatch.from_arrays(
                    [columns[f.name] for f in schema], schema=schema
                )
            for key, part, number, doc_id, row, n, text in zip(
                *(
                    batch.filter(batch["entry"])[name].to_pylist()
                    for name in ("key", "part", "class", "doc_id", "row", "n", "text")
                )
            ):
                if key != last:
                    yield from closed(chain, last) if chain else ()
                    chain, last = {}, key
                # The best entry of a key comes first, so it leads its group.
                held = chain.setdefault(text, [(doc_id, part, row), 0, []])
                held[1] += n
                held[2].append((part, number))
        yield from closed(chain, last) if chain else ()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def together(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(column, f.type) for column, f in zip(zip(*rows), schema)],
                schema=schema,
            )

        rows: list[tuple] = []
        for found in walked(batches):
            if isinstance(found, pa.RecordBatch):
                yield found
                continue
            rows.append(found)
            if len(rows) == TOGETHER:
                yield together(rows)
                rows = []
        if rows:
            yield together(rows)

    return entries.mapInArrow(write, HELD)


def write_index(
    docs: DataFrame,
    path: str,
    bucket_bytes: int | None = None,
    key_bits: int = KEY_BITS,
) -> None:
    """Index the texts of ``docs`` in a new folder all executors share.

    ``bucket_bytes`` is the size at which buckets split, by default a quarter of
    what an owner task takes.
    """
    spark = docs.sparkSession
    loads = prefix_loads(docs, key_bits)
    total = sum(size for _, size in loads.values())
    owners = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // OWNER_BYTES)
    )
    owners = min(owners, 1 << MOST_DEPTH)
    per_bucket = total // (BUCKETS_PER_OWNER * owners)
    directory = Directory.of_loads(loads, bucket_bytes or max(per_bucket, 1))
    held = (
        entries_of(docs, directory, owners, key_bits)
        .repartitionById(owners, "owner")
        .sortWithinPartitions(
            "entry", "key", F.desc("n_chars"), F.asc_nulls_last("doc_id"), "part", "row"
        )
    )
    chained(held, directory).write.option("compression", "zstd").parquet(
        f"{path}/buckets"
    )
    spark.createDataFrame(
        [
            (bucket, depth, prefix, size, key_bits)
            for bucket, ((depth, prefix), size) in enumerate(
                zip(directory.buckets, directory.loads)
            )
        ],
        "bucket int, depth int, prefix bigint, bytes bigint, key_bits int",
    ).coalesce(1).write.parquet(f"{path}/directory")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HELD).parquet(f"{path}/buckets")


def grouped(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every indexed row."""
    index = read_index(spark, path)
    groups = index.where("entry").select(
        "part", "class", "keep_id", "keep_part", "keep_row", "group_size", "text_sha256"
    )
    members = index.where("NOT entry").select("part", "class", "doc_id", "row")
    return members.join(groups, ["part", "class"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("part") == F.col("keep_part")) & (F.col("row") == F.col("keep_row")))
        .alias("kept"),
        "text_sha256",
    )


def exact_copies(docs: DataFrame, index_path: str | None = None, **options) -> DataFrame:
    """The group of every row: doc_id, keep_id, group_size, kept, text_sha256.

    The index stays at ``index_path``, by default a new scratch folder.
    """
    spark = docs.sparkSession
    path = index_path or new_folder(spark, "exact-index")
    write_index(docs, path, **options)
    return grouped(spark, path)


def known_texts(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """doc_id and known: whether the index at ``path`` has the text.

    Texts are looked up by key and bytes; a hot text of ``docs`` is one row a
    batch on its way, as in the index.
    """
    first = spark.read.parquet(f"{path}/directory").select("key_bits").first()
    key_bits = first["key_bits"]
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = stored(
        entries_of(docs, Directory.of_loads({}, 1), owners, key_bits), "asked"
    )
    index = read_index(spark, path).where("text IS NOT NULL").select("key", "text")
    asked = sent.where("entry").join(
        index.withColumn("known", F.lit(True)), ["key", "text"], "left"
    )
    return (
        sent.where("NOT entry")
        .select("part", "class", "doc_id")
        .join(asked.select("part", "class", "known"), ["part", "class"])
        .select("doc_id", F.coalesce("known", F.lit(False)).alias("known"))
    )


def exact_copies_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: groups of equal texts among all documents."""
    return exact_copies(documents(spark, sf_dir))
