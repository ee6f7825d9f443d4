"""Operator 1: token ids in Re-Pair compressed blocks.

Documents are dealt to ranges of ascending doc_id, encoded word by word, and
gathered in blocks of about ``BLOCK_IDS`` ids. Each block is a grammar of its
own: rules, their expansion lengths and the remaining symbols, so any document
can be decoded without the rest. The container is Parquet, so writes are
committed per task and blocks survive lost executors.

Defined cases: NULL and empty texts hold the end id only; rows that share a
doc_id are all kept, ordered by text; NULL doc_ids come first; further columns
are ignored; an empty table gives an empty one. A block ends after the document
that fills it, so it holds one very long document whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termflow.llm.repair import (
    Grammar,
    build_grammar,
    expand_all,
    read_range,
)
from termflow.llm.storage import documents, new_folder
from termflow.llm.vocabulary import (
    WORD_BPE,
    WordBpe,
    loaded,
    vocabulary_path,
)

BLOCK_IDS = 1 << 20
END_ID = 1

BLOCKS = (
    "part int, block int, doc_ids array<bigint>, n_ids array<bigint>, "
    "total bigint, base bigint, rule_left binary, rule_right binary, "
    "rule_lengths binary, symbols binary"
)
FOUND = (
    "part int, block int, doc_id bigint, in_block bigint, n_tokens bigint, "
    "ids_crc32 bigint"
)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def write_blocks(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode ``text`` of every row and write blocks in order of doc_id."""
    vocabulary = vocabulary or vocabulary_path(WORD_BPE)
    schema = arrow_schema(BLOCKS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(WordBpe, vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        block, doc_ids, ids, held = 0, [], [], 0

        def packed() -> pa.RecordBatch:
            grammar = build_grammar(np.frombuffer(b"".join(ids), "<u4"))
            row = {
                "part": part,
                "block": block,
                "doc_ids": doc_ids,
                "n_ids": [len(x) // 4 for x in ids],
                "total": held,
                "base": grammar.base,
                "rule_left": grammar.left.tobytes(),
                "rule_right": grammar.right.tobytes(),
                "rule_lengths": grammar.lengths.tobytes(),
                "symbols": grammar.symbols.tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                doc_ids.append(doc_id.as_py())
                ids.append(encoder.encode(text.as_py()) + end)
                held += len(ids[-1]) // 4
                if held >= block_ids:
                    yield packed()
                    block, doc_ids, ids, held = block + 1, [], [], 0
        if doc_ids:
            yield packed()

    order = ["doc_id", F.xxhash64("text"), "text"]
    (
        docs.select("doc_id", "text")
        .repartitionByRange(*order[:2])
        .sortWithinPartitions(*order)
        .mapInArrow(encode, BLOCKS)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def grammar_of(row: dict) -> Grammar:
    def numbers(name):
        return np.frombuffer(row[name], "<u4")

    return Grammar(
        row["base"],
        numbers("rule_left"),
        numbers("rule_right"),
        numbers("rule_lengths"),
        numbers("symbols"),
    )


def read_document(row: dict, place: int) -> np.ndarray:
    """Ids of the block's document number ``place``, by random access."""
    start = sum(row["n_ids"][:place])
    return read_range(grammar_of(row), start, start + row["n_ids"][place])


def block_starts(blocks: DataFrame) -> DataFrame:
    """(part, block, before): ids in all blocks before, without the payload.

    Sums run over the blocks of one part, and over parts: as many rows as the
    writing job had tasks.
    """
    sizes = blocks.select("part", "block", "total")
    parts = sizes.groupBy("part").agg(F.sum("total").alias("in_part"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part",
        F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("base"),
    )
    within = (
        Window.partitionBy("part")
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        sizes.withColumn(
            "inside", F.coalesce(F.sum("total").over(within), F.lit(0))
        )
        .join(parts, "part")
        .select("part", "block", (F.col("base") + F.col("inside")).alias("before"))
    )


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Decode every block: doc_id, start, n_tokens, ids_crc32."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    schema = arrow_schema(FOUND)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.ascontiguousarray(expand_all(grammar_of(row)), "<u4")
                ends = np.cumsum(row["n_ids"])
                starts = ends - row["n_ids"]
                count = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * count, pa.int32()),
                        pa.array([row["block"]] * count, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(row["n_ids"], pa.int64()),
                        pa.array(
                            [
                                zlib.crc32(ids[a:b])
                                for a, b in zip(starts, ends)
                            ],
                            pa.int64(),
                        ),
                    ],
                    schema=schema,
                )

    return (
        blocks.drop("total")
        .mapInArrow(decode, FOUND)
        .join(block_starts(blocks), ["part", "block"])
        .select(
            "doc_id",
            (F.col("before") + F.col("in_block")).alias("start"),
            "n_tokens",
            "ids_crc32",
        )
    )


def token_blocks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: write the blocks of all documents and read them back."""
    path = new_folder(spark, "token-blocks")
    write_blocks(documents(spark, sf_dir), path)
    return read_blocks(spark, path)
