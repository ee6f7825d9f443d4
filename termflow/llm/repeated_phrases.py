"""Operator 5: passages of 20 words that also start earlier, by automata.

Rows are stored in blocks of 256, bucketed by block, so that later joins on the
block move no texts. Then, for the whole corpus:

1. Fingerprints: of every run of 11 ten-word phrases (that is, of every 20-word
   window) the one with the least hash. Equal windows pick equal phrases, so a
   window that occurs twice holds a phrase that does. Phrases met twice are
   confirmed in shards by hash; each block that holds one is told one place of it.
2. Each block reads its confirmed phrases at those places, compiles an
   Aho-Corasick automaton of them, and streams all its documents through it: all
   further occurrences are known from the automaton alone. Windows around them
   are dealt to shards by a 128-bit hash. Phrases that no document of the block
   holds can't match in it and are not in its shard of the automata.
3. The shards name, for each window that occurs twice, the block of its first
   start, and report to the others. Blocks cut the words of later windows.

A block sends each phrase and window once, so one that is in a third of all
documents costs a shard one entry per block. Tasks and shards are counted from
the characters of the texts, so that what a task holds does not grow with them.

Defined cases: NULL texts have no words and stay NULL; rows that share a doc_id
are documents of their own, ordered by their place in the input; NULL doc_ids
come first; texts without later windows stay as they are, in others whatever
stands between a removed run and the next kept word goes with it; extra columns
are kept; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termflow.llm.frames import free_name
from termflow.llm.quality import quoted
from termflow.llm.shingles import (
    U64,
    hashed_spans,
    mixed,
    window_hashes,
    word_spans,
)
from termflow.llm.storage import (
    TEXT_LEVEL,
    ZSTD_LEVEL,
    documents,
    new_folder,
    shuffles_removed,
)
from termflow.llm.token_blocks import arrow_schema

WINDOW = 20
PHRASE = 10
RUN = WINDOW - PHRASE + 1
BLOCK_BITS = 8
TOGETHER = 1 << 20
#: Shards a task gets, at least, so that tasks get even shares.
SHARDS_IN_TASK = 16
#: Characters of text a task should hold, at most.
IN_TASK = 16_000_000

SENT = "shard int, keys binary, more binary, docs binary, counts binary"
TOLD = "block bigint, keys binary, more binary, owned binary"
PLACES = "block bigint, docs binary"
INFO = "n_words bigint, n_removed bigint, kept_sha256 string"


def in_blocks(docs: DataFrame, row: str, block: str) -> tuple[DataFrame, int]:
    """The rows with number and block, as a table bucketed by block; its buckets."""
    spark = docs.sparkSession
    path = new_folder(spark, "blocks")
    table = "blocks_" + path.rsplit("-", 1)[1]
    # The shuffled texts go as soon as the blocks hold them.
    with shuffles_removed(spark):
        chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
        parts = max(
            int(spark.conf.get("spark.sql.shuffle.partitions")), int(chars) // IN_TASK
        )
        (
            docs.withColumn(row, F.monotonically_increasing_id())
            .withColumn(block, F.shiftright(row, BLOCK_BITS))
            .repartition(parts, block)
            .write.option("path", path)
            .options(compression="zstd", **{ZSTD_LEVEL: TEXT_LEVEL})
            .bucketBy(parts, block)
            .saveAsTable(table)
        )
    return spark.table(table), parts


def fingerprints(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases that are the least of some window's phrases: places and keys."""
    phrases = window_hashes(words, PHRASE)
    count = len(phrases) - RUN + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    views = np.lib.stride_tricks.sliding_window_view
    least = views(phrases, RUN).min(axis=1)
    # A phrase is the least of one of its windows if it is the largest minimum.
    padded = np.concatenate([np.zeros(RUN - 1, U64), least, np.zeros(RUN - 1, U64)])
    at = np.flatnonzero(views(padded, RUN).max(axis=1) == phrases)
    return at, phrases[at]


def second_keys(words: np.ndarray) -> np.ndarray:
    return window_hashes(mixed(words ^ U64(0x5851F42D4C957F2D)), WINDOW)


def window_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every window."""
    return window_hashes(words, WINDOW), second_keys(words)


def shard_bits(tasks: int) -> int:
    return max(10, (SHARDS_IN_TASK * tasks - 1).bit_length())


class Entries:
    """Keys to send: one entry per key and block, with its least document.

    ``doc`` is the document's number, or the places of the keys in it.
    """

    def __init__(self, schema: pa.Schema, bits: int):
        self.schema, self.bits = schema, bits
        self.parts, self.size = [], 0

    def add(self, keys, more, doc, row: int) -> None:
        if len(keys):
            n = len(keys)
            numbers = [np.broadcast_to(np.asarray(x, np.int64), n) for x in (doc, row)]
            self.parts.append((keys, more, *numbers))
            self.size += n

    def batch(self) -> pa.RecordBatch:
        keys, more, doc, row = map(np.concatenate, zip(*self.parts))
        order = np.lexsort((row, doc, row >> BLOCK_BITS, more, keys))
        keys, more, doc, row = (x[order] for x in (keys, more, doc, row))
        block = row >> BLOCK_BITS
        new = np.ones(len(keys), bool)
        new[1:] = (
            (keys[1:] != keys[:-1]) | (more[1:] != more[:-1]) | (block[1:] != block[:-1])
        )
        starts = np.flatnonzero(new)
        counts = np.diff(np.r_[starts, len(keys)]).astype(np.int64)
        keys, more, doc, row = (x[starts] for x in (keys, more, doc, row))
        # By shard, which rises with the key; documents as pairs of doc and row.
        shard = (keys >> U64(64 - self.bits)).astype(np.int64)
        edges = np.flatnonzero(np.r_[True, np.diff(shard) != 0, True])
        columns = keys, more, np.stack([doc, row], 1), counts
        out = [
            (int(shard[first]), *(x[first:last].tobytes() for x in columns))
            for first, last in zip(edges, edges[1:])
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out), self.schema)],
            schema=self.schema,
        )


def found_twice(sent: DataFrame, tasks: int, places: bool = False) -> DataFrame:
    """Tell each block which of its keys occur twice, and which it has first.

    With ``places``: tell it only what was sent as document of these keys.
    """
    told = PLACES if places else TOLD
    schema = arrow_schema(told)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for _, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                keys, more = (np.frombuffer(x, U64) for x in parts[:2])
                docs = np.frombuffer(parts[2], np.int64).reshape(-1, 2)
                counts = np.frombuffer(parts[3], np.int64)
                held.append((keys, more, docs, counts))
        if not held:
            return
        keys, more, docs, counts = map(np.concatenate, zip(*held))
        held.clear()
        block = docs[:, 1] >> BLOCK_BITS
        order = np.lexsort((docs[:, 1], docs[:, 0], more, keys))
        keys, more, counts, block = (x[order] for x in (keys, more, counts, block))
        new = np.r_[True, (keys[1:] != keys[:-1]) | (more[1:] != more[:-1])]
        starts = np.flatnonzero(new)
        lengths = np.diff(np.r_[starts, len(keys)])
        twice = np.repeat(np.add.reduceat(counts, starts) > 1, lengths)
        if places:
            columns = [docs[order[twice]]]
        else:
            owner = np.repeat(block[starts], lengths)
            columns = [x[twice] for x in (keys, more, block == owner)]
        block = block[twice]
        if not len(block):
            return
        order = np.argsort(block, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(block[order]) != 0, True])
        out = [
            (int(block[own[0]]), *(x[own].tobytes() for x in columns))
            for own in (order[a:b] for a, b in zip(edges, edges[1:]) if b > a)
        ]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), schema)],
                schema=schema,
            )

    return sent.repartition(tasks, "shard").mapInArrow(meet, told)


def in_order(doc_id: int | None) -> int:
    return -(1 << 63) if doc_id is None else doc_id


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def confirmed_phrases(table: DataFrame, row: str, tasks: int) -> DataFrame:
    """Step 1: blocks with a place of each of their phrases that occur twice."""
    schema, bits = arrow_schema(SENT), shard_bits(tasks)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = Entries(schema, bits)
        for batch in batches:
            for number, text in zip(batch[0], batch[1]):
                data = encoded(text.as_py())
                words = hashed_spans(data, *word_spans(data))
                at, keys = fingerprints(words)
                entries.add(keys, keys, at, number.as_py())
                if entries.size >= TOGETHER:
                    yield entries.batch()
                    entries = Entries(schema, bits)
        if entries.size:
            yield entries.batch()

    sent = table.select(row, "text").mapInArrow(index, SENT)
    return found_twice(sent, tasks, places=True)


def found_in(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of x are among the sorted keys, and their first places there."""
    place = np.searchsorted(keys, x)
    place[place == len(keys)] = 0
    return keys[place] == x, place


def told_keys(told: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys reported to a block, sorted: both hashes and whether it has the first."""
    parts = [b"".join(told[name].to_pylist()) for name in ("keys", "more", "owned")]
    keys, more = (np.frombuffer(x, U64) for x in parts[:2])
    owned = np.frombuffer(parts[2], bool)
    order = np.lexsort((more, keys))
    return keys[order], more[order], owned[order]


def spaced(data: bytes) -> tuple[bytes, np.ndarray]:
    """The words between single spaces, and where these spaces stand."""
    plain = b" " + b" ".join(data.split()) + b" "
    return plain, np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)


def phrase_automaton(texts: list[tuple[bytes, np.ndarray]], places: np.ndarray):
    """The automaton of the phrases at these places: rows of word and text."""
    import ahocorasick

    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for word, k in places.tolist():
        plain, spaces = texts[k]
        # Bytes as letters, a space before and after every word.
        phrase = plain[spaces[word] : spaces[word + PHRASE] + 1]
        automaton.add_word(phrase.decode("latin-1"))
    if len(automaton):
        automaton.make_automaton()
    return automaton


def located(text: tuple[bytes, np.ndarray], automaton) -> np.ndarray:
    """Starts of the windows of a text that hold a phrase of the automaton."""
    plain, spaces = text
    count = len(spaces) - WINDOW
    if count <= 0 or not len(automaton):
        return np.zeros(0, np.int64)
    found = np.array(list(automaton.iter(plain.decode("latin-1"))), np.int64)
    if not len(found):
        return np.zeros(0, np.int64)
    at = np.searchsorted(spaces, found[:, 0] - found[:, 1] + 1)
    # Windows that hold the phrase start up to RUN - 1 words before it.
    change = np.zeros(len(spaces) + 1, np.int64)
    np.add.at(change, np.maximum(at - RUN + 1, 0), 1)
    np.add.at(change, at + 1, -1)
    return np.flatnonzero(np.cumsum(change)[:count] > 0)


def located_windows(
    table: DataFrame, row: str, block: str, told: DataFrame, tasks: int
) -> DataFrame:
    """Step 2: every block's windows around confirmed phrases, to shards."""
    schema, bits = arrow_schema(SENT), shard_bits(tasks)
    docs = table.select(
        F.col(block).alias("block"), F.col(row).alias("row"), "doc_id", "text"
    )

    def stream(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        left = left.sort_by("row")
        texts = [spaced(encoded(x)) for x in left["text"].to_pylist()]
        rows = left["row"].to_numpy()
        told = np.frombuffer(b"".join(right["docs"].to_pylist()), np.int64)
        places = told.reshape(-1, 2).copy()
        places[:, 1] = np.searchsorted(rows, places[:, 1])
        automaton = phrase_automaton(texts, places)
        entries = Entries(schema, bits)
        for text, number, doc in zip(texts, rows.tolist(), left["doc_id"].to_pylist()):
            at = located(text, automaton)
            if len(at):
                plain, spaces = text
                words = hashed_spans(plain, spaces[:-1] + 1, spaces[1:])
                keys, more = (x[at] for x in window_keys(words))
                entries.add(keys, more, in_order(doc), number)
        if not entries.size:
            return schema.empty_table()
        return pa.Table.from_batches([entries.batch()])

    return (
        docs.groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInArrow(stream, SENT)
    )


def later_windows(
    words: np.ndarray, told: tuple[np.ndarray, ...], seen: set[int]
) -> np.ndarray:
    """Starts of the document's windows that also start earlier.

    ``seen`` holds places of the block's own keys met before in its documents.
    """
    keys, more, owned = told
    if len(words) < WINDOW or not len(keys):
        return np.zeros(0, np.int64)
    first = window_hashes(words, WINDOW)
    known, place = found_in(keys, first)
    at, place = np.flatnonzero(known), place[known]
    if not len(at):
        return at
    second = second_keys(words)
    # Equal first hashes are rare: walk on while the second one differs.
    while True:
        wrong = more[place] != second[at]
        further = np.minimum(place + 1, len(keys) - 1)
        go_on = wrong & (keys[further] == first[at]) & (further != place)
        if not go_on.any():
            break
        place = np.where(go_on, further, place)
    at, place = at[~wrong], place[~wrong]
    later = ~owned[place]
    for k in np.flatnonzero(owned[place]).tolist():
        later[k] = int(place[k]) in seen
        seen.add(int(place[k]))
    return at[later]


def cut(data: bytes, removed: np.ndarray, starts, ends) -> tuple[str, str]:
    """The text without removed words, and the kept words joined by spaces."""
    letters = data.decode("latin-1")
    firsts = starts.tolist()
    kept = np.flatnonzero(~removed)
    words = [letters[firsts[k] : ends[k]] for k in kept.tolist()]
    edges = np.flatnonzero(np.diff(np.r_[False, removed, False].astype(np.int8)))
    parts, at = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        parts.append(letters[at : firsts[a]])
        at = firsts[b] if b < len(firsts) else len(letters)
    parts.append(letters[at:])
    return tuple(
        x.encode("latin-1").decode("utf-8") for x in ("".join(parts), " ".join(words))
    )


def without_repeated_phrases(docs: DataFrame, info: str | None = None) -> DataFrame:
    """The rows of ``docs``, with the words of later windows cut from text.

    ``info`` names a struct column to add: n_words, n_removed, kept_sha256.
    """
    own = list(docs.columns)
    row, block = free_name(docs, "row_number"), free_name(docs, "block")
    table, tasks = in_blocks(docs, row, block)
    phrases = confirmed_phrases(table, row, tasks)
    windows = found_twice(located_windows(table, row, block, phrases, tasks), tasks)
    counted = free_name(docs, "counted")
    fields = StructType(
        [*table.schema.fields, *StructType.fromDDL(f"{counted} struct<"
         + INFO.replace(" bigint", ":bigint").replace(" string", ":string")
         + ">").fields]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(fields)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        ids = [in_order(x) for x in left["doc_id"].to_pylist()]
        left = left.take(np.lexsort((left[row].to_numpy(), ids)))
        told = told_keys(right) if right.num_rows else ((), (), ())
        texts, infos, seen = [], [], set()
        for text in left["text"].to_pylist():
            data = encoded(text)
            starts, ends = word_spans(data)
            words = hashed_spans(data, starts, ends) if len(told[0]) else ()
            later = later_windows(words, told, seen)
            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, later, 1)
            np.add.at(change, later + WINDOW, -1)
            removed = np.cumsum(change)[:-1] > 0
            if len(later):
                text, words_text = cut(data, removed, starts, ends)
            else:
                words_text = b" ".join(data.split()).decode()
            texts.append(text)
            infos.append(
                {
                    "n_words": len(starts),
                    "n_removed": int(removed.sum()),
                    "kept_sha256": hashlib.sha256(words_text.encode()).hexdigest(),
                }
            )
        columns = [
            pa.array(texts, field.type)
            if field.name == "text"
            else pa.array(infos, field.type)
            if field.name == counted
            else left[field.name].cast(field.type)
            for field in schema
        ]
        return pa.Table.from_arrays(columns, schema=schema)

    finished = (
        table.groupBy(block)
        .cogroup(windows.withColumnRenamed("block", block).groupBy(block))
        .applyInArrow(finish, fields)
    )
    columns = [quoted(x) for x in own]
    return finished.select(*columns, *([F.col(counted).alias(info)] if info else []))


def repeated_phrases_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: words of all documents, removed ones, and what is left."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return without_repeated_phrases(docs, "words").select(
        "doc_id", "words.n_words", "words.n_removed", "words.kept_sha256"
    )
