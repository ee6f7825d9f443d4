"""Operator 4: language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A letter trigram binds them: the
product of its letters' vectors, rotated by their place. A document bundles the
trigrams of its lower-cased words, a language the documents it was learned from.
A document gets the language whose prototype has the highest cosine with it.

Learned from a sample of about ``SAMPLE`` documents per language, chosen by a
hash of doc_id, for every language there is; nothing but text and lang is
learned from, and only text decides. The prototypes, one vector a language, are
what the driver and each task hold.

Defined cases: texts that are NULL or have no letter are ``und`` with score 0;
without any learned language all are; equal cosines go to the first name; rows
with NULL doc_id are neither held out nor learned from; repeated rows and extra
columns change nothing; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow.llm.storage import documents, stored
from termflow.llm.token_blocks import arrow_schema
from termflow.operators.broadcasts import broadcast_if_small

DIMENSIONS = 1024
SAMPLE = 2000
#: Tasks that sum the sample, at least: each adds up its vectors by language.
TASKS = 12
TOGETHER = 256  # documents whose trigrams are looked up at once
SLICE = 8192  # trigrams whose vectors are made at once
LETTERS = 8192  # letter vectors remembered
SCALE = 1000  # unit vectors are summed as whole numbers of this scale
UNKNOWN = "und"
SUMS = "lang string, sums array<bigint>"
OUT = "doc_id bigint, held_out boolean, lang_pred string, score double"
_state: dict = {}


def letter_codes() -> np.ndarray:
    """Code point to lower-case letter, or to a space."""
    if "codes" not in _state:
        codes = np.full(0x110000, 32, np.int64)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                codes[point] = ord(char.lower()[0])
        _state["codes"] = codes
    return _state["codes"]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct trigrams as numbers and their counts; None without letters."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    letters = np.concatenate(([32], letter_codes()[points], [32]))
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != 32) | (letters[:-1] != 32)
    letters = letters[keep]
    if len(letters) < 3:
        return None
    return np.unique(
        letters[:-2] << 42 | letters[1:-1] << 21 | letters[2:],
        return_counts=True,
    )


def letter_vector(point: int) -> np.ndarray:
    memory = _state.setdefault("letters", {})
    if point not in memory:
        if len(memory) >= LETTERS:
            memory.clear()
        bits = np.random.default_rng(point).integers(0, 2, DIMENSIONS)
        memory[point] = (2 * bits - 1).astype(np.float32)
    return memory[point]


def bound(grams: np.ndarray) -> np.ndarray:
    """A row per trigram: its letters' rotated vectors, multiplied."""
    out = None
    for shift in (2, 1, 0):
        points, place = np.unique(
            grams >> (21 * shift) & 0x1FFFFF, return_inverse=True
        )
        rows = np.stack([np.roll(letter_vector(int(p)), shift) for p in points])
        out = rows[place] if out is None else np.multiply(out, rows[place], out=out)
    return out


def bundled(texts: list[str | None]) -> Iterator[np.ndarray | None]:
    """Each document's vector of unit length; None without letters."""
    for at in range(0, len(texts), TOGETHER):
        found = [trigrams(t) if t else None for t in texts[at : at + TOGETHER]]
        some = [f for f in found if f is not None]
        sums = np.zeros((len(some), DIMENSIONS), np.float32)
        grams = np.unique(np.concatenate([f[0] for f in some])) if some else ()
        for first in range(0, len(grams), SLICE):
            own = grams[first : first + SLICE]
            vectors = bound(own)
            for k, (keys, counts) in enumerate(some):
                a, b = np.searchsorted(keys, [own[0], own[-1] + 1])
                if a < b:
                    rows = vectors[np.searchsorted(own, keys[a:b])]
                    sums[k] += counts[a:b].astype(np.float32) @ rows
        vectors = iter(sums)
        for f in found:
            if f is None:
                yield None
                continue
            vector = next(vectors)
            length = float(np.sqrt(np.dot(vector, vector)))
            yield vector / length if length else vector


def is_held_out() -> Column:
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> dict[str, np.ndarray]:
    """Language to prototype of unit length."""
    rows = docs.where(
        ~is_held_out()
        & F.col("doc_id").isNotNull()
        & F.col("lang").isNotNull()
        & F.col("text").isNotNull()
    )
    counts = stored(
        rows.groupBy("lang").agg(F.count("*").alias("of_lang")), "languages"
    )
    languages = counts.count()
    parts = 1 << 30
    place = F.pmod(F.xxhash64("doc_id"), F.lit(parts))
    sample = (
        rows.select("lang", "text", place.alias("place"))
        .join(broadcast_if_small(counts), "lang")
        .where(F.col("place") < F.floor(F.lit(parts * SAMPLE) / F.col("of_lang")))
        .select("lang", "text")
        .repartition(max(TASKS, languages))
    )
    schema = arrow_schema(SUMS)

    def batch_of(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"lang": list(sums), "sums": [v.tolist() for v in sums.values()]}, schema
        )

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            vectors = bundled(batch["text"].to_pylist())
            for lang, vector in zip(batch["lang"].to_pylist(), vectors):
                if vector is not None:
                    whole = np.rint(SCALE * vector).astype(np.int64)
                    sums[lang] = sums.get(lang, 0) + whole
            if len(sums) > TOGETHER:
                yield batch_of(sums)
                sums = {}
        yield batch_of(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, part in zip(batch["lang"].to_pylist(), batch["sums"].to_pylist()):
                sums[lang] = sums.get(lang, 0) + np.array(part, np.int64)
        yield batch_of(sums)

    totals = sample.mapInArrow(bundle, SUMS).repartition("lang").mapInArrow(add, SUMS)
    prototypes = {r["lang"]: np.array(r["sums"], np.float64) for r in totals.collect()}
    return {
        lang: (total / np.linalg.norm(total)).astype(np.float32)
        for lang, total in sorted(prototypes.items())
        if total.any()
    }


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    schema = arrow_schema(OUT)
    names = list(prototypes)
    matrix = np.stack(list(prototypes.values())) if names else None

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for vector in bundled(batch["text"].to_pylist()):
                lang, score = UNKNOWN, 0.0
                if vector is not None and names:
                    cosines = matrix @ vector
                    best = int(np.argmax(cosines))
                    lang = names[best]
                    score = float(np.clip(cosines[best], 0, 1))
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].cast(pa.int64()),
                    batch["held_out"],
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                ],
                schema=schema,
            )

    return docs.select("doc_id", is_held_out().alias("held_out"), "text").mapInArrow(
        compare, OUT
    )


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: language of all documents."""
    docs = documents(spark, sf_dir)
    return predict(docs, learn(docs))
