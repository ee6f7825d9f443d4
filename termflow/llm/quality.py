"""Operator 10: quality rules, with distributions compared to references.

Base rules count words, symbols, repeated lines and repeated eight-word windows.
For the verdict, each document's histograms of character classes and of common
words are compared with those of its language by Jensen-Shannon distance (the
root of the divergence to base 2, so 0 to 1). A language's reference is the mean
histogram of all its documents that pass the base rules and are long enough; a
language with fewer than ``LEAST_DOCUMENTS`` of them, or NULL, is compared with
the mean of all. Common words are a small share of any text, so their distances
have no fixed limit: it is ``WORD_SPREAD`` times the mean distance that the
documents behind a reference have from it. Histograms and distances are summed in
millionths as whole numbers, so the sums do not depend on the order of rows. Too
short documents are not compared.

Native expressions only. Windows are compared by 64-bit hashes of their words.

Defined cases: NULL and empty texts have no words and fail the base rules; rows
are judged each by itself, repeated or not; further columns are kept as they
are, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow.llm.frames import NOT_BLANK, free_name, let, split_words
from termflow.llm.storage import TEXT_LEVEL, documents, stored

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
#: Lengths from which on a histogram is compared.
LEAST_CHARS_COMPARED = 200
LEAST_WORDS_COMPARED = 50
LEAST_DOCUMENTS = 20
MOST_CLASS_DISTANCE = 0.35
#: Word distances up to so many times the mean one of the reference are kept.
WORD_SPREAD = 2
#: References of so many languages are sent to all tasks; more are joined.
MOST_BROADCAST = 2000
WHOLE = 1_000_000

#: Frequent short words of four languages; another language's texts and its
#: reference then differ in character classes only.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for",
    "le", "la", "les", "et", "que", "du", "une", "qui",
    "der", "die", "und", "den", "das", "ist", "nicht", "mit",
    "el", "los", "las", "por", "con", "una", "para", "del",
)
#: Characters that are neither letters nor in another class count as others.
CLASSES = {
    "upper": r"\p{Lu}",
    "letter": r"\p{L}",  # of either case
    "digit": r"\p{N}",
    "mark": r".,;:!?'\"()\-",
    "symbol": r"#*$%&|<>",
}
SYMBOLS = CLASSES["symbol"]


def count_of(text: Column, characters: str) -> Column:
    """Code points of a class: what is left without the runs of all others."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", "")).cast("bigint")


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words in windows found twice or more in the array."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - width)
        return F.transform(
            places, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(width)))
        )

    def found_twice(w: Column) -> Column:
        """Sorted places of the windows that have an equal one."""
        placed = F.sort_array(
            F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def places(s: Column) -> Column:
            def twice(x: Column, k: Column) -> Column:
                hash_at = lambda at: F.get(s, at)["h"]
                equal = (hash_at(k - 1) == x["h"]) | (hash_at(k + 1) == x["h"])
                return F.when(equal, x["i"])

            return F.sort_array(F.array_compact(F.transform(s, twice)))

        return let(placed, places)

    def covered(p: Column) -> Column:
        """Length of the union of the windows at these places."""
        steps = F.transform(
            p,
            lambda x, k: F.least(
                F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width))
            ),
        )
        return F.aggregate(
            steps, F.lit(0).cast("bigint"), lambda total, x: total + x
        )

    def in_windows(w: Column) -> Column:
        unique = F.size(F.array_distinct(w)) == F.size(w)
        return F.when(unique, F.lit(0).cast("bigint")).otherwise(
            let(found_twice(w), covered)
        )

    return F.when(F.size(words) < width, F.lit(0).cast("bigint")).otherwise(
        let(hashes, lambda h: let(windows(h), in_windows))
    )


def repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANK))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast(
        "bigint"
    )


def measure(docs: DataFrame, name: str) -> DataFrame:
    """Add one struct column of counts and histograms."""
    text = F.coalesce("text", F.lit(""))
    words = free_name(docs, "words")
    own = list(docs.columns)
    split = docs.withColumn(words, split_words(F.col("text")))
    w = F.col(words)
    known = [word.lower() for word in COMMON_WORDS]
    written = [*known, *(word.capitalize() for word in known)]
    hits = F.transform(
        F.filter(w, lambda x: x.isin(*written)), lambda x: F.lower(x)
    )
    common = let(
        hits,
        lambda h: F.array(
            *(
                (F.size(h) - F.size(F.array_remove(h, word))).cast("bigint")
                for word in known
            )
        ),
    )
    classes = [count_of(text, c).alias(c_name) for c_name, c in CLASSES.items()]
    counts = free_name(split, "counts")
    lang = F.col("lang") if "lang" in own else F.lit(None).cast("string")
    counted = split.select(
        *map(quoted, own),
        F.struct(
            lang.alias("lang"),
            F.size(w).cast("bigint").alias("n_words"),
            F.length(text).cast("bigint").alias("n_chars"),
            F.length(F.concat_ws("", w)).cast("bigint").alias("word_chars"),
            *classes,
            repeated_lines(text).alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            common.alias("common"),
        ).alias(counts),
    )
    c = F.col(counts)
    failed = (c["n_words"] < LEAST_WORDS) | (
        100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"]
    )
    blank = c["n_chars"] - c["word_chars"]
    lower = c["letter"] - c["upper"]
    marks = [c["digit"], c["mark"], c["symbol"]]
    other = c["word_chars"] - c["letter"] - reduce(lambda a, b: a + b, marks)
    in_class = [c["upper"], lower, *marks, blank]
    plain = c["n_words"] - F.aggregate(
        c["common"], F.lit(0).cast("bigint"), lambda total, x: total + x
    )
    return counted.select(
        *map(quoted, own),
        F.struct(
            c["lang"].alias("lang"),
            c["n_words"].alias("n_words"),
            c["word_chars"].alias("word_chars"),
            c["symbol"].alias("n_symbols"),
            c["n_dup_lines"].alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
            failed.alias("base_failed"),
            F.when(
                c["n_chars"] >= LEAST_CHARS_COMPARED,
                shares(F.array(*in_class, other), c["n_chars"]),
            ).alias("classes"),
            F.when(
                c["n_words"] >= LEAST_WORDS_COMPARED,
                shares(F.concat(c["common"], F.array(plain)), c["n_words"]),
            ).alias("common"),
        ).alias(name),
    )


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def shares(counts: Column, total: Column) -> Column:
    """Counts as whole millionths of their total."""
    return F.transform(counts, lambda x: (x * WHOLE / total).cast("bigint"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms in any units."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)

    def term(a: Column, b: Column) -> Column:
        # log2 of 0 is not needed: such terms are 0.
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    def of_totals(sums: Column) -> Column:
        parts = F.zip_with(
            p,
            q,
            lambda a, b: let(
                F.struct((a / sums["p"]).alias("a"), (b / sums["q"]).alias("b")),
                lambda x: term(x["a"], x["b"]) + term(x["b"], x["a"]),
            ),
        )
        return F.sqrt(F.greatest(total(parts) / 2, F.lit(0.0)))

    return let(F.struct(total(p).alias("p"), total(q).alias("q")), of_totals)


BINS = {"classes": 7, "common": len(COMMON_WORDS) + 1}


def summed(kind: str, of: Column) -> list[Column]:
    return [
        F.coalesce(F.sum(F.get(of, F.lit(k))), F.lit(0)).alias(f"{kind}{k}")
        for k in range(BINS[kind])
    ]


def references(measured: DataFrame, name: str) -> DataFrame:
    """Per language: reference histograms, and under NULL those of all."""
    m = F.col(name)
    by_lang = (
        measured.where(
            ~m["base_failed"] & m["classes"].isNotNull() & m["common"].isNotNull()
        )
        .groupBy(m["lang"].alias("lang"))
        .agg(
            F.count("*").alias("n"),
            *summed("classes", m["classes"]),
            *summed("common", m["common"]),
        )
    )
    sums = [f"{kind}{k}" for kind in BINS for k in range(BINS[kind])]
    all_of_them = by_lang.agg(
        F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in sums)
    )
    both = by_lang.where(
        F.col("lang").isNotNull() & (F.col("n") >= LEAST_DOCUMENTS)
    ).unionByName(all_of_them.withColumn("lang", F.lit(None).cast("string")))
    arrays = [
        F.array(*(f"{kind}{k}" for k in range(BINS[kind]))).alias(f"ref_{kind}")
        for kind in BINS
    ]
    return both.select("lang", *arrays)


def with_spreads(refs: DataFrame, measured: DataFrame, name: str) -> DataFrame:
    """The references with spread: mean word distance of their own documents."""
    m = F.col(name)
    words = measured.where(
        ~m["base_failed"] & m["classes"].isNotNull() & m["common"].isNotNull()
    ).select(m["lang"].alias("of_lang"), m["common"].alias("common"))
    whole = F.broadcast(
        refs.where("lang is null").select(F.col("ref_common").alias("whole"))
    )
    own = refs.where("lang is not null").select("lang", "ref_common")
    if own.count() <= MOST_BROADCAST:
        own = F.broadcast(own)

    def millionths(to: str) -> Column:
        far = distance(F.col("common"), F.col(to))
        return F.when(F.col(to).isNotNull(), F.round(far * WHOLE).cast("bigint"))

    sums = (
        words.crossJoin(whole)
        .join(own, F.col("of_lang") == F.col("lang"), "left")
        .select(
            "lang",
            millionths("ref_common").alias("own"),
            millionths("whole").alias("whole"),
        )
        .groupBy("lang")
        .agg(
            F.count("*").alias("n"),
            F.sum("own").alias("own"),
            F.sum("whole").alias("whole"),
        )
    )
    sums = stored(sums, "spreads")
    mean = lambda total, n: F.col(total) / F.col(n) / WHOLE
    spreads = sums.where("lang is not null").select("lang", mean("own", "n").alias("spread"))
    of_all = sums.agg(F.sum("whole").alias("whole"), F.sum("n").alias("n")).select(
        F.lit(None).cast("string").alias("lang"), mean("whole", "n").alias("spread")
    )
    spreads = spreads.unionByName(of_all).withColumnRenamed("lang", "spread_lang")
    return refs.join(
        spreads, F.col("lang").eqNullSafe(F.col("spread_lang")), "left"
    ).drop("spread_lang")


def judge(measured: DataFrame, name: str) -> DataFrame:
    """Add class_distance, word_distance, word_limit and kept to the struct."""
    refs = stored(references(measured, name), "references")
    refs = stored(with_spreads(refs, measured, name), "references")
    whole = refs.where("lang is null").first()
    ref = free_name(measured, "reference")
    refs = refs.where("lang is not null").select(
        F.col("lang").alias(ref),
        F.struct("ref_classes", "ref_common", "spread").alias(ref + "s"),
    )
    if refs.count() <= MOST_BROADCAST:
        refs = F.broadcast(refs)
    m, r = F.col(name), F.col(ref + "s")

    def of(kind: str) -> Column:
        mean = F.array(*(F.lit(int(x or 0)) for x in whole[f"ref_{kind}"]))
        return F.coalesce(r[f"ref_{kind}"], mean)

    def far(kind: str) -> Column:
        return F.when(m[kind].isNotNull(), distance(m[kind], of(kind)))

    # Without a base-passed document there is no spread, and none is kept.
    spread = F.coalesce(r["spread"], F.lit(float(whole["spread"] or 0.0)))
    own = [x for x in measured.columns if x != name]
    judged = measured.join(refs, m["lang"] == F.col(ref), "left").select(
        *map(quoted, own),
        m.withField("class_distance", far("classes"))
        .withField("word_distance", far("common"))
        .withField("word_limit", WORD_SPREAD * spread)
        .alias(name),
    )
    too_far = (F.coalesce(m["class_distance"], F.lit(0.0)) > MOST_CLASS_DISTANCE) | (
        F.coalesce(m["word_distance"], F.lit(0.0)) > m["word_limit"]
    )
    return judged.withColumn(
        name, m.withField("kept", ~m["base_failed"] & ~too_far)
    )


def judged_documents(docs: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` with a struct of counts, distances and verdict.

    The measures are stored: references need them all before any verdict.
    """
    return judge(stored(measure(docs, name), "measures", TEXT_LEVEL), name)


def keep_good_documents(docs: DataFrame) -> DataFrame:
    """The rows whose verdict is kept, with their own columns only."""
    name = free_name(docs, "quality")
    return (
        judged_documents(docs, name)
        .where(F.col(name)["kept"])
        .select(*map(quoted, docs.columns))
    )


COLUMNS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "base_failed", "kept",
)


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: counts and verdict of all documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    measured = stored(measure(docs, "quality").drop("text", "lang"), "measures")
    return judge(measured, "quality").select(
        "doc_id", *(F.col("quality")[c].alias(c) for c in COLUMNS)
    )
