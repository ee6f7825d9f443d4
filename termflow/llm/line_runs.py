"""Operator 2: later copies of repeated line runs, by prefix doubling.

The lines of a document that hold a word form a sequence of line ids (128-bit
hashes). Suffixes of all sequences are put in classes that share their first
2^k lines, for k = 0, 1, ...: the class at k + 1 is the pair of the classes of
two neighbouring halves. A class is named by its first suffix in the order of
(doc_id, row, line). Suffixes sorted by their names at k = 0, 1, 2, ... form the
suffix array up to the order of siblings, so classes at k are the intervals
whose longest common prefix is 2^k lines or more. Suffixes alone in their class
leave; doubling ends when none is left.

Each suffix with an earlier one in its class takes the first suffix of its
longest such class, and halving steps find the exact length of their common
prefix: a maximal run and its source. Lines in runs are deleted, a run of one
line included. ``least_characters`` spares runs of one shorter line; it is off
by default.

Native expressions only. Names come from aggregates that combine before the
shuffle; classes of any size are joined back, where a hot one can be split.

Defined cases: NULL texts stay NULL and empty ones empty; lines without a word
are never deleted and do not separate runs; rows that share a doc_id are ordered
by their place in the input; NULL doc_ids come first; a document may lose all
its lines with words; further columns are kept; an empty table gives an empty
one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termflow.llm.frames import NOT_BLANK, free_name
from termflow.llm.quality import quoted
from termflow.llm.storage import TEXT_LEVEL, documents, stored


def numbered(docs: DataFrame, row: str) -> DataFrame:
    """The rows with a number, stored so that it stays the same."""
    return stored(
        docs.withColumn(row, F.monotonically_increasing_id()), "documents", TEXT_LEVEL
    )


def line_sequences(docs: DataFrame, row: str) -> DataFrame:
    """row, doc_id, seq (place in the sequence), line_no, h1, h2, chars."""
    lines = F.filter(
        F.transform(
            F.split("text", "\n"),
            lambda line, k: F.struct(k.alias("line_no"), line.alias("line")),
        ),
        lambda x: x["line"].rlike(NOT_BLANK),
    )
    return docs.select(
        F.col(row).alias("row"), "doc_id", F.posexplode(lines).alias("seq", "x")
    ).select(
        "row",
        "doc_id",
        "seq",
        F.col("x.line_no").alias("line_no"),
        F.xxhash64("x.line").alias("h1"),
        F.xxhash64(F.lit(1), "x.line").alias("h2"),
        F.length("x.line").alias("chars"),
    )


def classes(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """row, doc_id, seq and the class's first suffix; single ones left out."""
    first = (
        suffixes.groupBy(*keys)
        .agg(
            F.min(F.struct("doc_id", "row", "seq")).alias("first"),
            F.count("*").alias("n"),
        )
        .where("n > 1")
        .select(
            *keys,
            F.col("first.row").alias("first_row"),
            F.col("first.seq").alias("first_seq"),
        )
    )
    return suffixes.join(first, keys).select(
        "row", "doc_id", "seq", "first_row", "first_seq"
    )


def doubled(level: DataFrame, step: int) -> DataFrame:
    """Suffixes with the classes of both halves of twice the length."""
    right = level.select(
        "row",
        (F.col("seq") - step).alias("seq"),
        F.col("first_row").alias("next_row"),
        F.col("first_seq").alias("next_seq"),
    )
    return level.join(right, ["row", "seq"])


def doubling(lines: DataFrame) -> list[DataFrame]:
    """Classes of suffixes that share their first 1, 2, 4, ... lines."""
    levels = [stored(classes(lines, ["h1", "h2"]), "level")]
    while not levels[-1].isEmpty():
        pairs = doubled(levels[-1], 1 << (len(levels) - 1))
        keys = ["first_row", "first_seq", "next_row", "next_seq"]
        renamed = pairs.select(
            "row", "doc_id", "seq", *(F.col(k).alias(f"k_{k}") for k in keys)
        )
        levels.append(
            stored(classes(renamed, [f"k_{k}" for k in keys]), "level")
        )
    return levels[:-1]


def is_later() -> Column:
    return (F.col("first_row") != F.col("row")) | (
        F.col("first_seq") != F.col("seq")
    )


def repeated_runs(levels: list[DataFrame], spark: SparkSession) -> DataFrame:
    """row, seq, source_row, source_seq, length: maximal runs seen earlier."""
    later = [
        level.where(is_later()).select(
            "row",
            "seq",
            F.struct(
                F.lit(k).alias("k"),
                F.lit(1 << k).alias("length"),
                F.col("first_row").alias("source_row"),
                F.col("first_seq").alias("source_seq"),
            ).alias("run"),
        )
        for k, level in enumerate(levels)
    ]
    if not later:
        return spark.createDataFrame(
            [], "row bigint, seq int, source_row bigint, source_seq int, length int"
        )
    every = later[0]
    for other in later[1:]:
        every = every.unionByName(other)
    top = (
        every.groupBy("row", "seq")
        .agg(F.max("run").alias("run"))
        .select("row", "seq", "run.*")
    )
    for j in range(len(levels) - 2, -1, -1):
        top = extended(top, levels[j], j)
    return top.drop("k")


def extended(runs: DataFrame, level: DataFrame, j: int) -> DataFrame:
    """Lengthen runs by 2^j lines where both sides go on in one class."""
    names = F.struct("first_row", "first_seq")
    own = level.select(
        F.col("row").alias("own_row"), F.col("seq").alias("own_seq"),
        names.alias("own_class"),
    )
    other = level.select(
        F.col("row").alias("other_row"), F.col("seq").alias("other_seq"),
        names.alias("other_class"),
    )
    end, k = F.col("seq") + F.col("length"), F.col("k")
    source_end = F.col("source_seq") + F.col("length")
    longer = (k > j) & (F.col("own_class") == F.col("other_class"))
    grown = (
        runs.where(k > j)
        .join(own, (F.col("row") == F.col("own_row")) & (end == F.col("own_seq")), "left")
        .join(
            other,
            (F.col("source_row") == F.col("other_row"))
            & (source_end == F.col("other_seq")),
            "left",
        )
        .withColumn(
            "length",
            F.col("length")
            + F.when(F.coalesce(longer, F.lit(False)), 1 << j).otherwise(0),
        )
        .select(*runs.columns)
    )
    return stored(grown.unionByName(runs.where(k <= j)), "runs")


def covered_lines(
    lines: DataFrame, runs: DataFrame, least_characters: int = 0
) -> DataFrame:
    """row -> numbers of the lines in runs that count, and the longest run."""
    order = (
        Window.partitionBy("row")
        .orderBy("seq")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    end = F.col("seq") + F.col("length")
    if least_characters:
        runs = runs.join(lines.select("row", "seq", "chars"), ["row", "seq"]).where(
            (F.col("length") > 1) | (F.col("chars") >= least_characters)
        )
    fresh = runs.withColumn(
        "from", F.greatest("seq", F.coalesce(F.max(end).over(order), F.lit(0)))
    ).where(F.col("from") < end)
    return (
        fresh.select(
            "row",
            "length",
            F.explode(F.sequence("from", end - 1)).alias("seq"),
        )
        .join(lines.select("row", "seq", "line_no"), ["row", "seq"])
        .groupBy("row")
        .agg(
            F.collect_list("line_no").alias("removed"),
            F.max("length").alias("longest"),
        )
    )


def without_repeated_runs(
    docs: DataFrame, info: str | None = None, least_characters: int = 0
) -> DataFrame:
    """The rows of ``docs``, with the lines of later runs taken out of text.

    ``info`` names a struct column to add: n_lines, n_removed, longest_run.
    Runs of one line of less than ``least_characters`` stay.
    """
    spark, own = docs.sparkSession, list(docs.columns)
    row = free_name(docs, "row_number")
    docs = numbered(docs, row)
    lines = stored(line_sequences(docs, row), "lines")
    runs = repeated_runs(doubling(lines), spark)
    found = free_name(docs, "found")
    covered = covered_lines(lines, runs, least_characters).select(
        F.col("row").alias(found), F.struct("removed", "longest").alias(found + "s")
    )
    joined = docs.join(covered, F.col(row) == F.col(found), "left")
    removed = F.col(found + "s")["removed"]
    split = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), removed)
    kept = free_name(joined, "kept_lines")
    parts = joined.withColumn(kept, split).withColumn(
        "text",
        F.when(removed.isNull(), F.col("text")).otherwise(
            F.array_join(
                F.transform(left, lambda k: F.get(F.col(kept), k)), "\n"
            )
        ),
    )
    columns = [quoted(x) for x in own]
    if info:
        columns.append(
            F.struct(
                F.coalesce(F.size(kept), F.lit(0)).cast("bigint").alias("n_lines"),
                F.coalesce(F.size(removed), F.lit(0)).cast("bigint").alias("n_removed"),
                F.coalesce(F.col(found + "s")["longest"], F.lit(0))
                .cast("bigint")
                .alias("longest_run"),
            ).alias(info)
        )
    return parts.select(*columns)


def line_runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: lines of all documents, removed ones, and what is left."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return without_repeated_runs(docs, "lines").select(
        "doc_id",
        "lines.n_lines",
        "lines.n_removed",
        F.sha2("text", 256).alias("kept_sha256"),
    )
