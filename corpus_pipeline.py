"""The corpus pipeline: five stages over documents, each a Parquet table.

Each stage takes all rows its predecessor kept and returns the columns of
documents, the last one the packed pieces. Where a stage shortens texts, it sets
``n_chars`` anew. A document whose lines or words were all copies stays, with an
empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow.llm.jaccard_join import first_of_each_group
from termflow.llm.line_runs import without_repeated_runs
from termflow.llm.packing import pack_documents
from termflow.llm.quality import keep_good_documents
from termflow.llm.repeated_phrases import without_repeated_phrases
from termflow.llm.storage import documents, stored


def counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of runs seen earlier."""
    return counted(without_repeated_runs(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return first_of_each_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages seen earlier."""
    return counted(without_repeated_phrases(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with sequence and offset."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("best-fit packing", packing),
]
#: Sequences are numbered freely and best-fit decreasing is no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` of ``sf_dir`` to packed pieces."""
    docs = documents(spark, sf_dir)
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = stored(docs, f"stage-{place}")
    return docs
