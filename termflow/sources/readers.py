"""Sources: comments, topic maps, listings and stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termflow.schemas import (
    AUDIT,
    COMMENT_TOKENS,
    COMMENTS,
    TOPIC_MAP,
    WORD_STATISTICS,
)


def read_source(
    spark: SparkSession,
    location: str,
    table_type: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Open a source by format and path, or a catalog table by name.

    ``table_type`` is any Spark file format, or ``table``.
    """
    if table_type == "table":
        return spark.table(location)
    reader = spark.read.format(table_type)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(location)


def read_json_comments(
    spark: SparkSession, path: str, mode: str = "FAILFAST"
) -> DataFrame:
    """The four comment fields of JSON lines, all as strings.

    With the schema given nothing is inferred: there is no extra pass over the
    input, and a numeric ``created_utc`` still arrives as a string. A line that
    is no JSON object fails the query; with ``mode="PERMISSIVE"`` it becomes a
    row of NULLs, which ``corrupt_lines`` counts. ``split_json_comments`` keeps
    such lines beside the comments.
    """
    return spark.read.schema(COMMENTS).option("mode", mode).json(path)


def corrupt_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: the number of lines that are no JSON object (corrupt_lines)."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    is_object = F.from_json("value", "map<string,string>").isNotNull()
    return lines.agg(F.count_if(~is_object).alias("corrupt_lines"))


def split_json_comments(
    spark: SparkSession, path: str, store: str, counted: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Store the comments of JSON lines, and the lines that are none, in one scan.

    Each line is parsed once and goes to one of two folders of ``store``. The
    frames returned read these: the comments, and the corrupt lines (line).
    ``counted`` observes the numbers of both (comments, corrupt).
    """
    line = F.col("line")
    parsed = (
        spark.read.schema(T.StructType([*COMMENTS, T.StructField("line", T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "line")
        .json(path)
        .withColumn("is_corrupt", line.isNotNull())
    )
    if counted is not None:
        parsed = parsed.observe(
            counted,
            F.count_if(~F.col("is_corrupt")).alias("comments"),
            F.count_if(F.col("is_corrupt")).alias("corrupt"),
        )
    parsed.write.partitionBy("is_corrupt").parquet(store)
    stored = spark.read.schema(
        T.StructType([*parsed.schema.fields[:-1], T.StructField("is_corrupt", T.BooleanType())])
    ).parquet(store)
    return (
        stored.where(~F.col("is_corrupt")).select(*COMMENTS.names),
        stored.where("is_corrupt").select("line"),
    )


def read_topic_map(spark: SparkSession, path: str) -> DataFrame:
    """A topic map CSV with a header, with or without a leading index column.

    Quoted values may hold line breaks, so a file is not split; it is small.
    """
    return (
        spark.read.options(header=True, escape='"', multiLine=True)
        .csv(path)
        .select(*(F.col(f.name).cast(f.dataType) for f in TOPIC_MAP))
    )


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Stored statistics; their ``date`` would otherwise be read as DATE."""
    stored = spark.read.schema(WORD_STATISTICS).parquet(path)
    # An empty topic has no directory name of its own and comes back as NULL.
    return stored.withColumn(
        "topic", F.coalesce("topic", F.lit(""))
    ).select(*WORD_STATISTICS.names)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Stored tokens; their ``date`` would otherwise be read as DATE."""
    stored = spark.read.schema(COMMENT_TOKENS).parquet(path)
    return stored.select(*COMMENT_TOKENS.names)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The runs that ``append_audit`` recorded."""
    return spark.read.schema(AUDIT).parquet(path)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """The catalog table, or None when there is none of that name."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Listing (key, last_modified, size) of the files below a folder.

    Spark keeps the index of the files on the driver, so this is for folders of
    up to some million files, in any store that Spark reads. ``list_store`` of
    ``sources.listing`` walks larger ones in tasks.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return files.select(
        F.col("path").alias("key"),
        F.col("modificationTime").alias("last_modified"),
        F.col("length").alias("size"),
    )
