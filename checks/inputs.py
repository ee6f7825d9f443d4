"""The given tables in the shape of the library's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow.sources.readers import read_source

# All days of the comments, and a range for what filters by day.
FIRST, LAST = "2024-01-01", "2024-01-30"
START, END = "2024-01-03", "2024-01-28"
FIRST_SECOND = 1704067200  # 2024-01-01T00:00:00Z


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_source(spark, f"{sf_dir}/{name}.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as comments: 50 authors, 30 days, 20 communities."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("u"), doc % 50).alias("author"),
        F.col("text").alias("body"),
        (FIRST_SECOND + (doc * 7919) % (30 * 86400))
        .cast("string")
        .alias("created_utc"),
        F.col("source").alias("subreddit"),
    )


def topic_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics for every source that occurs, with names in capitals."""
    number = F.regexp_extract("source", r"\d+", 0).cast("int")
    return (
        table(spark, sf_dir, "documents")
        .select("source")
        .distinct()
        .select(
            F.upper("source").alias("subreddit"),
            F.concat(
                F.lit("Topic"), number % 4, F.lit(", group"), number % 3
            ).alias("topics"),
        )
    )


def chat_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as comments, one community per role."""
    conv, turn = F.col("conv_id"), F.col("turn")
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), conv).alias("author"),
        F.col("text").alias("body"),
        (FIRST_SECOND + (conv * 100003 + turn * 60) % (30 * 86400))
        .cast("string")
        .alias("created_utc"),
        F.col("role").alias("subreddit"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def order_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as object keys under ten partition groups."""
    return table(spark, sf_dir, "orders").select(
        F.concat(
            F.lit("bkt/id_group="),
            F.col("o_custkey") % 10,
            F.lit("/part-"),
            F.col("o_orderkey"),
        ).alias("key"),
        F.col("o_orderdate").alias("last_modified"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("size"),
    )


def event_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("key"),
        F.col("ts").alias("last_modified"),
        F.lit(0).cast("bigint").alias("size"),
    )


def item_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as files whose size is their price in cents."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("key"),
        F.col("l_shipdate").alias("last_modified"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("size"),
    )


def chat_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each role with a topic of its own and one given twice."""
    return (
        table(spark, sf_dir, "conversations")
        .select(F.col("role").alias("subreddit"))
        .distinct()
        .withColumn("topics", F.concat("subreddit", F.lit(",Chat, chat")))
    )
