"""Registered queries: library operators on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from checks.inputs import END, FIRST, LAST, START
from termflow.functions.names import (
    TOPIC_RULES,
    community_name,
    replace_in_order,
)
from termflow.functions.paths import partition_value
from termflow.operators import comments as C
from termflow.operators import counts as N
from termflow.operators import listings as L
from termflow.operators import rates as R
from termflow.operators import tokens as W
from termflow.operators.topic_lists import (
    extract_heading_blocks,
    extract_links,
    merge_topic_lists,
)
from termflow.operators.trending import trending_terms
from termflow.plans.comment_tokens import comment_tokens
from termflow.plans.file_audit import audit_files
from termflow.plans.job import JobSettings, run_job
from termflow.plans.topic_map import build_topic_map
from termflow.plans.word_statistics import (
    comment_statistics,
    topic_word_rates,
    word_statistics,
)
from termflow.schemas import (
    COMMENT_TOKENS,
    COMMENTS,
    WORD_STATISTICS,
    enforce_schema,
)
from termflow.session import shared_folder
from termflow.sources.listing import list_store
from termflow.sources.readers import (
    read_audit,
    read_json_comments,
    read_source,
    read_statistics,
    read_tokens,
    read_topic_map,
    split_json_comments,
    table_or_none,
)
from termflow.sources.writers import write_partitioned, write_topic_map
from termflow.streaming.discovery import refresh_from_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name, less a suffix ``_query``."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def every_day(spark: SparkSession, sf_dir: str) -> tuple:
    return inputs.comments(spark, sf_dir), inputs.topic_map(spark, sf_dir), FIRST, LAST


def bounded(spark: SparkSession, sf_dir: str) -> tuple:
    """For queries whose feature is a range of days."""
    return inputs.comments(spark, sf_dir), inputs.topic_map(spark, sf_dir), START, END


def chat(spark: SparkSession, sf_dir: str) -> tuple:
    return (
        inputs.chat_comments(spark, sf_dir),
        inputs.chat_map(spark, sf_dir),
        FIRST,
        LAST,
    )


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        inputs.comments(spark, sf_dir)
        .transform(C.add_comment_id)
        .transform(C.add_date)
    )


def with_topics(comments: DataFrame, topic_map: DataFrame) -> DataFrame:
    return (
        comments.transform(C.add_comment_id)
        .transform(C.add_date)
        .transform(C.filter_dates, FIRST, LAST)
        .transform(C.add_topics, topic_map)
        .select(
            "id", "body", F.col("date").cast("string"), "subreddit", "topics"
        )
    )


def documents_with_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments, topic_map, *_ = every_day(spark, sf_dir)
    return with_topics(comments, topic_map)


def chat_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments, topic_map, *_ = chat(spark, sf_dir)
    return (
        with_topics(comments, topic_map).drop("subreddit").transform(W.add_words)
    )


def stat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comment_tokens(*every_day(spark, sf_dir))


# Comments to tokens


@query
def comment_id(spark, sf_dir):
    return keyed(spark, sf_dir).select("id", "subreddit")


@query
def unix_to_date(spark, sf_dir):
    return keyed(spark, sf_dir).select("id", F.col("date").cast("string"))


@query
def date_range_filter(spark, sf_dir):
    return (
        keyed(spark, sf_dir)
        .transform(C.filter_dates, START, END)
        .select("id", F.col("date").cast("string"))
    )


@query
def topic_join(spark, sf_dir):
    return documents_with_topics(spark, sf_dir).drop("body")


def joined(tokens: str) -> list:
    return [
        "id",
        "topics",
        "date",
        F.size(tokens).cast("bigint").alias("n_tokens"),
        F.array_join(tokens, "|").alias("tokens"),
    ]


@query
def tokenize(spark, sf_dir):
    return (
        documents_with_topics(spark, sf_dir)
        .transform(W.tokenize)
        .select(*joined("words_token"))
    )


@query
def remove_stop_words(spark, sf_dir):
    return (
        documents_with_topics(spark, sf_dir)
        .transform(W.tokenize)
        .transform(W.remove_stop_words)
        .select(*joined("words_no_stops"))
    )


@query
def split_words(spark, sf_dir):
    return (
        documents_with_topics(spark, sf_dir)
        .transform(W.tokenize)
        .transform(W.remove_stop_words)
        .transform(W.split_words)
    )


@query
def add_word(spark, sf_dir):
    return chat_words(spark, sf_dir)


@query
def explode_topics(spark, sf_dir):
    return chat_words(spark, sf_dir).transform(W.explode_topics)


@query
def enforce_schema_query(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    return enforce_schema(
        orders.select(
            F.col("o_custkey").alias("id"),
            F.col("o_orderstatus").alias("topic"),
            F.col("o_orderpriority").alias("word"),
            F.to_date("o_orderdate").alias("date"),
        ),
        COMMENT_TOKENS,
    )


@query
def comment_tokens_query(spark, sf_dir):
    return comment_tokens(*bounded(spark, sf_dir))


@query
def chat_tokens(spark, sf_dir):
    return comment_tokens(*chat(spark, sf_dir))


# Tokens to statistics


@query
def sum_column(spark, sf_dir):
    items = inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    return N.with_group_totals(
        items, "l_linenumber", {"total": ["l_returnflag", "l_linestatus"]}
    )


@query
def daily_word_frequency(spark, sf_dir):
    return stat_tokens(spark, sf_dir).transform(N.add_daily_word_frequency)


@query
def daily_word_frequency_in_topic(spark, sf_dir):
    return stat_tokens(spark, sf_dir).transform(N.topic_word_frequencies)


@query
def topic_daily_word_count(spark, sf_dir):
    return N.with_group_totals(
        daily_word_frequency_in_topic(spark, sf_dir),
        "daily_word_frequency_in_topic",
        {"topic_daily_word_count": ["date", "topic"]},
    )


@query
def word_count_columns(spark, sf_dir):
    return stat_tokens(spark, sf_dir).transform(N.add_word_counts)


@query
def rate_and_specificity(spark, sf_dir):
    return word_count_columns(spark, sf_dir).transform(
        R.add_rates_and_specificity
    )


def rates(spark, sf_dir):
    return topic_word_rates(*every_day(spark, sf_dir)).withColumn(
        "date", F.col("date").cast("string")
    )


@query
def five_row_average(spark, sf_dir):
    return rates(spark, sf_dir).transform(R.add_five_row_average)


@query
def change_in_average(spark, sf_dir):
    return five_row_average(spark, sf_dir).transform(R.add_change_in_average)


@query
def five_calendar_day_average(spark, sf_dir):
    column = "five_calendar_day_average_of_rate_in_topic"
    return (
        rates(spark, sf_dir)
        .transform(R.add_five_calendar_day_average, column)
        .select("topic", "word", "date", R.RATE, column)
    )


@query
def stats_id(spark, sf_dir):
    return (
        change_in_average(spark, sf_dir)
        .transform(R.add_statistics_id)
        .select("id")
    )


@query
def word_statistics_query(spark, sf_dir):
    return word_statistics(comment_tokens(*every_day(spark, sf_dir)))


@query
def comment_statistics_query(spark, sf_dir):
    return comment_statistics(*bounded(spark, sf_dir))


@query
def trending_terms_query(spark, sf_dir):
    return trending_terms(
        comment_statistics(*every_day(spark, sf_dir)), 1.2, 10
    ).select(
        "topic", "date", "word", "topic_specificity", R.CHANGE, "place"
    )


# Jobs that write


@query
def partitioned_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "statistics")
    write_partitioned(comment_statistics(*chat(spark, sf_dir)), path)
    return read_statistics(spark, path)


@query
def topic_terms_job(spark, sf_dir):
    comments, topic_map, start, end = bounded(spark, sf_dir)
    folder = shared_folder(spark, "job")
    settings = JobSettings(
        start, end, f"{folder}/statistics", audit_path=f"{folder}/audit"
    )
    return run_job(spark, comments, topic_map, settings)["word_statistics"]


@query
def incremental_equals_full(spark, sf_dir):
    """A fifth of the comments from the 15th on arrives late.

    Lists of the map end in a comma, so there is an empty topic too.
    """
    comments, topic_map, start, end = bounded(spark, sf_dir)
    topic_map = topic_map.withColumn("topics", F.concat("topics", F.lit(",")))
    day = "2024-01-15"
    path = shared_folder(spark, "incremental")
    second = F.col("created_utc").cast("bigint")
    on_time = comments.where(
        (second < F.unix_timestamp(F.lit(day), "yyyy-MM-dd"))
        | (second % 5 != 0)
    )
    run_job(spark, on_time, topic_map, JobSettings(start, end, path))
    late = JobSettings(day, end, path, incremental=True)
    return run_job(spark, comments, topic_map, late)["word_statistics"]


@query
def late_days(spark, sf_dir):
    """A third of three days' comments come late; only these are refreshed."""
    comments, topic_map, *_ = chat(spark, sf_dir)
    path = shared_folder(spark, "late")
    second = F.col("created_utc").cast("bigint")
    day = F.date_from_unix_date(F.floor(second / 86400).cast("int"))
    on_time = comments.where(
        ~day.between("2024-01-10", "2024-01-12") | (second % 3 != 0)
    )
    run_job(spark, on_time, topic_map, JobSettings(FIRST, LAST, path))
    late = JobSettings("2024-01-10", "2024-01-12", path, incremental=True)
    return run_job(spark, comments, topic_map, late)["word_statistics"]


@query
def new_files(spark, sf_dir):
    """Two drops of files: each refreshes the days its files hold."""
    comments, topic_map, *_ = chat(spark, sf_dir)
    folder = shared_folder(spark, "drops")
    second = F.col("created_utc").cast("bigint")
    early = (second < F.unix_timestamp(F.lit("2024-01-20"), "yyyy-MM-dd")) & (
        (second % 5 != 0) | ~F.date_from_unix_date(
            F.floor(second / 86400).cast("int")
        ).between("2024-01-05", "2024-01-06")
    )
    settings = JobSettings(None, LAST, f"{folder}/statistics")
    for drop in (comments.where(early), comments.where(~early)):
        drop.write.mode("append").json(f"{folder}/comments")
        refresh_from_new_files(
            spark, f"{folder}/comments", topic_map, settings, f"{folder}/taken"
        )
    return read_statistics(spark, settings.target_path)


@query
def token_store(spark, sf_dir):
    """Tokens of a full run, after a refresh of its last days and further ones."""
    comments, topic_map, *_ = chat(spark, sf_dir)
    folder = shared_folder(spark, "tokens")
    target, tokens = f"{folder}/statistics", f"{folder}/tokens"
    second = F.col("created_utc").cast("bigint")
    first = JobSettings(FIRST, "2024-01-20", target, tokens_path=tokens)
    run_job(spark, comments.where(second % 7 != 0), topic_map, first)
    for start, end in (("2024-01-12", LAST), (FIRST, "2024-01-11")):
        more = JobSettings(start, end, target, tokens_path=tokens, incremental=True)
        run_job(spark, comments, topic_map, more)
    return read_tokens(spark, tokens)


# Topic map


HEADINGS = {"heading_tags": ("h1",), "label_tags": (), "block_tags": ("p",)}
LINKS = {
    "container": ("nav", ""),
    "item_tag": "li",
    "anchor_attr": r"\bhref\s*=",
    "text_prefix": "",
    "label": "Menu",
}


@query
def heading_blocks(spark, sf_dir):
    return extract_heading_blocks(
        inputs.pages(spark, sf_dir), **HEADINGS
    )


@query
def extract_links_query(spark, sf_dir):
    return extract_links(inputs.pages(spark, sf_dir), **LINKS)


@query
def merge_topic_lists_query(spark, sf_dir):
    return merge_topic_lists(
        heading_blocks(spark, sf_dir), extract_links_query(spark, sf_dir)
    )


@query
def clean_names(spark, sf_dir):
    kind = F.col("doc_id") % 3
    raw = (
        F.when(kind == 0, F.concat(F.lit("r/"), "source"))
        .when(kind == 1, F.concat(F.lit("/r/"), "source"))
        .otherwise(F.concat(F.lit("/r/"), "source", F.lit("/")))
    )
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id",
        community_name(raw).alias("name"),
        community_name(raw, anchored=True).alias("anchored_name"),
    )


@query
def clean_topics(spark, sf_dir):
    """A label per document: a rule's own text between columns of the table."""
    number = (F.col("doc_id") % (len(TOPIC_RULES) + 1)).cast("int")
    texts = F.array(*(F.lit(old) for old, _ in TOPIC_RULES))
    raw = F.concat(
        F.initcap("lang"), F.coalesce(F.get(texts, number), F.lit("")), "source"
    )
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", replace_in_order(raw, TOPIC_RULES).alias("topics")
    )


@query
def topic_map(spark, sf_dir):
    pages = inputs.pages(spark, sf_dir)
    return build_topic_map(
        pages, pages, heading_options=HEADINGS, link_options=LINKS
    )


# Sources and sinks


@query
def read_parquet_source(spark, sf_dir):
    return inputs.table(spark, sf_dir, "conversations")


@query
def json_comments(spark, sf_dir):
    path = shared_folder(spark, "comments")
    inputs.comments(spark, sf_dir).write.json(path)
    return read_json_comments(spark, path)


@query
def split_json_comments_query(spark, sf_dir):
    """Comments and corrupt lines of one file of lines, with their numbers."""
    folder = shared_folder(spark, "lines")
    name = F.col("author")
    line = F.when(
        name.rlike("[05]$"), F.concat(F.lit("{no json "), "created_utc")
    ).otherwise(F.to_json(F.struct(*COMMENTS.names)))
    inputs.comments(spark, sf_dir).select(line).write.text(f"{folder}/lines")
    counted = Observation("lines")
    comments, corrupt = split_json_comments(
        spark, f"{folder}/lines", f"{folder}/split", counted
    )
    return comments.unionByName(corrupt, allowMissingColumns=True).select(
        "*", *(F.lit(n).alias(f"n_{kind}") for kind, n in counted.get.items())
    )


@query
def topic_map_csv(spark, sf_dir):
    path = shared_folder(spark, "topic-map")
    write_topic_map(merge_topic_lists_query(spark, sf_dir), path)
    return read_topic_map(spark, path)


@query
def catalog_table(spark, sf_dir):
    """Statistics as a catalog table: half the days first, then the others."""
    comments, topic_map, *_ = chat(spark, sf_dir)
    path = shared_folder(spark, "table")
    name = "statistics_" + path.rsplit("-", 1)[1]
    first = JobSettings(FIRST, "2024-01-15", path, table=name)
    run_job(spark, comments, topic_map, first)
    more = JobSettings("2024-01-16", LAST, path, table=name, incremental=True)
    run_job(spark, comments, topic_map, more)
    spark.catalog.refreshTable(name)
    return read_source(spark, name, "table").select(*WORD_STATISTICS.names)


@query
def optional_table(spark, sf_dir):
    """A table by name, and none where there is none."""
    nations = inputs.table(spark, sf_dir, "nation")
    path = shared_folder(spark, "nations")
    name = "nations_" + path.rsplit("-", 1)[1]
    absent = table_or_none(spark, name) is None
    nations.write.option("path", path).saveAsTable(name)
    present = table_or_none(spark, name)
    return present.select("n_nationkey", "n_name", F.lit(absent).alias("was_absent"))


@query
def audit_record(spark, sf_dir):
    """Two runs, the second from the last day that the first recorded."""
    comments, topic_map, *_ = chat(spark, sf_dir)
    folder = shared_folder(spark, "audited")
    target, audit = f"{folder}/statistics", f"{folder}/audit"
    first = JobSettings(FIRST, "2024-01-10", target, audit_path=audit)
    run_job(spark, comments, topic_map, first)
    later = JobSettings(None, LAST, target, audit_path=audit, incremental=True)
    run_job(spark, comments, topic_map, later)
    return read_audit(spark, audit).select("min_date", "max_date", "rows")


# File audit


@query
def store_listing(spark, sf_dir):
    """Files of a written folder by group: a row per file, each with a size."""
    folder = shared_folder(spark, "store")
    orders = inputs.table(spark, sf_dir, "orders")
    group = (F.col("o_custkey") % 10).alias("id_group")
    orders.select(group, "o_orderkey").repartition(4, "id_group").write.partitionBy(
        "id_group"
    ).parquet(folder)
    files = list_store(spark, folder).where(F.col("key").endswith(".parquet"))
    return (
        files.transform(L.add_id_group)
        .groupBy("id_group")
        .agg(F.count(F.lit(1)).alias("files"), (F.min("size") > 0).alias("all_sized"))
    )


@query
def file_audit(spark, sf_dir):
    """Freshness, smallest and largest size, and number of groups of orders."""
    found = audit_files(inputs.order_listing(spark, sf_dir), "1995-01-01")
    sizes = found["sizes"].select("size_min", "size_max")
    groups = found["latest_keys"].agg(F.count(F.lit(1)).alias("groups"))
    one = F.lit(1).alias("one")
    return (
        found["freshness"].select(one, "*")
        .join(sizes.select(one, "*"), "one")
        .join(groups.select(one, "*"), "one")
        .drop("one")
    )


@query
def partition_value_query(spark, sf_dir):
    return inputs.order_listing(spark, sf_dir).select(
        "key", partition_value(F.col("key")).alias("id_group")
    )


@query
def freshness_counts(spark, sf_dir):
    return L.freshness_counts(
        inputs.event_listing(spark, sf_dir), "2024-01-15 00:00:00"
    )


@query
def size_percentiles(spark, sf_dir):
    return L.size_percentiles(inputs.item_listing(spark, sf_dir))


@query
def latest_key_per_group(spark, sf_dir):
    return L.latest_key_per_group(inputs.order_listing(spark, sf_dir))
