"""Word counts per day and per topic and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from termflow.operators.broadcasts import BROADCAST_BYTES, join_totals
from termflow.sources.scratch import stored

IN_TOPIC = "daily_word_frequency_in_topic"
#: Tasks over which the comments with a word of a day are spread.
ID_SALTS = 8
ROWS_AT_ONCE = 10_000


def with_group_totals(
    rows: DataFrame,
    value: str,
    totals: dict[str, Sequence[str]],
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Sums of ``value`` over the groups of each key list, on every row.

    ``totals`` maps the new column to its keys; rows with a NULL key go. Each
    sum is an aggregate of ``rows`` that runs at once and whose groups are
    stored, so their size is known: broadcast, they leave the rows where they
    are; above ``max_bytes`` the join is salted. A hot group moves to no task.
    """
    for name, keys in totals.items():
        sums = stored(rows.groupBy(*keys).agg(F.sum(value).alias(name)), "totals")
        rows = join_totals(rows, sums, keys, max_bytes)
    return rows


def add_daily_word_frequency(tokens: DataFrame) -> DataFrame:
    """Topic, word, day and daily frequencies, one output row per token.

    Tokens of a topic, word and day give equal rows, so each row of their counts
    is repeated as often as it was counted, ``ROWS_AT_ONCE`` rows at a time. No
    token meets its frequency in a join.
    """
    n, start = F.col(IN_TOPIC), F.col("start")
    last = F.lit(ROWS_AT_ONCE)
    return (
        topic_word_frequencies(tokens)
        .withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1, last)))
        .withColumn("times", F.least(n - start, last).cast("int"))
        .withColumn("one", F.explode(F.array_repeat(F.lit(True), F.col("times"))))
        .select(
            "topic",
            "word",
            "date",
            "daily_word_frequency",
            "total_daily_word_count",
        )
    )


def token_counts(tokens: DataFrame) -> DataFrame:
    """(date, word, daily_word_frequency, in_topic) in one pass over tokens.

    ``in_topic`` is an array of (topic, daily_word_frequency_in_topic): at most
    one entry per topic. A comment's tokens of a word are sorted side by side, the
    first of them carries the comment. A word of a day is dealt to ``ID_SALTS``
    tasks by id; what these send on are numbers, one row per topic.
    """
    salted = tokens.where(
        F.col("word").isNotNull() & F.col("date").isNotNull()
    ).withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(ID_SALTS)).cast("int"))
    comments = Window.partitionBy("word", "date", "_salt").orderBy("id")
    before = F.lag("id").over(comments)
    is_first = (F.row_number().over(comments) == 1) | ~F.col("id").eqNullSafe(before)
    by_topic = F.struct("topic", F.col("n").alias(IN_TOPIC))
    return (
        salted.withColumn("is_first", is_first)
        .groupBy("word", "date", "_salt", "topic")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("is_first").alias("first_places"),
        )
        .repartition("date", "word")
        .groupBy("date", "word", "topic")
        .agg(F.sum("n").alias("n"), F.sum("first_places").alias("first_places"))
        .groupBy("date", "word")
        .agg(
            F.sum("first_places").alias("daily_word_frequency"),
            F.collect_list(by_topic).alias("in_topic"),
        )
    )


def _with_day_totals(counts: DataFrame) -> DataFrame:
    """A row per topic from stored ``token_counts``, with the day's total."""
    return with_group_totals(
        counts, "daily_word_frequency", {"total_daily_word_count": ["date"]}
    ).select(
        "date", "word", "daily_word_frequency", "total_daily_word_count",
        F.inline("in_topic"),
    )


def topic_word_frequencies(tokens: DataFrame) -> DataFrame:
    """One row per topic, word and day: tokens in topic, daily frequencies."""
    return _with_day_totals(stored(token_counts(tokens), "counts"))


def add_word_counts(tokens: DataFrame) -> DataFrame:
    """All counts of a token table, one row per topic, word and day.

    The tokens are read once, at once; what follows works on their counts.
    """
    counts = stored(token_counts(tokens), "counts")
    totals = stored(
        counts.select("date", F.inline("in_topic"))
        .groupBy("date", "topic")
        .agg(F.sum(IN_TOPIC).alias("topic_daily_word_count")),
        "totals",
    )
    return join_totals(_with_day_totals(counts), totals, ["date", "topic"])


def count_topic_words(words: DataFrame) -> DataFrame:
    """Counts per topic, word and day straight from comment words.

    ``words`` has (id, word, date, topics, is_repeated) with ``topics`` an array
    of distinct topics. Words of a comment whose id occurs once in the input go
    straight to the counts. Only those of repeated ids, NULL among them, are
    merged by comment and word first. Words are counted by their list of topics,
    before it is split: a row per word, not per token, and after it a row per list.
    The least topic of a list carries its count towards the daily frequency
    (``first_places``), so one aggregate yields both counts and no token is read
    twice. What follows by day and word finds the rows dealt by these.
    """
    topics = F.sort_array("topics").alias("topics")
    once = words.where(~F.col("is_repeated")).select("date", "word", topics)
    merged = (
        words.where("is_repeated")
        .groupBy("id", "word", "date")
        .agg(F.array_distinct(F.flatten(F.collect_set("topics"))).alias("topics"))
        .select("date", "word", topics)
    )
    n = F.col("n")
    return (
        once.unionByName(merged)
        .groupBy("date", "word", "topics")
        .agg(F.count(F.lit(1)).alias("n"))
        .repartition("date", "word")
        .select("date", "word", "n", F.posexplode("topics").alias("place", "topic"))
        .groupBy("date", "word", "topic")
        .agg(
            F.sum("n").alias(IN_TOPIC),
            F.sum(F.when(F.col("place") == 0, n).otherwise(0)).alias("first_places"),
        )
    )


def add_daily_frequency(counts: DataFrame) -> DataFrame:
    """``count_topic_words`` with the daily frequency of each row's word.

    The windows span at most all topics: small, however hot the word.
    """
    return counts.withColumn(
        "daily_word_frequency",
        F.sum("first_places").over(Window.partitionBy("word", "date")),
    )


def add_daily_totals(
    counts: DataFrame, max_bytes: int | None = None
) -> DataFrame:
    """Complete ``count_topic_words`` to the counts of ``add_word_counts``.

    ``max_bytes`` bounds the size of the totals per day and topic, if known: if
    it is small, they are broadcast and nothing runs yet. Else they are stored
    and measured. ``counts`` may have the daily frequencies already.
    """
    totals = (
        counts.groupBy("date", "topic")
        .agg(
            F.sum(IN_TOPIC).alias("topic_daily_word_count"),
            F.sum("first_places").alias("first_places"),
        )
        .withColumn(
            "total_daily_word_count",
            F.sum("first_places").over(Window.partitionBy("date")),
        )
        .drop("first_places")
    )
    if "daily_word_frequency" not in counts.columns:
        rows = add_daily_frequency(counts).drop("first_places")
    else:
        rows = counts.drop("first_places")
    if max_bytes is not None and max_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(totals), ["date", "topic"])
    return join_totals(rows, stored(totals, "totals"), ["date", "topic"])
