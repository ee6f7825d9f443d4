"""What reaches a shuffle on the way from comments to counts."""

import pytest
from conftest import END, START, rows
from pyspark.sql import functions as F

from termflow.operators import counts as N
from termflow.operators.counts import add_daily_word_frequency, count_topic_words, token_counts
from termflow.operators.rates import add_five_row_average
from termflow.plans.comment_tokens import comment_tokens, comment_words
from termflow.plans.word_statistics import topic_word_rates
from termflow.schemas import COMMENT_TOKENS, COMMENTS

MAP = [("nuts", "food,tree"), ("oils", "food")]


def shuffled(df):
    """The final plan after a run, without the one before it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan


def ten_comments(spark, *more):
    data = [(f"a{n}", "nut oak nut", "1640995200", "nuts") for n in range(10)]
    return spark.createDataFrame(data + list(more), COMMENTS)


@pytest.fixture
def two_topics(spark):
    return spark.createDataFrame(MAP, "subreddit string, topics string")


def test_only_tokens_of_repeated_ids_are_shuffled(spark, two_topics):
    tokens = comment_tokens(ten_comments(spark), two_topics, START, END)
    assert tokens.count() == 40
    assert "hashpartitioning" not in shuffled(tokens)
    again = [
        ("a1", "nut elm", "1640995200", "oils"),
        (None, "elm", "1640995200", "oils"),
        (None, "elm oak", "1640995200", "nuts"),
    ]
    tokens = comment_tokens(ten_comments(spark, *again), two_topics, START, END)
    lazy = comment_tokens(
        ten_comments(spark, *again), two_topics, START, END, count_ids=False
    )
    assert rows(tokens) == rows(lazy)
    assert tokens.count() == 45
    assert tokens.where(F.col("id").isNull()).count() == 4


def test_tokens_are_shuffled_once_and_then_numbers(spark):
    day = "2022-01-01"
    data = [(f"k{n}", t, "w", day) for n in range(50) for t in ("a", "b")]
    data += [("k0", "a", "w", day), (None, "c", "w", day), (None, "c", "w", day)]
    tokens = spark.createDataFrame(data, COMMENT_TOKENS)
    counts = token_counts(tokens)
    row = counts.first()
    assert row["daily_word_frequency"] == 51
    assert {tuple(r) for r in row["in_topic"]} == {("a", 51), ("b", 50), ("c", 2)}
    exchanges = [x for x in shuffled(counts).splitlines() if "Exchange hashpart" in x]
    assert len(exchanges) == 2 and "Expand" not in shuffled(counts)
    assert not any("id#" in x for x in exchanges if "word#" in x and "_salt" not in x)


def test_daily_frequency_repeats_counts_without_joining_tokens(spark, monkeypatch):
    monkeypatch.setattr(N, "ROWS_AT_ONCE", 3)
    day = "2022-01-01"
    data = [(f"k{n}", "a", "w", day) for n in range(10)] + [("k0", "b", "v", day)]
    daily = add_daily_word_frequency(spark.createDataFrame(data, COMMENT_TOKENS))
    assert rows(daily) == [("a", "w", day, 10, 11)] * 10 + [("b", "v", day, 1, 11)]
    plan = shuffled(daily)
    assert "SortMergeJoin" not in plan and "id#" not in plan


def test_words_are_counted_before_their_topics_are_split(spark, two_topics):
    words = comment_words(
        ten_comments(spark), two_topics, START, END, mark_repeated=True
    )
    plan = shuffled(count_topic_words(words))
    below = plan[plan.rindex("Generate posexplode(topics") :]
    assert "hashpartitioning(date" in below and "count(1)" in below
    assert rows(count_topic_words(words), "topic", "word", "first_places") == [
        ("food", "nut", 10), ("food", "oak", 10), ("tree", "nut", 0), ("tree", "oak", 0),
    ]


def test_stored_counts_are_not_shuffled_by_word_again(spark, tmp_path, two_topics):
    rates = topic_word_rates(
        ten_comments(spark), two_topics, START, END, counts_path=str(tmp_path / "c")
    )
    assert rows(rates, "topic", "word", "daily_word_frequency", "total_daily_word_count") == [
        (t, w, 10, 20) for t in ("food", "tree") for w in ("nut", "oak")
    ]
    assert "hashpartitioning(word" not in shuffled(rates)


def test_series_are_sorted_by_word_first(spark):
    df = spark.createDataFrame([], "topic string, word string, date string, rate_in_topic double")
    plan = add_five_row_average(df)._jdf.queryExecution().executedPlan().toString()
    assert "Sort [word#" in plan
