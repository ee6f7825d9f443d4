import random
from collections import defaultdict
from datetime import datetime, timezone
from functools import reduce
from operator import add

import pytest
from conftest import END, START, has_schema, rows
from pyspark.sql import functions as F

from termflow.operators import counts as N
from termflow.operators import rates as R
from termflow.operators.trending import trending_terms
from termflow.plans.comment_tokens import comment_tokens, comment_words
from termflow.plans.word_statistics import comment_statistics, word_statistics
from termflow.schemas import COMMENT_TOKENS, COMMENTS, TOPIC_MAP, WORD_STATISTICS, repeated_keys

# Topic, date, word, in topic, topic total, frequency, total,
# rate in topic, specificity, mean, change.
GOLDEN = [
    ("food", "2022-01-01", "banana", 1, 7, 1, 7, 1 / 7, 1.0, 1 / 7, None),
    ("food", "2022-01-01", "cherry", 1, 7, 1, 7, 1 / 7, 1.0, 1 / 7, None),
    ("food", "2022-01-01", "pecan", 3, 7, 3, 7, 3 / 7, 1.0, 3 / 7, None),
    ("food", "2022-01-01", "walnut", 2, 7, 2, 7, 2 / 7, 1.0, 2 / 7, None),
    ("food", "2022-01-02", "apple", 1, 3, 1, 3, 1 / 3, 1.0, 1 / 3, None),
    ("food", "2022-01-02", "cherry", 1, 3, 1, 3, 1 / 3, 1.0, 0.23809523809523808, 0.09523809523809523),
    ("food", "2022-01-02", "pecan", 1, 3, 1, 3, 1 / 3, 1.0, 0.38095238095238093, -0.047619047619047616),
    ("fruit", "2022-01-01", "banana", 1, 3, 1, 7, 1 / 3, 2.3333333333333335, 1 / 3, None),
    ("fruit", "2022-01-01", "cherry", 1, 3, 1, 7, 1 / 3, 2.3333333333333335, 1 / 3, None),
    ("fruit", "2022-01-01", "pecan", 1, 3, 3, 7, 1 / 3, 0.7777777777777778, 1 / 3, None),
    ("fruit", "2022-01-02", "apple", 1, 3, 1, 3, 1 / 3, 1.0, 1 / 3, None),
    ("fruit", "2022-01-02", "cherry", 1, 3, 1, 3, 1 / 3, 1.0, 1 / 3, 0.0),
    ("fruit", "2022-01-02", "pecan", 1, 3, 1, 3, 1 / 3, 1.0, 1 / 3, 0.0),
    ("nuts", "2022-01-01", "pecan", 2, 4, 3, 7, 0.5, 1.1666666666666667, 0.5, None),
    ("nuts", "2022-01-01", "walnut", 2, 4, 2, 7, 0.5, 1.75, 0.5, None),
]
GOLDEN_COLUMNS = [
    "topic",
    "date",
    "word",
    "daily_word_frequency_in_topic",
    "topic_daily_word_count",
    "daily_word_frequency",
    "total_daily_word_count",
    "rate_in_topic",
    "topic_specificity",
    R.AVERAGE,
    R.CHANGE,
]


@pytest.fixture(scope="module")
def tokens(comments, topic_map):
    return comment_tokens(comments, topic_map, START, END)


def both(comments, topic_map, start=START, end=END):
    return (
        word_statistics(comment_tokens(comments, topic_map, start, end)),
        comment_statistics(comments, topic_map, start, end),
    )


@pytest.mark.parametrize("way", [0, 1])
def test_golden_rows(comments, topic_map, way):
    statistics = both(comments, topic_map)[way]
    assert has_schema(statistics, WORD_STATISTICS)
    assert rows(statistics, *GOLDEN_COLUMNS) == sorted(GOLDEN, key=repr)
    for row in statistics.collect():
        assert row["id"] == f"{row['topic']}_{row['date']}_{row['word']}"
        assert row["rate"] == row["daily_word_frequency"] / row["total_daily_word_count"]
    assert repeated_keys(statistics, "id").count() == 0


def test_daily_frequency_keeps_one_row_per_token(tokens):
    daily = N.add_daily_word_frequency(tokens)
    assert daily.count() == tokens.count() == 20
    pecan = daily.where("topic = 'food' and word = 'pecan' and date = '2022-01-01'")
    assert rows(pecan, "daily_word_frequency", "total_daily_word_count") == [(3, 7)] * 3


def test_step_by_step_counts_equal_the_composite(tokens):
    steps = N.with_group_totals(
        N.topic_word_frequencies(tokens),
        "daily_word_frequency_in_topic",
        {"topic_daily_word_count": ["date", "topic"]},
    )
    assert steps.count() == 15
    assert rows(steps, *GOLDEN_COLUMNS[:7]) == rows(N.add_word_counts(tokens), *GOLDEN_COLUMNS[:7])


def test_group_totals_drop_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "k string, v int")
    totals = N.with_group_totals(df, "v", {"s": ["k"]})
    assert rows(totals, "k", "v", "s") == [("a", 1, 3), ("a", 2, 3)]


def rate_rows(spark, rates, word="w"):
    return spark.createDataFrame(
        [("t", word, day, rate) for day, rate in rates],
        "topic string, word string, date string, rate_in_topic double",
    )


def test_rates_keep_the_order_of_operations(spark):
    df = spark.createDataFrame(
        [(4, 20, 3, 10)],
        "daily_word_frequency long, total_daily_word_count long,"
        " daily_word_frequency_in_topic long, topic_daily_word_count long",
    )
    row = R.add_rates_and_specificity(df).first()
    assert (row["rate"], row["rate_in_topic"]) == (0.2, 0.3)
    assert row["topic_specificity"] == 1.4999999999999998


def test_rolling_mean_spans_five_rows_whatever_the_gaps(spark):
    days = ["01", "02", "04", "08", "09", "20", "21"]
    df = rate_rows(spark, [(f"2022-01-{d}", float(i)) for i, d in enumerate(days)])
    out = R.add_change_in_average(R.add_five_row_average(df)).orderBy("date").collect()
    assert [r[R.AVERAGE] for r in out] == [0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0]
    assert [r[R.CHANGE] for r in out] == [None, 0.5, 0.5, 0.5, 0.5, 1.0, 1.0]


def test_calendar_mean_sees_gaps(spark):
    days = ["01", "02", "04", "08", "09"]
    df = rate_rows(spark, [(f"2022-01-{d}", float(i)) for i, d in enumerate(days)])
    out = R.add_five_calendar_day_average(df, "mean").orderBy("date").collect()
    assert [r["mean"] for r in out] == [0.0, 0.5, 1.0, 2.5, 3.5]


def test_rolling_columns_share_one_shuffle_and_sort(spark):
    df = rate_rows(spark, [("2022-01-01", 1.0)])
    out = R.add_change_in_average(R.add_five_row_average(df))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort ") == 1


def test_null_id_counts_as_one_comment(spark, topic_map):
    comments = spark.createDataFrame(
        [
            (None, "pecan walnut", "1640995200", "go_nuts"),
            (None, "pecan", "1640995201", "fruits"),
            ("a", "pecan", "1640995200", "go_nuts"),
        ],
        COMMENTS,
    )
    for statistics in both(comments, topic_map):
        pecan = statistics.where("word = 'pecan'")
        assert rows(pecan, "topic", "daily_word_frequency", "daily_word_frequency_in_topic") == [
            ("food", 2, 2), ("fruit", 2, 1), ("nuts", 2, 2),
        ]


def test_repeated_tokens_count_in_topic_but_not_per_day(spark):
    tokens = spark.createDataFrame([("k", "t", "w", "2022-01-01")] * 3, COMMENT_TOKENS)
    row = word_statistics(tokens).first()
    assert row["daily_word_frequency"] == 1
    assert row["daily_word_frequency_in_topic"] == 3


def random_comments(spark, seed, n=400):
    """One community, author and text hold a third of all rows each."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    data = []
    for _ in range(n):
        hot = rng.random() < 1 / 3
        author = rng.choice(["hot", None]) if hot else f"a{rng.randrange(40)}"
        body = "w1 w2 w2" if hot else " ".join(rng.choices(words, k=rng.randrange(1, 9)))
        second = 1640995200 + 43200 * rng.randrange(20)
        community = "big" if rng.random() < 1 / 3 else f"c{rng.randrange(6)}"
        data.append((author, body, str(second), community))
    topic_map = [("big", "x,y"), ("BIG", "y,z")] + [(f"c{i}", f"x,t/{i % 3}") for i in range(6)]
    return (
        spark.createDataFrame(data, COMMENTS).coalesce(2).cache(),
        spark.createDataFrame(topic_map, TOPIC_MAP).coalesce(1).cache(),
    )


def plain_mean(values):
    """Left to right; the built-in sum of floats compensates rounding errors."""
    return reduce(add, values, 0.0) / len(values)


def brute_force(comments, topic_map):
    """Statistics by plain loops over a small input."""
    tokens, mapped = set(), topic_map.collect()
    for c in comments.collect():
        day = str(datetime.fromtimestamp(int(c["created_utc"]), timezone.utc).date())
        key = None if c["author"] is None else f"{c['author']}_{c['created_utc']}"
        for m in mapped:
            if m["subreddit"].lower() == c["subreddit"]:
                for topic in m["topics"].split(","):
                    tokens |= {(key, topic, word, day) for word in c["body"].split()}
    f, ft, total, topic_total = (defaultdict(int) for _ in range(4))
    for key, word, day in {(k, w, d) for k, _, w, d in tokens}:
        f[day, word] += 1
        total[day] += 1
    for _, topic, word, day in tokens:
        ft[topic, word, day] += 1
        topic_total[topic, day] += 1
    out, series = [], defaultdict(list)
    for topic, word, day in sorted(ft):
        rate = f[day, word] / total[day]
        in_topic = ft[topic, word, day] / topic_total[topic, day]
        past = series[topic, word]
        past.append(in_topic)
        mean = plain_mean(past[-5:])
        before = plain_mean(past[-6:-1]) if len(past) > 1 else None
        out.append(
            (topic, day, word, ft[topic, word, day], topic_total[topic, day], f[day, word], total[day],
             in_topic, in_topic / rate, mean, None if before is None else mean - before)
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_skewed_input_against_brute_force(spark, seed):
    comments, topic_map = random_comments(spark, seed)
    expected = brute_force(comments, topic_map)
    assert len(expected) > 300
    for statistics in both(comments, topic_map):
        assert rows(statistics, *GOLDEN_COLUMNS) == expected


def test_order_and_partitioning_do_not_matter(spark):
    comments, topic_map = random_comments(spark, 3)
    shuffled = comments.orderBy(F.rand(5)).repartition(7)
    assert rows(comment_statistics(comments, topic_map, START, END)) == rows(
        comment_statistics(shuffled, topic_map, START, END)
    )


def test_shares_add_up_to_one(spark):
    comments, topic_map = random_comments(spark, 4)
    statistics = comment_statistics(comments, topic_map, START, END)
    in_topic = statistics.groupBy("topic", "date").agg(F.sum("rate_in_topic").alias("s"))
    overall = statistics.select("date", "word", "rate").distinct().groupBy("date").agg(F.sum("rate").alias("s"))
    for sums in (in_topic, overall):
        assert all(abs(r["s"] - 1) < 1e-12 for r in sums.collect())


def test_totals_join_without_broadcast(spark, comments, topic_map):
    counts = N.count_topic_words(comment_words(comments, topic_map, START, END, mark_repeated=True))
    assert rows(N.add_daily_totals(counts, 1), *GOLDEN_COLUMNS[:7]) == rows(
        N.add_daily_totals(counts), *GOLDEN_COLUMNS[:7]
    )


def stored(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_comments_are_scanned_and_shuffled_once(spark, tmp_path, comments, topic_map):
    """The totals reuse the counts instead of reading comments again."""
    statistics = comment_statistics(
        stored(comments, str(tmp_path / "c")), stored(topic_map, str(tmp_path / "m")), START, END
    )
    statistics.collect()
    plan = statistics._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    scans = [line for line in final.splitlines() if "FileScan" in line and "body#" in line]
    assert len(scans) == 1, scans
    assert "ReusedExchange" in final


def test_stored_counts_cut_the_lineage(tmp_path, comments, topic_map):
    path = str(tmp_path / "counts")
    statistics = comment_statistics(comments, topic_map, START, END, counts_path=path)
    assert rows(statistics, *GOLDEN_COLUMNS) == sorted(GOLDEN, key=repr)
    plan = statistics._jdf.queryExecution().executedPlan().toString()
    assert "first_places" in plan and "author" not in plan and "body" not in plan


def test_trending_terms(spark):
    data = [
        ("t", "2022-01-01", word, specificity, change)
        for word, specificity, change in [
            ("a", 2.0, 0.1), ("b", 2.0, 0.3), ("c", 2.0, 0.1), ("d", 1.0, 0.9), ("e", 2.0, -0.1), ("f", 2.0, None),
        ]
    ]
    df = spark.createDataFrame(
        data, f"topic string, date string, word string, topic_specificity double, {R.CHANGE} double"
    )
    top = trending_terms(df, 1.5, 2)
    assert rows(top, "place", "word") == [(1, "b"), (2, "a")]
    assert trending_terms(df, 1.5, 2, "2022-01-02").count() == 0
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def executed_plan(df):
    """The final plan, after a run that keeps no rows."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan


def test_totals_leave_the_detail_where_it_is(spark, tokens):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        detail = spark.range(5000).selectExpr("id % 3 AS k", "id AS v", "repeat('x', 50) AS wide")
        out = N.with_group_totals(detail, "v", {"s": ["k"]})
        assert "hashpartitioning" not in executed_plan(out)
        plan = executed_plan(N.add_word_counts(tokens))
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_salted_totals_equal_broadcast_ones(spark):
    data = [("hot", 7)] * 300 + [("hot", k) for k in range(300)] + [("a", 1), (None, 5)]
    df = spark.createDataFrame(data, "k string, v long")
    salted = N.with_group_totals(df, "v", {"s": ["k"]}, max_bytes=0)
    assert rows(salted) == rows(N.with_group_totals(df, "v", {"s": ["k"]}))
    assert rows(salted.select("k", "s").distinct()) == [("a", 1), ("hot", 7 * 300 + sum(range(300)))]
    assert salted.count() == 601


def test_token_counts_read_tokens_once(spark, tokens):
    counts = N.token_counts(tokens)
    assert executed_plan(counts).count("InMemoryTableScan") == 2  # comments and map
    odd = tokens.unionByName(spark.createDataFrame(
        [(None, "nuts", "pecan", "2022-01-01"), (None, "food", "pecan", "2022-01-01"),
         ("x", None, "pecan", "2022-01-01"), ("x", "food", None, "2022-01-01")],
        COMMENT_TOKENS,
    ))
    pecan = N.token_counts(odd).where("word = 'pecan' AND date = '2022-01-01'").first()
    # Three comments, one without an id, and one without a topic.
    assert pecan["daily_word_frequency"] == 5
    assert {(r["topic"], r[N.IN_TOPIC]) for r in pecan["in_topic"]} == {
        ("food", 4), ("fruit", 1), ("nuts", 3), (None, 1),
    }
