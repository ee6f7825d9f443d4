import os

import pytest
from conftest import END, START, rows
from pyspark.sql import functions as F

from termflow.functions.dates import epoch_day
from termflow.plans import job
from termflow.plans.comment_tokens import comment_tokens
from termflow.plans.job import JobSettings, run_job
from termflow.plans.word_statistics import comment_statistics
from termflow.schemas import COMMENTS, TOPIC_MAP
from termflow.sources.readers import read_statistics, read_tokens
from termflow.streaming.series_state import (
    latest_rows,
    next_state,
    read_state,
    withdraw_state,
    write_state,
)

DAY = 86_400
FIRST_SECOND = 1640995200  # 2022-01-01


def day(n):
    return f"2022-01-{n:02d}"


def comment(n, name, body, community="a"):
    return (name, body, str(FIRST_SECOND + (n - 1) * DAY), community)


@pytest.fixture(scope="module")
def topic_map(spark):
    return spark.createDataFrame([("a", "apples"), ("b", "birds")], TOPIC_MAP).coalesce(1)


def frame(spark, found):
    return spark.createDataFrame(found, COMMENTS).coalesce(1)


def files(path):
    return {
        (folder.rpartition("topic=")[2], name)
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


def on_day(found, n):
    return {x for x in found if x[0].endswith(day(n))}


def stored_state(spark, path):
    return rows(read_state(spark, f"{path}-state"))


def test_late_day_reaches_five_rows_ahead(spark, topic_map, tmp_path):
    path = str(tmp_path / "out")
    # One word a day, one seldom; birds have no comment on the late day.
    base = [comment(n, f"u{n}", "daily seldom" if n in (1, 4, 12) else "daily") for n in range(1, 15)]
    base += [comment(n, f"v{n}", "wing", "b") for n in (1, 2, 9, 14)]
    run_job(spark, frame(spark, base), topic_map, JobSettings(START, END, path))
    before = files(path)
    late = base + [comment(3, "late", "daily extra")]
    tokens = str(tmp_path / "tokens")
    settings = JobSettings(day(3), day(3), path, incremental=True, tokens_path=tokens)
    result = run_job(spark, frame(spark, late), topic_map, settings)["word_statistics"]
    assert rows(result) == rows(comment_statistics(frame(spark, late), topic_map, START, END))
    # daily 2 of 3 words on day 3: means of days 4 to 7 change, and the change of day 8.
    after = files(path)
    same = before & after
    for n in range(1, 15):
        birds = {x for x in before if x[0].startswith("birds")}
        apples = on_day(before, n) - birds
        assert on_day(birds, n) <= same
        assert (apples <= same) == (n not in range(3, 9))
    assert stored_state(spark, path) == rows(latest_rows(read_statistics(spark, path)))
    # The same refresh again changes no later row.
    run_job(spark, frame(spark, late), topic_map, settings)
    assert {x for n in (*range(1, 3), *range(4, 15)) for x in on_day(after, n)} <= files(path)


def test_appended_days_read_the_state_and_no_history(spark, topic_map, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    tokens, whole = str(tmp_path / "tokens"), str(tmp_path / "whole")
    found = [comment(n, f"u{n}", f"daily w{n % 3}", "ab"[n % 2]) for n in range(1, 11)]
    old, new = frame(spark, found[:7]), frame(spark, found)
    run_job(spark, old, topic_map, JobSettings(START, day(7), path, tokens_path=tokens))
    read, refreshed = [], job._refreshed

    def noted(*given):
        out = refreshed(*given)
        read.extend(out.statistics.inputFiles())
        return out

    monkeypatch.setattr(job, "_refreshed", noted)
    settings = JobSettings(day(8), END, path, incremental=True, tokens_path=tokens)
    result = run_job(spark, new, topic_map, settings)
    assert read and not any(f"{path}/" in name for name in read)
    assert any(f"{path}-state" in name for name in read)
    assert rows(result["word_statistics"]) == rows(comment_statistics(new, topic_map, START, END))
    assert stored_state(spark, path) == rows(latest_rows(read_statistics(spark, path)))
    # Tokens of the earlier days stay, also when days lose all of theirs.
    assert rows(result["comment_tokens"]) == rows(comment_tokens(new, topic_map, START, END))
    fewer = new.where(~epoch_day("created_utc").between(F.lit(day(5)), F.lit(day(6))))
    settings = JobSettings(day(5), day(9), path, incremental=True, tokens_path=tokens)
    # A run that failed after it withdrew the state is repeated without one.
    withdraw_state(spark, f"{path}-state")
    assert read_state(spark, f"{path}-state") is None
    result = run_job(spark, fewer, topic_map, settings)
    run_job(spark, fewer, topic_map, JobSettings(START, END, whole, tokens_path=f"{whole}-t"))
    assert rows(result["word_statistics"]) == rows(read_statistics(spark, whole))
    assert rows(read_tokens(spark, tokens)) == rows(read_tokens(spark, f"{whole}-t"))
    assert f"date={day(5)}" not in os.listdir(tokens)
    assert stored_state(spark, path) == stored_state(spark, whole)


def test_state_takes_older_rows_where_the_last_go(spark, tmp_path):
    schema = "topic string, word string, date string, rate_in_topic double, five_day_average_of_rate_in_topic double"
    row = lambda n, rate=1.0: ("t", "w", day(n), rate, rate)
    state = spark.createDataFrame([row(n) for n in (5, 6, 7, 8)], schema)
    seeds = spark.createDataFrame([row(n) for n in (4, 5, 6, 7)], schema)
    none = spark.createDataFrame([], schema)
    assert rows(next_state(state, none, seeds, day(8), day(9))) == [row(n) for n in (4, 5, 6, 7)]
    again = spark.createDataFrame([row(8, 2.0), row(9, 3.0)], schema)
    assert rows(next_state(state, again, seeds, day(8), day(8))) == [row(6), row(7), row(8, 2.0), row(9, 3.0)]
    path = str(tmp_path / "state")
    write_state(state, path)
    write_state(again, path)
    assert rows(read_state(spark, path)) == rows(again)
    assert len(os.listdir(path)) in (2, 3)  # a version, its mark, a checksum
