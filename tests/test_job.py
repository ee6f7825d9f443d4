import json
import os

import pytest
from conftest import COMMENT_ROWS, END, START, rows
from pyspark.sql import functions as F
from test_statistics import GOLDEN, GOLDEN_COLUMNS, random_comments

from termflow.functions.dates import epoch_day
from termflow.operators.broadcasts import broadcast_if_small
from termflow.plans.comment_tokens import comment_tokens
from termflow.plans.job import JobSettings, run_job
from termflow.plans.word_statistics import comment_statistics
from termflow.schemas import COMMENTS, TOPIC_MAP
from termflow.session import shared_folder
from termflow.sources.readers import (
    corrupt_lines,
    read_json_comments,
    read_source,
    read_statistics,
    table_or_none,
)
from termflow.sources.writers import write_partitioned


def test_golden_job(spark, comments, topic_map, tmp_path):
    settings = JobSettings(START, END, str(tmp_path / "out"), audit_path=str(tmp_path / "audit"))
    result = run_job(spark, comments, topic_map, settings)
    assert rows(result["word_statistics"], *GOLDEN_COLUMNS) == sorted(GOLDEN, key=repr)
    assert rows(result["comment_tokens"]) == rows(comment_tokens(comments, topic_map, START, END))
    assert sorted(os.listdir(tmp_path / "out" / "topic=food"))[-2:] == ["date=2022-01-01", "date=2022-01-02"]
    audit = spark.read.parquet(settings.audit_path)
    assert rows(audit, "min_date", "max_date", "rows") == [("2022-01-01", "2022-01-02", 15)]
    run_job(spark, comments, topic_map, settings)
    assert spark.read.parquet(settings.audit_path).select("run_id").distinct().count() == 2


def test_topics_with_slashes_survive_the_path(spark, tmp_path):
    comments = spark.createDataFrame([("a", "nut", "1640995200", "s")], COMMENTS)
    topic_map = spark.createDataFrame([("s", "Nostalgia/Time,a:b=c")], TOPIC_MAP)
    settings = JobSettings(START, END, str(tmp_path / "out"))
    result = run_job(spark, comments, topic_map, settings)["word_statistics"]
    assert rows(result, "topic", "date") == [("a:b=c", "2022-01-01"), ("nostalgia/time", "2022-01-01")]


def test_empty_topics_can_be_dropped(spark, tmp_path):
    comments = spark.createDataFrame([("a", "nut", "1640995200", "s")], COMMENTS)
    topic_map = spark.createDataFrame([("s", "food,")], TOPIC_MAP)
    assert rows(comment_tokens(comments, topic_map, START, END), "topic") == [("",), ("food",)]
    settings = JobSettings(START, END, str(tmp_path / "out"), options={"drop_empty_topics": True})
    result = run_job(spark, comments, topic_map, settings)
    assert rows(result["word_statistics"], "topic") == rows(result["comment_tokens"], "topic") == [("food",)]


def test_catalog_table(spark, comments, topic_map, tmp_path):
    assert table_or_none(spark, "word_stats") is None
    settings = JobSettings(START, END, str(tmp_path / "out"), table="word_stats")
    run_job(spark, comments, topic_map, settings)
    stored = table_or_none(spark, "word_stats")
    assert stored.count() == 15
    assert read_source(spark, "word_stats", "table").count() == 15
    more = spark.createDataFrame(
        COMMENT_ROWS + [("late", "plum", "1641168000", "fruits")], COMMENTS
    )
    late = JobSettings("2022-01-03", END, settings.target_path, table="word_stats", incremental=True)
    run_job(spark, more, topic_map, late)
    spark.catalog.refreshTable("word_stats")
    assert rows(spark.table("word_stats").where("date = '2022-01-03'"), "topic", "word") == [
        ("food", "plum"),
        ("fruit", "plum"),
    ]
    spark.sql("DROP TABLE word_stats")


def test_reads_prune_partitions_and_columns(spark, comments, topic_map, tmp_path):
    path = str(tmp_path / "out")
    write_partitioned(comment_statistics(comments, topic_map, START, END), path)
    df = read_statistics(spark, path).where("topic = 'food' and date = '2022-01-02'").select("word", "rate")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<word:string,rate:double>" in plan
    assert "(topic#" in plan[plan.index("PartitionFilters") :]
    assert df.count() == 3


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = "topic string, date string, word string"
    write_partitioned(spark.createDataFrame([("a", "d1", "x"), ("a", "d2", "x")], schema), path)
    write_partitioned(spark.createDataFrame([("a", "d2", "y")], schema), path, only_touched=True)
    assert rows(spark.read.schema(schema).parquet(path), "topic", "date", "word") == [("a", "d1", "x"), ("a", "d2", "y")]


def test_json_comments(spark, tmp_path):
    path = tmp_path / "c.json"
    lines = [
        {"author": "a", "body": "x\ny", "created_utc": 1640995200, "subreddit": "s", "score": 5, "gilded": {"a": 1}},
        {"author": None, "body": "z", "created_utc": "1640995201", "subreddit": "s"},
    ]
    path.write_text("\n".join(map(json.dumps, lines)))
    assert rows(read_json_comments(spark, str(path))) == [
        ("a", "x\ny", "1640995200", "s"),
        (None, "z", "1640995201", "s"),
    ]


def test_read_source_with_schema(spark, comments, tmp_path):
    path = str(tmp_path / "c")
    comments.write.parquet(path)
    assert rows(read_source(spark, path)) == rows(read_source(spark, path, "parquet", COMMENTS)) == rows(comments)


def test_broadcast_needs_a_measured_size(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as k")
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(spark.range(1).join(broadcast_if_small(df), F.lit(True)))
    assert broadcast_if_small(df, 1000) is df
    assert broadcast_if_small(df, 0) is df


def test_shared_folder_is_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(root + "/x-") and one != two


def full_and_refreshed(spark, tmp_path, before, after, topic_map, start, end):
    """Statistics after a refresh, and those of a full run over ``after``."""
    path = str(tmp_path / "target")
    run_job(spark, before, topic_map, JobSettings(START, END, path))
    settings = JobSettings(start, end, path, incremental=True)
    refreshed = run_job(spark, after, topic_map, settings)["word_statistics"]
    return rows(refreshed), rows(comment_statistics(after, topic_map, START, END))


def in_days(comments, first, last):
    return comments.where(epoch_day("created_utc").between(F.lit(first), F.lit(last)))


@pytest.mark.parametrize("end", ["2022-01-06", "2023-01-01"])
def test_refresh_after_late_comments_equals_full_run(spark, tmp_path, end):
    comments, topic_map = random_comments(spark, 11, 300)
    late = in_days(comments, "2022-01-04", "2022-01-06").where("body like '%w3%' or author = 'hot'")
    before = comments.exceptAll(late)
    refreshed, full = full_and_refreshed(spark, tmp_path, before, comments, topic_map, "2022-01-04", end)
    assert refreshed == full


def test_refresh_with_new_days_equals_full_run(spark, tmp_path):
    comments, topic_map = random_comments(spark, 12, 300)
    before = in_days(comments, "2022-01-01", "2022-01-07")
    refreshed, full = full_and_refreshed(
        spark, tmp_path, before, comments, topic_map, "2022-01-08", "2023-01-01"
    )
    assert refreshed == full


def test_refresh_drops_partitions_without_comments(spark, tmp_path):
    comments, topic_map = random_comments(spark, 13, 300)
    gone = in_days(comments, "2022-01-03", "2022-01-04").where("subreddit in ('c0', 'c3')")
    after = comments.exceptAll(gone).exceptAll(in_days(comments, "2022-01-05", "2022-01-05"))
    refreshed, full = full_and_refreshed(
        spark, tmp_path, comments, after, topic_map, "2022-01-03", "2022-01-05"
    )
    assert refreshed == full
    assert not any(row[3] == "2022-01-05" for row in refreshed)


def test_refresh_with_an_empty_topic_equals_full_run(spark, tmp_path):
    comments, _ = random_comments(spark, 14, 200)
    topic_map = spark.createDataFrame([("c0", "food,"), ("c1", "nuts")], TOPIC_MAP)
    before = in_days(comments, "2022-01-01", "2022-01-05")
    refreshed, full = full_and_refreshed(
        spark, tmp_path, before, comments, topic_map, "2022-01-06", "2023-01-01"
    )
    assert refreshed == full
    assert any(row[1] == "" and row[-1] is not None for row in full)


def test_incremental_run_on_an_empty_target_is_a_full_one(spark, comments, topic_map, tmp_path):
    settings = JobSettings(START, END, str(tmp_path / "out"), incremental=True)
    result = run_job(spark, comments, topic_map, settings)["word_statistics"]
    assert rows(result, *GOLDEN_COLUMNS) == sorted(GOLDEN, key=repr)


def test_incremental_run_starts_from_the_audit(spark, comments, topic_map, tmp_path):
    target, audit = str(tmp_path / "out"), str(tmp_path / "audit")
    late = JobSettings(None, END, target, audit_path=audit, incremental=True)
    with pytest.raises(ValueError):
        run_job(spark, comments, topic_map, late)
    first = JobSettings(START, "2022-01-01", target, audit_path=audit)
    run_job(spark, comments, topic_map, first)
    result = run_job(spark, comments, topic_map, late)["word_statistics"]
    assert rows(result, *GOLDEN_COLUMNS) == sorted(GOLDEN, key=repr)
    assert rows(spark.read.parquet(audit), "min_date", "max_date") == [
        ("2022-01-01", "2022-01-01"),
        ("2022-01-01", "2022-01-02"),
    ]


def test_scratch_is_deleted_when_a_run_fails(spark, comments, topic_map, tmp_path):
    scratch = tmp_path / "scratch"
    blocked = tmp_path / "file"
    blocked.write_text("")
    settings = JobSettings(START, END, str(blocked / "out"), scratch_path=str(scratch))
    with pytest.raises(Exception):
        run_job(spark, comments, topic_map, settings)
    assert list(scratch.glob("*")) == []


def test_stored_tokens(spark, comments, topic_map, tmp_path):
    path = str(tmp_path / "tokens")
    settings = JobSettings(START, END, str(tmp_path / "out"), tokens_path=path)
    result = run_job(spark, comments, topic_map, settings)
    assert rows(spark.read.parquet(path)) == rows(result["comment_tokens"])


def test_malformed_lines_fail_or_are_counted(spark, tmp_path):
    path = str(tmp_path / "c.json")
    (tmp_path / "c.json").write_text('{"author": "a", "body": "x"}\nnot json\n\n')
    with pytest.raises(Exception):
        read_json_comments(spark, path).collect()
    assert read_json_comments(spark, path, mode="PERMISSIVE").count() == 2
    assert corrupt_lines(spark, path).first()[0] == 1
