import json
from datetime import date, datetime, timezone

from conftest import COMMENT_ROWS, END, START, rows
from pyspark.sql import Observation

from termflow.plans.job import JobSettings
from termflow.plans.word_statistics import comment_statistics
from termflow.schemas import COMMENTS
from termflow.sources.listing import ListingReader, list_store
from termflow.sources.readers import read_statistics, split_json_comments
from termflow.streaming.discovery import refresh_from_new_files, runs_of_days


def test_corrupt_lines_go_to_a_side_table(spark, tmp_path):
    path, store = str(tmp_path / "c.json"), str(tmp_path / "store")
    good = {"author": "a", "body": "x\ny", "created_utc": 1640995200, "subreddit": "s", "score": 5}
    lines = [json.dumps(good), "no json", "", '{"author": "b"', json.dumps({"author": None}), "no json"]
    (tmp_path / "c.json").write_text("\n".join(lines))
    counted = Observation("lines")
    comments, corrupt = split_json_comments(spark, path, store, counted)
    assert rows(comments) == [("a", "x\ny", "1640995200", "s"), (None, None, None, None)]
    assert rows(corrupt) == [("no json",), ("no json",), ('{"author": "b"',)]
    assert counted.get == {"comments": 2, "corrupt": 3}
    (tmp_path / "empty.json").write_text("")
    both = split_json_comments(spark, str(tmp_path / "empty.json"), str(tmp_path / "none"))
    assert [df.count() for df in both] == [0, 0]


def test_store_is_listed_by_prefix(spark, tmp_path):
    root = tmp_path / "store"
    for name in ("top", "a/x", "a/b/y", "a/b/c/zz", "d/w", "é b/v=1/u"):
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("x" * len(name))
    (root / "empty").mkdir()
    want = sorted((f"{root}/{n}", len(n)) for n in ("top", "a/x", "a/b/y", "a/b/c/zz", "d/w", "é b/v=1/u"))
    for depth, tasks in ((0, 1), (1, 5), (2, 7)):
        files = list_store(spark, str(root), depth)
        assert rows(files, "key", "size") == want
        assert len(ListingReader(str(root), depth).partitions()) == tasks
    since = datetime.now(timezone.utc).timestamp() - (root / "top").stat().st_mtime
    assert 0 <= since < 3600 and files.where("last_modified > now() - interval 1 hour").count() == 6
    assert rows(list_store(spark, f"file://{root}/d"), "size") == [(3,)]


def test_runs_of_days():
    days = [date(2022, 1, n) for n in (5, 1, 2, 9, 3, 5, 6)]
    assert [(a.day, b.day) for a, b in runs_of_days(days)] == [(1, 3), (5, 6), (9, 9)]
    assert runs_of_days([]) == []


def test_new_files_refresh_their_days_only(spark, topic_map, tmp_path):
    folder, path = str(tmp_path / "comments"), str(tmp_path / "out")
    settings = JobSettings(None, END, path)

    def drop(*found):
        df = spark.createDataFrame(found, COMMENTS).coalesce(1)
        df.write.mode("append").json(folder)
        return refresh_from_new_files(spark, folder, topic_map, settings, str(tmp_path / "taken"))

    in_range = [r for r in COMMENT_ROWS if r[3] != "not_included"]
    assert drop(*in_range) == [(date(2022, 1, 1), date(2022, 1, 2))]
    late = [("late", "plum", str(1641081600 + k * 86400), "fruits") for k in (0, 4, 5)]
    assert drop(*late) == [
        (date(2022, 1, 2), date(2022, 1, 2)),
        (date(2022, 1, 6), date(2022, 1, 7)),
    ]
    assert drop(("odd", "plum", "no time", "fruits")) == []
    everything = spark.createDataFrame(in_range + late, COMMENTS)
    assert rows(read_statistics(spark, path)) == rows(
        comment_statistics(everything, topic_map, START, END)
    )
