import random

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from termflow.functions.paths import partition_value
from termflow.operators.listings import (
    PERCENTS,
    add_id_group,
    freshness_counts,
    latest_key_per_group,
    size_percentiles,
)
from termflow.plans.file_audit import audit_files
from termflow.schemas import LISTING
from termflow.sources.readers import list_files


def listing(spark, *files):
    df = spark.createDataFrame(files, "key string, last_modified string, size long")
    return df.withColumn("last_modified", F.to_timestamp("last_modified")).select(*LISTING.names)


def sized(spark, sizes):
    return spark.createDataFrame([(s,) for s in sizes], "size long")


def test_freshness_counts(spark):
    df = listing(
        spark,
        ("a", "2022-01-01 00:00:00", 1),
        ("b", "2022-01-02 00:00:00", 1),
        ("c", "2022-01-03 00:00:00", 1),
    )
    assert tuple(freshness_counts(df, "2022-01-02 00:00:00").first()) == (1, 2)
    assert tuple(freshness_counts(df).first()) == (0, 3)


@pytest.mark.parametrize(
    "sizes",
    [
        [7],
        [3, 1, 2],
        list(range(100, 0, -1)),
        [5] * 50 + [1, 9],
        [0, 2**62, 2**41, 2**41 + 1, 2**20, 2**20 - 1, -5, -(2**50)],
    ],
)
def test_size_percentiles(spark, sizes):
    ordered = sorted(sizes)
    index = [int(p / 100.0 * len(sizes)) for p in PERCENTS]
    expected = [ordered[0], *(ordered[i] for i in index), ordered[-1]]
    row = size_percentiles(sized(spark, sizes)).first()
    assert list(row) == expected
    assert list(row.asDict()) == ["size_min", "p10", "p25", "p50", "p75", "p90", "size_max"]


def test_size_percentiles_of_skewed_sizes(spark):
    rng = random.Random(7)
    sizes = [rng.choice([4096, rng.randrange(2**45)]) for _ in range(2000)]
    ordered = sorted(sizes)
    row = size_percentiles(sized(spark, sizes), [1, 50, 99]).first()
    assert row["p1"] == ordered[20] and row["p50"] == ordered[1000] and row["p99"] == ordered[1980]


def test_size_percentiles_plan(spark):
    plan = size_percentiles(sized(spark, [1]))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_size_percentiles_of_nothing(spark):
    assert set(size_percentiles(sized(spark, [])).first()) == {None}


KEYS = [
    ("b/id_group=7/part-1", "7"),
    ("b/id_group=7/part-2", "7"),
    ("b/x=1/id_group=8=z/part-0", "8"),
    ("b/id_group=9/_SUCCESS", None),
    ("_SUCCESS", None),
]


def keys(spark, *extra):
    return spark.createDataFrame([(k,) for k, _ in KEYS] + [(k,) for k in extra], "key string")


def test_partition_values(spark):
    df = keys(spark).select("key", partition_value(F.col("key"), strict=True))
    assert rows(df) == sorted(KEYS, key=repr)


@pytest.mark.parametrize("key", ["b/plain/part-0", "part-0"])
def test_malformed_keys(spark, key):
    df = keys(spark, key)
    assert add_id_group(df).where("id_group is null").count() == 3
    with pytest.raises(PySparkException, match="no name=value"):
        add_id_group(df, strict=True).collect()


def test_latest_key_per_group(spark):
    assert rows(latest_key_per_group(keys(spark))) == [
        ("7", "b/id_group=7/part-2"),
        ("8", "b/x=1/id_group=8=z/part-0"),
    ]


def test_audit(spark):
    df = listing(spark, ("b/g=1/p-0", "2022-01-01 00:00:00", 3), ("b/g=1/p-1", "2022-01-05 00:00:00", 5))
    audit = audit_files(df, "2022-01-02 00:00:00")
    assert tuple(audit["freshness"].first()) == (1, 1)
    assert audit["sizes"].first()["p50"] == 5
    assert rows(audit["latest_keys"]) == [("1", "b/g=1/p-1")]
    with pytest.raises(ValueError, match="no keys"):
        audit_files(df.where("false"))
    with pytest.raises(ValueError, match="no new files"):
        audit_files(df, "2023-01-01 00:00:00")


def test_list_files(spark, tmp_path):
    for group in (1, 2):
        folder = tmp_path / f"id_group={group}"
        folder.mkdir()
        (folder / "part-0").write_text("x" * group)
    df = list_files(spark, str(tmp_path))
    assert rows(df, "size") == [(1,), (2,)]
    assert rows(add_id_group(df), "id_group", "size") == [("1", 1), ("2", 2)]
