import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

from termflow.schemas import COMMENTS, TOPIC_MAP  # noqa: E402
from termflow.session import build_session  # noqa: E402

START, END = "2022-01-01 00:00:00", "2023-01-01 00:00:00"

# Six comments, of which four lie in range and have topics.
COMMENT_ROWS = [
    ("neckbeard", "this comment should not make it in", "1640908800", "not_included"),
    ("edgelord", "banana and banana or cherry the pecan", "1640995200", "fruits"),
    ("nutlord", "walnut pecan", "1640995200", "aww_nuts"),
    ("lovenuts", "walnut pecan", "1640995200", "go_nuts"),
    ("fruitposter", "cherry apple pecan", "1641081600", "fruits"),
    ("elderposter", "this comment should not make it in!", "1704067200", "not_included"),
]
MAP_ROWS = [
    ("fruits", "fruit,food"),
    ("nuts", "nuts,food"),
    ("aww_nuts", "nuts,food"),
    ("go_nuts", "nuts,food"),
    ("not_included", "nuts,food"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            # Many tiny queries: quick compilation beats fast code.
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def comments(spark):
    return spark.createDataFrame(COMMENT_ROWS, COMMENTS).coalesce(1).cache()


@pytest.fixture(scope="session")
def topic_map(spark):
    return spark.createDataFrame(MAP_ROWS, TOPIC_MAP).coalesce(1).cache()


def rows(df, *columns):
    """Sorted tuples of the given columns, all by default."""
    picked = df.select(*columns) if columns else df
    return sorted(map(tuple, picked.collect()), key=repr)


def has_schema(df, schema):
    """Same names and types in the same order; nullability may differ."""
    return df.dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
