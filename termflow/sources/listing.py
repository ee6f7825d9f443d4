"""Listing of a large store as a data source: a task per prefix.

The driver lists the folders of the first levels only; each of the prefixes it
finds is walked by a task, folder by folder, so neither the driver nor a task
ever holds all names. Stores are those of ``pyarrow.fs``: local and mounted
folders, S3, GCS and HDFS.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from termflow.schemas import LISTING

NAME = "store_listing"
TOGETHER = 10_000
ARROW = pa.schema(
    [
        ("key", pa.string()),
        ("last_modified", pa.timestamp("us", "UTC")),
        ("size", pa.int64()),
    ]
)


@dataclass
class Prefix(InputPartition):
    """A folder, with all that is below it or only its own files."""

    path: str
    below: bool


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it; a plain path is a local one."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


class ListingReader(DataSourceReader):
    def __init__(self, path: str, depth: int):
        self.path, self.depth = path, depth

    def partitions(self) -> list[Prefix]:
        store, root = opened(self.path)
        level, found = [root], []
        for _ in range(self.depth):
            found += [Prefix(folder, False) for folder in level]
            level = [
                info.path
                for folder in level
                for info in store.get_file_info(fs.FileSelector(folder))
                if info.type == fs.FileType.Directory
            ]
        return found + [Prefix(folder, True) for folder in level]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.path)
        folders, rows = [partition.path], []
        while folders:
            for info in store.get_file_info(fs.FileSelector(folders.pop())):
                if info.type == fs.FileType.File:
                    rows.append((info.path, info.mtime, info.size))
                elif partition.below and info.type == fs.FileType.Directory:
                    folders.append(info.path)
                if len(rows) == TOGETHER:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), ARROW)],
        schema=ARROW,
    )


class Listing(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return LISTING

    def reader(self, schema: StructType) -> ListingReader:
        depth = int(self.options.get("depth", 1))
        return ListingReader(self.options["path"], depth)


def list_store(spark: SparkSession, path: str, depth: int = 1) -> DataFrame:
    """Listing (key, last_modified, size) of all files below a path.

    ``depth`` is the number of levels whose folders become tasks of their own;
    choose it so that a prefix holds what a task can walk.
    """
    spark.dataSource.register(Listing)
    return spark.read.format(NAME).option("depth", depth).load(path)
