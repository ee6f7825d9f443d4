"""Tables between the jobs of one operator, in the folder the cluster shares."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from termflow.session import shared_folder

new_folder = shared_folder

#: Copies of whole texts stay to the end and are most of the disk: 8 % less than at 3.
ZSTD_LEVEL = "parquet.compression.codec.zstd.level"
TEXT_LEVEL = 9

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is executed within deletes its shuffle files as soon as it ends.

    Else they stay until the driver happens to collect its garbage, beside the
    table that was written from them. Frames that were written run anew if used
    again; the session's own setting is put back.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str, level: int = 3) -> DataFrame:
    """The rows of ``df`` from a written table: computed once, no lineage.

    A lost executor costs a read, not the work before it. The table stays
    until the owner of the checkpoint folder empties it. ``level`` is zstd's.
    """
    path = new_folder(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.options(compression="zstd", **{ZSTD_LEVEL: level}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
