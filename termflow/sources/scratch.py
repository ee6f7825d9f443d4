"""Tables that a computation needs more than once, in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from termflow.session import shared_folder


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The rows of ``df`` from a written table: computed once, no lineage.

    It is written at once, to ``path`` or a new scratch folder, and stays there
    until the owner of the folder empties it.
    """
    path = path or shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
