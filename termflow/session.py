"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(
    app_name: str = "termflow", master: str | None = None, **configs: str
) -> SparkSession:
    """A session in UTC, so that timestamps are shown and compared in UTC.

    Values of partition folders stay strings, as ``date`` is in all tables here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    builder = builder.config(
        "spark.sql.sources.partitionColumnTypeInference.enabled", "false"
    )
    for key, value in configs.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that executors and driver share.

    That is ``spark.checkpoint.dir``, or a folder of the warehouse where it is
    not set. Who asks for the path deletes it.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        root = f"{warehouse.rstrip('/')}/checkpoints"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
