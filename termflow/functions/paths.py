"""Partition values in object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partition_value(key: Column, strict: bool = False) -> Column:
    """Value of the directory just above a file: ``a/id_group=7/f`` gives 7.

    Keys of success markers give NULL, and so do keys without a ``name=value``
    directory, unless ``strict``, which fails the query on those.
    """
    directory = F.try_element_at(F.split(key, "/"), F.lit(-2))
    value = F.try_element_at(F.split(directory, "="), F.lit(2))
    if strict:
        value = F.coalesce(
            value,
            F.raise_error(
                F.concat(F.lit("no name=value directory in key: "), key)
            ).cast("string"),
        )
    return F.when(~key.contains("_SUCCES"), value)
