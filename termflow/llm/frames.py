"""Small helpers on DataFrames of any columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What lies between words.
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def split_words(text: Column) -> Column:
    """The words of a text, none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BLANK}+"), "")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
