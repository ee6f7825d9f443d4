"""Pieces of HTML text as native column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Named and numeric entities decoded in text, ampersand last.
ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&amp;", "&"),
)

# What ends a line of text.
LINE_BREAK = r"(?:\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029])"


def any_tag(tags: Sequence[str]) -> str:
    return "(?:" + "|".join(tags) + ")"


def plain_text(fragment: Column) -> Column:
    """Text of a fragment: tags and comments dropped, entities decoded."""
    text = F.regexp_replace(fragment, r"(?s)<!--.*?-->|<[^>]*>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def text_lines(text: Column) -> Column:
    """Array of lines; a final line break opens no further line."""
    body = F.regexp_replace(text, LINE_BREAK + r"\z", "")
    return F.when(text != "", F.split(body, LINE_BREAK))


def elements(fragment: Column, tag: str) -> Column:
    """Array of inner fragments of every ``tag`` element."""
    return F.regexp_extract_all(
        fragment, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), F.lit(1)
    )


def opening_tag(tags: Sequence[str], attributes: str = "") -> str:
    """Pattern of an opening tag that contains a pattern; group 1 is its name."""
    return rf"(?is)<({any_tag(tags)})\b[^>]*{attributes}[^>]*>"


def until_closed(rest: Column, tag: Column) -> Column:
    """Content of an element, given the text after its opening tag.

    Nested elements of the same tag are kept: the text is cut where tags of
    that name start or end, and the pieces are taken up to the one at which the
    depth falls to zero, or all of them if the element is never closed.
    """
    cuts = F.concat(F.lit("(?i)(?=</?"), tag, F.lit(r"\b)"))
    pieces = F.split(rest, cuts)

    def step(state: Column, piece: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, r"^<(/?\w+)", 1))
        depth = (
            state["depth"]
            + F.when(name == state["tag"], 1)
            .when(name == F.concat(F.lit("/"), state["tag"]), -1)
            .otherwise(0)
        )
        open_before, open_after = state["depth"] > 0, depth > 0
        kept = state["kept"] + (open_before & open_after).cast("int")
        return F.struct(
            F.when(open_before, depth).otherwise(0).alias("depth"),
            kept.alias("kept"),
            state["tag"].alias("tag"),
        )

    # The tag travels in the state so that it is computed once, not per piece.
    start = F.struct(
        F.lit(1).alias("depth"),
        F.lit(0).alias("kept"),
        F.lower(tag).alias("tag"),
    )
    kept = F.aggregate(pieces, start, step)["kept"]
    return F.array_join(F.slice(pieces, F.lit(1), kept), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_element(
    html: Column, tags: Sequence[str], attributes: str = ""
) -> Column:
    """Inner fragment of the first of ``tags`` in a text, NULL without one.

    ``attributes`` is a pattern that the opening tag has to contain.
    """
    opening = opening_tag(tags, attributes)

    def closed(tag: Column) -> Column:
        rest = F.regexp_extract(html, opening + "(.*)", 2)
        return F.when(tag != "", let(rest, lambda text: until_closed(text, tag)))

    return let(F.regexp_extract(html, opening, 1), closed)


def add_first_element(
    df: DataFrame,
    html: str,
    new_col: str,
    tags: Sequence[str],
    attributes: str = "",
) -> DataFrame:
    """``first_element`` of a column."""
    return df.withColumn(new_col, first_element(F.col(html), tags, attributes))
