"""Literal clean-up of community names and topic labels."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Substrings removed from community names, in this order.
NAME_SUBSTRINGS = ("r/", "/")

# Fixed values: (text, replacement) rules for topic labels. Order matters, each
# rule sees the result of the one before it.
TOPIC_RULES = (
    ('"', ""),
    (":Wallpapers", ""),
    ("TV:Netflix Related", "TV:NR"),
    (":Netflix Related", ""),
    ("TV:NR", "TV:Netflix Related"),
    ("Automotive:Writing", "Automotive"),
    ("Outdoors:Car companies", "Outdoors"),
    ("Design:Car companies", "Design"),
    ("Nostalgia/Time:Politics", "Nostalgia/Time"),
    ("Photography/Film:Car companies", "Photography/Film"),
    (":CryptoCurrency", ""),
    ("Self-Improvement:Sex", "Self-Improvement"),
    ("Self-Improvement:Programming", "Programming:Self-Improvement"),
    ("Self-Improvement:", ""),
    ("Shitty:Politics", "Shitty"),
    ("Unexpected:Politics", "Unexpected"),
    ("Visually Appealing:Politics", "Visually Appealing"),
    ("Categorize Later:Politics", "Categorize Later"),
    ("Sports:Instruments", "Sports"),
    ("Support:Scary/Weird", "Support"),
    ("Tech Related:Car companies", "Tech Related"),
    ("Tools:Tech Support", "Tools"),
    ("Travel:Tech Support", "Travel"),
    ("TV:Soccer", "TV"),
    ("Cute:Neckbeard", "Cute"),
    ("Dogs:Neckbeard", "Dogs"),
    ("Conspiracy:Dogs", "Conspiracy"),
    ("Cringe:Dogs", "Cringe"),
    ("Facebook:Dogs", "Cringe"),
    ("Meta:Dogs", "Cringe"),
    ("Cringe:Sci-fi", "Cringe"),
    ("General:Physics", "General"),
)


def replace_in_order(
    text: Column, rules: Iterable[tuple[str, str]]
) -> Column:
    """Apply literal replacements one after the other."""
    return reduce(
        lambda out, rule: F.replace(out, F.lit(rule[0]), F.lit(rule[1])),
        rules,
        text,
    )


def community_name(name: Column, anchored: bool = False) -> Column:
    """Drop the path decoration of a community name.

    By default every ``r/`` and then every ``/`` goes, wherever it stands, so
    ``/r/foobar/`` becomes ``fooba``. ``anchored`` strips only one leading
    ``r/`` or ``/r/`` and one trailing slash.
    """
    if anchored:
        return F.regexp_replace(name, r"^/?r/|/$", "")
    return replace_in_order(name, ((part, "") for part in NAME_SUBSTRINGS))


def topic_parts(topics: Column, drop_empty: bool = False) -> Column:
    """Distinct, trimmed, lower-case topics of a comma-separated list."""
    parts = F.array_distinct(
        F.transform(F.split(topics, ","), lambda part: F.trim(F.lower(part)))
    )
    return F.array_remove(parts, "") if drop_empty else parts
