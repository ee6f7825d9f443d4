"""Pages to a cleaned community-to-topics map."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from termflow.functions.names import TOPIC_RULES
from termflow.operators.topic_lists import (
    clean_topic_lists,
    extract_both,
    extract_heading_blocks,
    extract_links,
    merge_numbered,
    merge_topic_lists,
)


def build_topic_map(
    heading_pages: DataFrame,
    link_pages: DataFrame,
    rules: Iterable[tuple[str, str]] = TOPIC_RULES,
    heading_options: dict | None = None,
    link_options: dict | None = None,
    delimiter: str = ",",
) -> DataFrame:
    """(topics, subreddit) from pages of headed lists and pages of links.

    Both inputs have (page_id, html); given as one frame, it is read once. The
    result fits ``write_topic_map``.
    """
    headings, links = heading_options or {}, link_options or {}
    if heading_pages is link_pages:
        merged = merge_numbered(extract_both(link_pages, headings, links), delimiter)
    else:
        merged = merge_topic_lists(
            extract_heading_blocks(heading_pages, **headings),
            extract_links(link_pages, **links),
            delimiter=delimiter,
        )
    return merged.transform(clean_topic_lists, rules)
