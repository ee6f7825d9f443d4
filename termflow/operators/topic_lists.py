"""Lists of (topics, subreddit) rows taken from pages, merged and cleaned."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termflow.functions.html import (
    any_tag,
    elements,
    first_element,
    let,
    plain_text,
    text_lines,
)
from termflow.functions.names import (
    TOPIC_RULES,
    community_name,
    replace_in_order,
)

# Where a row stands in its pages; the order in which lists are merged.
ORDINALS = ("page_id", "block_no", "line_no")


ROW = "array<struct<block_no:int,line_no:int,topics:string,subreddit:string>>"


def heading_rows(
    html: Column,
    heading_tags: Sequence[str] = ("h2", "h3"),
    label_tags: Sequence[str] = ("strong", "em"),
    block_tags: Sequence[str] = ("p", "ul", "ol", "div", "blockquote", "table"),
) -> Column:
    """Array with the rows of ``extract_heading_blocks`` of one page."""
    headings = any_tag(heading_tags)
    label_end = any_tag(label_tags or heading_tags)

    def label_of(heading: Column) -> Column:
        if not label_tags:
            return heading
        return F.coalesce(
            *(F.get(elements(heading, tag), F.lit(0)) for tag in label_tags)
        )

    def lines(section: Column, block_no: Column, label: Column) -> Column:
        after = F.regexp_extract(section, rf"(?is)</{label_end}\s*>(.*)", 1)
        block = let(after, lambda text: first_element(text, block_tags))
        return F.transform(
            let(plain_text(block), text_lines),
            lambda line, line_no: F.struct(
                block_no.alias("block_no"),
                line_no.alias("line_no"),
                label.alias("topics"),
                line.alias("subreddit"),
            ),
        )

    def rows_of(section: Column, block_no: Column) -> Column:
        heading = F.regexp_extract(
            section, rf"(?is)^<[^>]*>(.*?)(?:</{headings}\s*>|\z)", 1
        )
        label = plain_text(let(heading, label_of))
        rows = let(
            label,
            lambda label: F.when(
                label.isNotNull(), lines(section, block_no, label)
            ),
        )
        is_heading = section.rlike(rf"(?i)^<{headings}\b")
        return F.coalesce(F.when(is_heading, rows), F.array().cast(ROW))

    return F.flatten(F.transform(F.split(html, rf"(?i)(?=<{headings}\b)"), rows_of))


def link_rows(
    html: Column,
    page_id: Column,
    container: tuple[str, str] = ("div", r'\bclass\s*=\s*["\']md wiki["\']'),
    item_tag: str = "p",
    anchor_attr: str = r'\brel\s*=\s*["\']?[^"\'>]*\bnofollow\b',
    text_prefix: str = "/r/",
    label: str = "Video Games",
    strict: bool = False,
) -> Column:
    """Array with the rows of ``extract_links`` of one page."""
    tag, attributes = container
    content = first_element(html, [tag], attributes)
    if strict:
        missing = F.concat(F.lit("no link container in page "), page_id)
        content = F.coalesce(content, F.raise_error(missing).cast("string"))
    anchor = rf"(?is)<a\b[^>]*{anchor_attr}[^>]*>(.*?)</a\s*>"

    def rows_of(item: Column, block_no: Column) -> Column:
        return F.transform(
            F.regexp_extract_all(item, F.lit(anchor), F.lit(1)),
            lambda text, line_no: F.struct(
                block_no.alias("block_no"),
                line_no.alias("line_no"),
                F.lit(label).alias("topics"),
                plain_text(text).alias("subreddit"),
            ),
        )

    rows = F.flatten(F.transform(let(content, lambda c: elements(c, item_tag)), rows_of))
    return F.filter(rows, lambda row: row["subreddit"].startswith(text_prefix))


def extract_heading_blocks(pages: DataFrame, **options) -> DataFrame:
    """One row per text line of the block that follows a heading's label.

    ``topics`` is the text of the first of ``label_tags`` found in the heading,
    tried in their order; without ``label_tags`` it is the heading's own text.
    The block is the first ``block_tags`` element after the label and before
    the next heading; never closed, it runs up to there. Headings without label
    or block give nothing. Options are those of ``heading_rows``.
    """
    rows = heading_rows(F.col("html"), **options)
    return pages.select("page_id", F.inline(rows)).select(
        *ORDINALS, "topics", "subreddit"
    )


def extract_links(pages: DataFrame, **options) -> DataFrame:
    """One row per link text in the items of a page's first ``container``.

    ``container`` is a tag and a pattern for its attributes. Links need an
    attribute matching ``anchor_attr`` and a text starting with
    ``text_prefix``; all of them get the topic ``label``. A page without the
    container gives no row, or fails the query if ``strict``. Options are those
    of ``link_rows``.
    """
    rows = link_rows(F.col("html"), F.col("page_id"), **options)
    return pages.select("page_id", F.inline(rows)).select(
        *ORDINALS, "topics", "subreddit"
    )


def extract_both(
    pages: DataFrame, heading_options: dict, link_options: dict
) -> DataFrame:
    """Headed lists and links of the same pages, which are read once.

    ``list_no`` is 0 for rows of headed lists and 1 for links.
    """
    lists = F.array(
        F.struct(
            F.lit(0).alias("list_no"),
            heading_rows(F.col("html"), **heading_options).alias("rows"),
        ),
        F.struct(
            F.lit(1).alias("list_no"),
            link_rows(F.col("html"), F.col("page_id"), **link_options).alias("rows"),
        ),
    )
    return pages.select("page_id", F.inline(lists)).select(
        "page_id", "list_no", F.inline("rows")
    )


def merge_topic_lists(*lists: DataFrame, delimiter: str = ",") -> DataFrame:
    """Distinct topics of each subreddit in one string, first seen first.

    Earlier lists come first, then the order within a list. Rows without
    subreddit are dropped.
    """
    rows = None
    for number, part in enumerate(lists):
        part = part.select(
            F.lit(number).alias("list_no"), *ORDINALS, "topics", "subreddit"
        )
        rows = part if rows is None else rows.unionByName(part)
    return merge_numbered(rows, delimiter)


def merge_numbered(rows: DataFrame, delimiter: str = ",") -> DataFrame:
    """``merge_topic_lists`` of one frame with the column ``list_no``.

    Repeats are merged before topics are gathered, so a group holds no more than
    the distinct topics it has to print.
    """
    return (
        rows.where(F.col("subreddit").isNotNull())
        .groupBy("topics", "subreddit")
        .agg(F.min(F.struct("list_no", *ORDINALS)).alias("seen"))
        .groupBy("subreddit")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("seen", "topics"))),
                    lambda row: row["topics"],
                ),
                delimiter,
            ).alias("topics")
        )
        .select("topics", "subreddit")
    )


def clean_topic_lists(
    topic_lists: DataFrame,
    rules: Iterable[tuple[str, str]] = TOPIC_RULES,
    anchored_names: bool = False,
) -> DataFrame:
    """Clean names and topic strings of merged lists.

    Names that become equal stay separate rows, as merging comes before.
    """
    return topic_lists.withColumns(
        {
            "subreddit": community_name(F.col("subreddit"), anchored_names),
            "topics": replace_in_order(F.col("topics"), rules),
        }
    )
