import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from termflow.functions.html import add_first_element, plain_text, text_lines
from termflow.functions.names import TOPIC_RULES, community_name, replace_in_order
from termflow.operators.topic_lists import (
    clean_topic_lists,
    extract_heading_blocks,
    extract_links,
    merge_topic_lists,
)
from termflow.plans.topic_map import build_topic_map
from termflow.sources.readers import read_topic_map
from termflow.sources.writers import write_topic_map

HANDBOOK = """
<article id="top">
<h2>Contents</h2><ol><li>r/nothing</li></ol>
<h2 class="t">I. <strong>Crafts</strong> by hand</h2>
<hr><blockquote>r/knitting
r/weaving</blockquote><p>r/too_late</p>
<h3><em>old</em> and <strong>Machines</strong></h3>
<ul><li>r/lathes<ul><li>, r/mills</li></ul></li></ul>
<div><h3><strong>Kitchen</strong></h2><p>r/bread</div>
<h3><em>Kitchen</em></h3><table><tr><td>r/soup</td></tr>
<tr><td>r/knitting</td></tr></table>
</article>
"""
CATALOGUE = """
<body><div class="md"><p><a rel="nofollow" href="#">/r/outside</a></p></div>
<div id="w" class="md wiki"><h1>Games</h1>
<p><a href="/r/dice" rel="noopener nofollow">/r/dice</a>, <b><a rel=nofollow
href="/r/cards">/r/cards</a></b> <a href="/r/plain">/r/plain</a></p>
<a rel="nofollow" href="/r/loose">/r/loose</a>
<p><a rel="nofollow" href="https://x.example">site</a></p>
<div><p>new: <a rel="nofollow" href="/r/dice">/r/dice</a></p></div></div></body>
"""


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id long, html string")


def pairs(df):
    return [(r["topics"], r["subreddit"]) for r in df.orderBy("page_id", "block_no", "line_no").collect()]


def one(spark, html, expression):
    return spark.createDataFrame([(html,)], "html string").select(expression).first()[0]


def test_heading_blocks(spark):
    assert pairs(extract_heading_blocks(pages(spark, HANDBOOK))) == [
        ("Crafts", "r/knitting"),
        ("Crafts", "r/weaving"),
        ("Machines", "r/lathes, r/mills"),
        ("Kitchen", "r/bread"),
        ("Kitchen", "r/soup"),
        ("Kitchen", "r/knitting"),
    ]


def test_links(spark):
    assert pairs(extract_links(pages(spark, CATALOGUE))) == [
        ("Video Games", "/r/dice"),
        ("Video Games", "/r/cards"),
        ("Video Games", "/r/dice"),
    ]


def test_merge_and_cleaning(spark):
    lists = [extract_heading_blocks(pages(spark, HANDBOOK)), extract_links(pages(spark, CATALOGUE))]
    merged = merge_topic_lists(*lists)
    assert rows(merged.where("subreddit like '%kn%' or subreddit like '%di%'")) == [
        ("Crafts,Kitchen", "r/knitting"),
        ("Video Games", "/r/dice"),
    ]
    cleaned = clean_topic_lists(merged, [("Kitchen", "Food"), ("Crafts,F", "Making,F")])
    assert rows(cleaned) == sorted(
        [
            ("Making,Food", "knitting"),
            ("Crafts", "weaving"),
            ("Machines", "lathes, mills"),
            ("Food", "bread"),
            ("Food", "soup"),
            ("Video Games", "dice"),
            ("Video Games", "cards"),
        ]
    )


def test_heading_blocks_of_well_formed_pages(spark):
    html = """
    <h2 id="x"><strong>Pets &amp; more</strong></h2>

    <p>/r/cats<br>
/r/dogs</p>
    <h3>no label</h3><p>/r/none</p>
    <h3><em>Lists</em></h3>
    <ul><li>/r/one</li><li>/r/two<ul><li>/r/three</li></ul></li>
<li>/r/four</li></ul>
    <h3><strong>Empty</strong></h3>
    <h2><strong>Plain</strong></h2> only text
    """
    assert pairs(extract_heading_blocks(pages(spark, html))) == [
        ("Pets & more", "/r/cats"),
        ("Pets & more", "/r/dogs"),
        ("Lists", "/r/one/r/two/r/three"),
        ("Lists", "/r/four"),
    ]


def test_label_prefers_strong_to_em(spark):
    html = "<h2><em>E</em><strong>S</strong></h2><p>x</p>"
    assert pairs(extract_heading_blocks(pages(spark, html))) == [("S", "x")]


def test_block_numbers_follow_the_page(spark):
    html = "<h2><em>B</em></h2><p>x</p><h2><em>A</em></h2><p>y</p>"
    assert pairs(extract_heading_blocks(pages(spark, html, html))) == [("B", "x"), ("A", "y")] * 2


def first_of(spark, html, tags, attributes=""):
    df = spark.createDataFrame([(html,)], "html string")
    return df.transform(add_first_element, "html", "found", tags, attributes).first()["found"]


def test_first_element_keeps_nested_ones(spark):
    html = "<div>a</div><div class='b'>1<div>2</div>3<divider>4</div>5"
    assert first_of(spark, html, ["div"], "class") == "1<div>2</div>3<divider>4"
    assert first_of(spark, html, ["ul"]) is None
    assert first_of(spark, "<P>x<p>y</p>", ["p"]) == "x<p>y</p>"
    assert first_of(spark, "<p>a<UL>b<ul>c</UL>d</ul>e", ["ul", "ol"]) == "b<ul>c</UL>d"
    assert first_of(spark, None, ["p"]) is None


def test_links_need_container_item_and_attribute(spark):
    html = """
    <p><a rel="nofollow">/r/outside</a></p>
    <div class="md wiki"><div>inner</div>
      <p><a rel="nofollow">/r/in</a> <a>/r/follow</a> <a rel="nofollow">r/short</a></p>
      <a rel="nofollow">/r/no_item</a>
      <p><a rel='nofollow noopener' href="x"><b>/r/bold</b></a></p>
    </div><p><a rel="nofollow">/r/after</a></p>
    """
    assert pairs(extract_links(pages(spark, html))) == [("Video Games", "/r/in"), ("Video Games", "/r/bold")]


def test_page_without_container(spark):
    df = pages(spark, "<p>nothing</p>", CATALOGUE)
    assert extract_links(df).count() == 3
    with pytest.raises(PySparkException, match="no link container"):
        extract_links(df, strict=True).collect()


def test_text_and_lines(spark):
    html = "a<!-- <b> -->&lt;x&gt; &amp;lt;<br>"
    assert one(spark, html, plain_text(F.col("html"))) == "a<x> &lt;"
    for text in ["", "\n", "a", "a\n", "a\r\nb", "\na\n\nb\n", "a\x0cb\x85c d ", "a\x1cb\x1dc\x1ed\x0be"]:
        assert (one(spark, text, text_lines(F.col("html"))) or []) == text.splitlines()


def test_merge_keeps_first_seen_order_and_drops_repeats(spark):
    schema = "page_id long, block_no int, line_no int, topics string, subreddit string"
    first = spark.createDataFrame(
        [(0, 2, 0, "B", "x"), (0, 1, 0, "Z", "x"), (1, 0, 0, "B", "x"), (0, 3, 0, "A", None), (0, 4, 0, "b", "X")],
        schema,
    )
    second = spark.createDataFrame([(0, 0, 0, "A", "x"), (0, 0, 1, "Z", "x")], schema)
    assert rows(merge_topic_lists(first, second)) == [("Z,B,A", "x"), ("b", "X")]
    assert rows(merge_topic_lists(second, first, delimiter=":")) == [("A:Z:B", "x"), ("b", "X")]


@pytest.mark.parametrize(
    "raw, name, anchored",
    [
        ("/r/chess", "chess", "chess"),
        ("r/gaming", "gaming", "gaming"),
        ("/r/foobar/", "fooba", "foobar"),
        ("a/b", "ab", "a/b"),
    ],
)
def test_community_names(spark, raw, name, anchored):
    assert one(spark, raw, community_name(F.col("html"))) == name
    assert one(spark, raw, community_name(F.col("html"), anchored=True)) == anchored


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("TV:Netflix Related", "TV:Netflix Related"),
        ("Gaming:Netflix Related", "Gaming"),
        ("Self-Improvement:Programming", "Programming:Self-Improvement"),
        ("Self-Improvement:Books", "Books"),
        ('"Quoted"', "Quoted"),
        ("Facebook:Dogs:Wallpapers", "Cringe"),
    ],
)
def test_topic_rules_apply_in_order(spark, raw, clean):
    assert one(spark, raw, replace_in_order(F.col("html"), TOPIC_RULES)) == clean


def test_topic_map_round_trip(spark, tmp_path):
    built = build_topic_map(pages(spark, HANDBOOK), pages(spark, CATALOGUE))
    awkward = spark.createDataFrame([(' a, "b",\nc ', "odd")], "topics string, subreddit string")
    expected = built.unionByName(awkward)
    path = str(tmp_path / "map")
    write_topic_map(expected, path)
    assert rows(read_topic_map(spark, path)) == rows(expected, "subreddit", "topics")


def test_one_frame_of_pages_is_read_once(spark, tmp_path):
    path = str(tmp_path / "pages")
    pages(spark, HANDBOOK, CATALOGUE, "", HANDBOOK + CATALOGUE).write.parquet(path)
    one, other = spark.read.parquet(path), spark.read.parquet(path)
    built = build_topic_map(one, one)
    assert rows(built) == rows(build_topic_map(one, other))
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.index("Initial Plan")].count("FileScan") == 1


def test_topic_map_with_an_index_column(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text(',topics,subreddit\n0,"Video Games,Fun",gaming\n')
    assert rows(read_topic_map(spark, str(path))) == [("gaming", "Video Games,Fun")]
