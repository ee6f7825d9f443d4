"""ANSI SQL for DuckDB that states each registered query a second time."""

from __future__ import annotations

from termflow.functions.html import ENTITIES
from termflow.functions.names import NAME_SUBSTRINGS, TOPIC_RULES
from termflow.functions.text import STOP_WORDS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replaced(expression: str, rules) -> str:
    for old, new in rules:
        expression = f"replace({expression}, {quoted(old)}, {quoted(new)})"
    return expression


STOP = ", ".join(quoted(word) for word in STOP_WORDS)
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# Each entry is (name, body) of a common table expression.
COMMENTS = (
    "comments",
    """
    SELECT 'u' || (doc_id % 50) AS author, text AS body,
           CAST(1704067200 + (doc_id * 7919) % 2592000 AS VARCHAR) AS created_utc,
           source AS subreddit
    FROM documents""",
)
TOPIC_MAP = (
    "topic_map",
    r"""
    SELECT DISTINCT upper(source) AS subreddit,
           'Topic' || (CAST(regexp_extract(source, '\d+') AS INTEGER) % 4)
           || ', group' || (CAST(regexp_extract(source, '\d+') AS INTEGER) % 3)
           AS topics
    FROM documents""",
)
CHAT_COMMENTS = (
    "comments",
    """
    SELECT 'c' || conv_id AS author, text AS body,
           CAST(1704067200 + (conv_id * 100003 + turn * 60) % 2592000 AS VARCHAR)
           AS created_utc,
           role AS subreddit
    FROM conversations""",
)
CHAT_MAP = (
    "topic_map",
    """
    SELECT DISTINCT role AS subreddit, role || ',Chat, chat' AS topics
    FROM conversations""",
)

TOKEN_STEPS = (
    (
        "keyed",
        """
    SELECT author || '_' || created_utc AS id, body, subreddit,
           CAST(make_timestamp(CAST(created_utc AS BIGINT) * 1000000) AS DATE)
           AS day
    FROM comments""",
    ),
    (
        "ranged",
        """
    SELECT id, body, subreddit, CAST(day AS VARCHAR) AS date FROM keyed
    WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'""",
    ),
    (
        "with_topics",
        """
    SELECT id, body, date, subreddit, topics
    FROM ranged JOIN (SELECT lower(subreddit) AS subreddit, topics FROM topic_map)
    USING (subreddit)""",
    ),
    (
        "tokenized",
        rf"""
    SELECT id, topics, date,
           CASE WHEN rtrim(body, {BLANKS}) = '' AND body <> '' THEN []
           ELSE regexp_split_to_array(rtrim(lower(body), {BLANKS}),
                                      '[ \t\n\x0B\f\r]') END AS words_token
    FROM with_topics WHERE body IS NOT NULL""",
    ),
    (
        "unstopped",
        f"""
    SELECT id, topics, date,
           list_filter(words_token, lambda w: w NOT IN ({STOP})) AS words_no_stops
    FROM tokenized""",
    ),
    (
        "words",
        r"""
    SELECT DISTINCT id, topics, date, word FROM (
        SELECT id, topics, date,
               unnest(regexp_split_to_array(token, '[\W_]+')) AS word
        FROM (SELECT id, topics, date, unnest(words_no_stops) AS token
              FROM unstopped))
    WHERE regexp_matches(word, '[a-zA-Z]')""",
    ),
    (
        "topic_words",
        """
    SELECT id, trim(lower(part)) AS topic, word, date
    FROM (SELECT id, word, date, unnest(string_split(topics, ',')) AS part
          FROM words)""",
    ),
    ("tokens", "SELECT DISTINCT id, topic, word, date FROM topic_words"),
)

COUNT_STEPS = (
    (
        "frequency",
        """
    SELECT date, word, count(word) AS daily_word_frequency
    FROM (SELECT DISTINCT id, word, date FROM tokens) GROUP BY date, word""",
    ),
    (
        "total",
        """
    SELECT date, CAST(sum(daily_word_frequency) AS BIGINT)
           AS total_daily_word_count
    FROM frequency GROUP BY date""",
    ),
    (
        "daily",
        """
    SELECT topic, word, date, daily_word_frequency, total_daily_word_count
    FROM tokens JOIN frequency USING (date, word) JOIN total USING (date)""",
    ),
    (
        "in_topic",
        """
    SELECT topic, word, date, daily_word_frequency, total_daily_word_count,
           count(word) AS daily_word_frequency_in_topic
    FROM daily
    GROUP BY topic, word, date, daily_word_frequency, total_daily_word_count""",
    ),
    (
        "counts",
        """
    SELECT * FROM in_topic JOIN
        (SELECT date, topic, CAST(sum(daily_word_frequency_in_topic) AS BIGINT)
                AS topic_daily_word_count
         FROM in_topic GROUP BY date, topic)
    USING (date, topic)""",
    ),
)

RATE_STEPS = (
    (
        "shares",
        """
    SELECT *, daily_word_frequency / total_daily_word_count AS rate,
           daily_word_frequency_in_topic / topic_daily_word_count
           AS rate_in_topic
    FROM counts""",
    ),
    ("rates", "SELECT *, rate_in_topic / rate AS topic_specificity FROM shares"),
    (
        "averages",
        """
    SELECT *, avg(rate_in_topic) OVER (
               PARTITION BY topic, word ORDER BY date
               ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
           AS five_day_average_of_rate_in_topic
    FROM rates""",
    ),
    (
        "changes",
        """
    SELECT *, five_day_average_of_rate_in_topic
           - lag(five_day_average_of_rate_in_topic) OVER (
               PARTITION BY topic, word ORDER BY date)
           AS change_in_average_of_rate_in_topic
    FROM averages""",
    ),
    (
        "statistics",
        "SELECT *, topic || '_' || date || '_' || word AS id FROM changes",
    ),
)

DOCUMENT_STEPS = (COMMENTS, TOPIC_MAP, *TOKEN_STEPS, *COUNT_STEPS, *RATE_STEPS)
CHAT_STEPS = (
    CHAT_COMMENTS,
    CHAT_MAP,
    *TOKEN_STEPS,
    *COUNT_STEPS,
    *RATE_STEPS,
)

STATISTICS_COLUMNS = """id, topic, word, date, daily_word_frequency_in_topic,
    daily_word_frequency, total_daily_word_count, topic_daily_word_count, rate,
    rate_in_topic, topic_specificity, five_day_average_of_rate_in_topic,
    change_in_average_of_rate_in_topic"""


def text_of(fragment: str) -> str:
    bare = f"regexp_replace({fragment}, '(?s)<!--.*?-->|<[^>]*>', '', 'g')"
    return replaced(bare, ENTITIES)


LINE = r"(?:\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}])"

PAGE_STEPS = (
    (
        "sections",
        """
    SELECT page_id, unnest(string_split(html, '<h1')) AS section,
           generate_subscripts(string_split(html, '<h1'), 1) - 1 AS block_no
    FROM pages""",
    ),
    (
        "headed",
        r"""
    SELECT page_id, block_no,
           regexp_extract(section, '(?s)^[^>]*>(.*?)</h1>', 1) AS label,
           string_split(regexp_extract(section, '(?s)</h1>(.*)', 1), '<') AS part
    FROM sections WHERE block_no > 0""",
    ),
    (
        "parts",
        """
    SELECT *, CASE WHEN part LIKE 'p>%' OR part LIKE 'p %' THEN 1
                   WHEN part LIKE '/p>%' THEN -1 ELSE 0 END AS step
    FROM (SELECT page_id, block_no, label, unnest(part) AS part,
                 generate_subscripts(part, 1) AS place FROM headed)""",
    ),
    (
        "opened",
        """
    SELECT *, sum(step) OVER (PARTITION BY page_id, block_no ORDER BY place)
              AS depth
    FROM parts WHERE place >=
        (SELECT min(place) FROM parts o WHERE o.step = 1
           AND o.page_id = parts.page_id AND o.block_no = parts.block_no)""",
    ),
    (
        "block_parts",
        """
    SELECT *, min(depth) OVER (PARTITION BY page_id, block_no ORDER BY place)
              AS least
    FROM opened""",
    ),
    (
        "blocks",
        f"""
    SELECT page_id, block_no, {text_of("label")} AS topics,
           {text_of("'<' || string_agg(part, '<' ORDER BY place)")} AS block
    FROM block_parts WHERE least > 0 GROUP BY page_id, block_no, label""",
    ),
    (
        "lines",
        rf"""
    SELECT page_id, block_no, topics,
           regexp_split_to_array(regexp_replace(block, '{LINE}\z', ''),
                                 '{LINE}') AS line
    FROM blocks WHERE block <> ''""",
    ),
    (
        "heading_blocks",
        """
    SELECT page_id, block_no, generate_subscripts(line, 1) - 1 AS line_no,
           topics, unnest(line) AS subreddit
    FROM lines""",
    ),
    (
        "items",
        """
    SELECT page_id, unnest(item) AS item,
           generate_subscripts(item, 1) - 1 AS block_no
    FROM (SELECT page_id, regexp_extract_all(
                 regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1),
                 '(?s)<li[^>]*>(.*?)</li>', 1) AS item
          FROM pages)""",
    ),
    (
        "links",
        f"""
    SELECT page_id, block_no, line_no, 'Menu' AS topics,
           {text_of("anchor")} AS subreddit
    FROM (SELECT page_id, block_no, unnest(anchor) AS anchor,
                 generate_subscripts(anchor, 1) - 1 AS line_no
          FROM (SELECT page_id, block_no, regexp_extract_all(
                       item, '(?s)<a [^>]*href[^>]*>(.*?)</a>', 1) AS anchor
                FROM items))""",
    ),
    (
        "numbered",
        """
    SELECT topics, subreddit, row_number() OVER (
               ORDER BY list_no, page_id, block_no, line_no) AS seen
    FROM (SELECT 0 AS list_no, * FROM heading_blocks
          UNION ALL SELECT 1 AS list_no, * FROM links)""",
    ),
    (
        "merged",
        """
    SELECT string_agg(topics, ',' ORDER BY seen) AS topics, subreddit
    FROM (SELECT topics, subreddit, min(seen) AS seen FROM numbered
          GROUP BY topics, subreddit)
    GROUP BY subreddit""",
    ),
)

KEYS = """
    SELECT 'bkt/id_group=' || (o_custkey % 10) || '/part-' || o_orderkey AS key
    FROM orders"""

RAW_NAMES = """
    SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'r/' || source
                   WHEN 1 THEN '/r/' || source
                   ELSE '/r/' || source || '/' END AS raw
    FROM documents"""

# A rule's own text between two columns, so that every rule applies.
RULE_TEXTS = "[" + ", ".join(quoted(old) for old, _ in TOPIC_RULES) + "]"
RAW_TOPICS = f"""
    SELECT doc_id, upper(lang[1]) || lower(lang[2:])
           || coalesce({RULE_TEXTS}[doc_id % {len(TOPIC_RULES) + 1} + 1], '')
           || source AS raw
    FROM documents"""


def after(steps, last: str, select: str) -> str:
    """``select`` on top of the steps up to the one named ``last``."""
    names = [name for name, _ in steps]
    used = steps[: names.index(last) + 1]
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in used)
    return f"WITH {ctes}\n{select}"


def percentile(p: int) -> str:
    # p / 100 as the double that Python and Spark get.
    return (
        f"list_extract(s, CAST(floor(CAST({p / 100.0!r} AS DOUBLE) * len(s))"
        f" AS BIGINT) + 1) AS p{p}"
    )


def oracle_sql() -> dict[str, str]:
    def doc(last: str, select: str) -> str:
        return after(DOCUMENT_STEPS, last, select)

    statistics = doc(
        "statistics", f"SELECT {STATISTICS_COLUMNS} FROM statistics"
    )
    chat_statistics = after(
        CHAT_STEPS, "statistics", f"SELECT {STATISTICS_COLUMNS} FROM statistics"
    )
    pages = lambda last, select: after(PAGE_STEPS, last, select)
    comments = doc("comments", "SELECT * FROM comments")
    bounded = lambda sql: sql.replace("01-01'", "01-03'").replace(
        "01-30'", "01-28'"
    )
    empty_topic = bounded(statistics).replace(
        "% 3)\n           AS topics", "% 3) || ','\n           AS topics"
    )
    key_value = "string_split(string_split(key, '/')[-2], '=')[2]"
    return {
        "word_statistics": statistics,
        "comment_statistics": bounded(statistics),
        "topic_terms_job": bounded(statistics),
        "incremental_equals_full": empty_topic,
        "partitioned_roundtrip": chat_statistics,
        "comment_tokens": bounded(
            doc("tokens", "SELECT id, topic, word, date FROM tokens")
        ),
        "chat_tokens": after(
            CHAT_STEPS, "tokens", "SELECT id, topic, word, date FROM tokens"
        ),
        "comment_id": doc("keyed", "SELECT id, subreddit FROM keyed"),
        "unix_to_date": doc(
            "keyed", "SELECT id, CAST(day AS VARCHAR) AS date FROM keyed"
        ),
        "date_range_filter": bounded(
            doc("ranged", "SELECT id, date FROM ranged")
        ),
        "topic_join": doc(
            "with_topics", "SELECT id, date, subreddit, topics FROM with_topics"
        ),
        "tokenize": doc(
            "tokenized",
            "SELECT id, topics, date, len(words_token) AS n_tokens,"
            " array_to_string(words_token, '|') AS tokens FROM tokenized",
        ),
        "remove_stop_words": doc(
            "unstopped",
            "SELECT id, topics, date, len(words_no_stops) AS n_tokens,"
            " array_to_string(words_no_stops, '|') AS tokens FROM unstopped",
        ),
        "split_words": doc(
            "words", "SELECT id, topics, word, date FROM words"
        ),
        "add_word": after(
            CHAT_STEPS, "words", "SELECT id, topics, word, date FROM words"
        ),
        "explode_topics": after(
            CHAT_STEPS,
            "topic_words",
            "SELECT id, topic, word, date FROM topic_words",
        ),
        "enforce_schema": """
            SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id,
                   o_orderstatus AS topic, o_orderpriority AS word,
                   CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date
            FROM orders""",
        "sum_column": """
            SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, total
            FROM lineitem JOIN
                (SELECT l_returnflag, l_linestatus,
                        CAST(sum(l_linenumber) AS BIGINT) AS total
                 FROM lineitem GROUP BY l_returnflag, l_linestatus)
            USING (l_returnflag, l_linestatus)""",
        "daily_word_frequency": doc("daily", "SELECT * FROM daily"),
        "daily_word_frequency_in_topic": doc(
            "in_topic", "SELECT * FROM in_topic"
        ),
        "topic_daily_word_count": doc("counts", "SELECT * FROM counts"),
        "word_count_columns": doc("counts", "SELECT * FROM counts"),
        "rate_and_specificity": doc("rates", "SELECT * FROM rates"),
        "five_row_average": doc("averages", "SELECT * FROM averages"),
        "change_in_average": doc("changes", "SELECT * FROM changes"),
        "stats_id": doc("statistics", "SELECT id FROM statistics"),
        "five_calendar_day_average": doc(
            "rates",
            """
            SELECT topic, word, date, rate_in_topic,
                   avg(rate_in_topic) OVER (
                       PARTITION BY topic, word ORDER BY CAST(date AS DATE)
                       RANGE BETWEEN INTERVAL 4 DAYS PRECEDING AND CURRENT ROW)
                   AS five_calendar_day_average_of_rate_in_topic
            FROM rates""",
        ),
        "trending_terms": doc(
            "changes",
            """
            SELECT topic, date, word, topic_specificity,
                   change_in_average_of_rate_in_topic, place
            FROM (SELECT *, row_number() OVER (
                             PARTITION BY topic, date
                             ORDER BY change_in_average_of_rate_in_topic DESC,
                                      word) AS place
                  FROM changes
                  WHERE topic_specificity >= 1.2
                    AND change_in_average_of_rate_in_topic > 0)
            WHERE place <= 10""",
        ),
        "clean_names": f"""
            SELECT doc_id,
                   {replaced("raw", ((s, "") for s in NAME_SUBSTRINGS))}
                   AS name,
                   regexp_replace(raw, '^/?r/|/$', '', 'g') AS anchored_name
            FROM ({RAW_NAMES})""",
        "clean_topics": f"""
            SELECT doc_id, {replaced("raw", TOPIC_RULES)} AS topics
            FROM ({RAW_TOPICS})""",
        "heading_blocks": pages(
            "heading_blocks", "SELECT * FROM heading_blocks"
        ),
        "extract_links": pages("links", "SELECT * FROM links"),
        "merge_topic_lists": pages("merged", "SELECT * FROM merged"),
        "topic_map": pages(
            "merged",
            f"""
            SELECT {replaced("topics", TOPIC_RULES)} AS topics,
                   {replaced("subreddit", ((s, "") for s in NAME_SUBSTRINGS))}
                   AS subreddit
            FROM merged""",
        ),
        "partition_value": f"SELECT key, {key_value} AS id_group FROM ({KEYS})",
        "latest_key_per_group": f"""
            SELECT {key_value} AS id_group, max(key) AS key FROM ({KEYS})
            GROUP BY ALL""",
        "freshness_counts": """
            SELECT count(*) FILTER (ts < TIMESTAMP '2024-01-15 00:00:00')
                   AS num_old_keys,
                   count(*) FILTER (ts >= TIMESTAMP '2024-01-15 00:00:00')
                   AS num_new_keys
            FROM events""",
        "size_percentiles": f"""
            SELECT s[1] AS size_min, {", ".join(map(percentile, (10, 25, 50, 75, 90)))},
                   s[-1] AS size_max
            FROM (SELECT list_sort(list(CAST(round(l_extendedprice * 100)
                                             AS BIGINT))) AS s
                  FROM lineitem)""",
        "catalog_table": chat_statistics,
        "late_days": chat_statistics,
        "new_files": chat_statistics,
        "split_json_comments": doc(
            "comments",
            """
            SELECT CASE WHEN bad THEN NULL ELSE author END AS author,
                   CASE WHEN bad THEN NULL ELSE body END AS body,
                   CASE WHEN bad THEN NULL ELSE created_utc END AS created_utc,
                   CASE WHEN bad THEN NULL ELSE subreddit END AS subreddit,
                   CASE WHEN bad THEN '{no json ' || created_utc END AS line,
                   count(*) FILTER (NOT bad) OVER () AS n_comments,
                   count(*) FILTER (bad) OVER () AS n_corrupt
            FROM (SELECT *, regexp_matches(author, '[05]$') AS bad
                  FROM comments)""",
        ),
        "store_listing": """
            SELECT CAST(o_custkey % 10 AS VARCHAR) AS id_group, 1 AS files,
                   true AS all_sized
            FROM orders GROUP BY ALL""",
        "token_store": after(
            CHAT_STEPS, "tokens", "SELECT id, topic, word, date FROM tokens"
        ),
        "optional_table": """
            SELECT n_nationkey, n_name, true AS was_absent FROM nation""",
        "audit_record": f"""
            SELECT min(date) AS min_date, max(date) AS max_date,
                   count(*) AS rows
            FROM ({chat_statistics}) WHERE date <= '2024-01-10'
            UNION ALL
            SELECT min(date), max(date), count(*)
            FROM ({chat_statistics}) WHERE date >= '2024-01-10'""",
        "file_audit": """
            SELECT count(*) FILTER (o_orderdate < TIMESTAMP '1995-01-01')
                   AS num_old_keys,
                   count(*) FILTER (o_orderdate >= TIMESTAMP '1995-01-01')
                   AS num_new_keys,
                   CAST(min(round(o_totalprice * 100)) AS BIGINT) AS size_min,
                   CAST(max(round(o_totalprice * 100)) AS BIGINT) AS size_max,
                   count(DISTINCT o_custkey % 10) AS groups
            FROM orders""",
        "read_parquet_source": "SELECT * FROM conversations",
        "json_comments": comments,
        "topic_map_csv": pages(
            "merged", "SELECT subreddit, topics FROM merged"
        ),
    }
