"""DuckDB SQL that states some of the queries a second time."""

from __future__ import annotations

LINE_RUNS = r"""
WITH split AS (
    SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
placed AS (
    SELECT doc_id, unnest(lines) AS line,
           generate_subscripts(lines, 1) AS line_no FROM split),
sequence AS (
    SELECT doc_id, line, line_no,
           row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS seq
    FROM placed WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
gone AS (
    SELECT doc_id, line_no FROM (
        SELECT doc_id, line_no,
               row_number() OVER (PARTITION BY line ORDER BY doc_id, seq) AS nth
        FROM sequence)
    WHERE nth > 1),
kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text
    FROM placed ANTI JOIN gone USING (doc_id, line_no) GROUP BY doc_id)
SELECT doc_id, coalesce(len(lines), 0) AS n_lines,
       coalesce(n, 0) AS n_removed,
       CASE WHEN lines IS NOT NULL THEN sha256(coalesce(text, '')) END
       AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
USING (doc_id)
"""

REPEATED_PHRASES = r"""
WITH split AS (
    SELECT doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
started AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM split),
windows AS (
    SELECT doc_id, start,
           array_to_string(words[start : start + 19], ' ') AS phrase
    FROM started),
later AS (
    SELECT doc_id, start FROM (
        SELECT doc_id, start, row_number() OVER (
                   PARTITION BY phrase ORDER BY doc_id, start) AS nth
        FROM windows)
    WHERE nth > 1),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place FROM later),
placed AS (
    SELECT doc_id, unnest(words) AS word,
           generate_subscripts(words, 1) AS place FROM split),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text
    FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
USING (doc_id)
"""

NEAR_VECTORS = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
    SELECT * FROM vectors
    WHERE label IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL
              OR NOT isfinite(x))) = 0
      AND list_dot_product(v, v) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached(vec_id, other) AS (
    SELECT vec_id, vec_id FROM vectors
    UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT vec_id, coalesce(n, 0) AS n_links, least_id AS component_id,
       vec_id = least_id AS kept
FROM (SELECT vec_id, min(other) AS least_id FROM reached GROUP BY vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
USING (vec_id)
"""

EXACT_COPIES = r"""
WITH plain AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents),
ranked AS (
    SELECT doc_id, norm,
           row_number() OVER best AS nth,
           first_value(doc_id) OVER best AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size
    FROM plain
    WINDOW best AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id))
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(norm) AS text_sha256
FROM ranked
"""

#: A round assigns parts (r) and takes floors of means; floors go down.
_ASSIGNED = """
assigned_{r} AS (
    SELECT row_no, part, entry, square FROM (
        SELECT p.row_no, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS square,
               row_number() OVER (PARTITION BY p.row_no, p.part ORDER BY
                   sum((p.x - b.x) * (p.x - b.x)), b.entry) AS nth
        FROM placed p JOIN book_{r} b USING (part, place)
        GROUP BY p.row_no, p.part, b.entry) WHERE nth = 1)"""
_BOOK = """
book_{next} AS (
    SELECT part, entry, place,
           coalesce((total - ((total % n) + n) % n) // n, x) AS x
    FROM book_{r} LEFT JOIN (
        SELECT part, entry, place, CAST(sum(x) AS BIGINT) AS total, count(*) AS n
        FROM assigned_{r} JOIN placed USING (row_no, part)
        GROUP BY part, entry, place) USING (part, entry, place))"""

GRID_CODES = (
    """
WITH fitting AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding,
        lambda c: c IS NULL OR NOT isfinite(c))) = 0),
numbered AS (
    SELECT *, row_number() OVER (ORDER BY vec_id, v) AS row_no FROM fitting),
spread AS (
    SELECT row_no, generate_subscripts(v, 1) - 1 AS spot, len(v) // 16 AS wide,
           CAST(floor(256 * unnest(v)) AS BIGINT) AS x
    FROM numbered),
placed AS (
    SELECT row_no, spot // wide AS part, spot % wide AS place, x FROM spread),
book_0 AS (
    SELECT part, row_no - 1 AS entry, place, x FROM placed WHERE row_no <= 64),"""
    + ",".join(
        (_ASSIGNED + "," + _BOOK).format(r=r, next=r + 1) for r in range(2)
    )
    + ","
    + _ASSIGNED.format(r=2)
    + """,
coded AS (
    SELECT row_no, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
           CAST(sum(square) AS BIGINT) AS error
    FROM assigned_2 GROUP BY row_no),
summed AS (
    SELECT label, CAST(sum(error) AS BIGINT) AS label_error
    FROM coded JOIN numbered USING (row_no) GROUP BY label)
SELECT vec_id, code, error, label_error, (
           SELECT sha256(string_agg(CAST(x AS VARCHAR), ','
                         ORDER BY part, entry, place)) FROM book_2)
       AS codebooks_sha256
FROM coded JOIN numbered USING (row_no)
JOIN summed ON numbered.label IS NOT DISTINCT FROM summed.label
"""
)

ORACLES = {
    "op2_suffix_line_runs": LINE_RUNS,
    "op5_repeated_phrase_automata": REPEATED_PHRASES,
    "op7_quantised_near_vectors": NEAR_VECTORS,
    "op11_extendible_hash_copies": EXACT_COPIES,
    "op12_memoised_grid_codes": GRID_CODES,
}
