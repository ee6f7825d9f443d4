import math
import random
import re
import time
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from termflow.llm import components as components_module
from termflow.llm import jaccard_join, repeated_phrases, set_tiles
from termflow.llm.components import components
from termflow.llm.jaccard_join import (
    central_pairs,
    first_of_each_group,
    hidden_pairs,
    jaccard_query,
    labelled_rows,
    near_documents,
    open_rows,
    rare_rows,
)
from termflow.llm.line_runs import line_runs_query, without_repeated_runs
from termflow.llm import quantised, vector_tiles
from termflow.llm.quantised import near_vectors, near_vectors_query
from termflow.llm.repeated_phrases import (
    located,
    phrase_automaton,
    repeated_phrases_query,
    spaced,
    without_repeated_phrases,
)
from termflow.llm.set_segments import band_of, bands, scheme, signatures
from termflow.llm.set_tiles import shared_counts, supers_of, tile_links
from termflow.llm.shingles import shingle_set, word_hashes
from termflow.llm.storage import SHUFFLE_CLEANUP, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def least_reachable(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in nodes}


# Lines


def plain_line_runs(rows, least_characters=0):
    """doc_id -> (lines, removed, kept text), by windows of one and two lines."""
    seen, out = set(), {}
    for doc_id, text, *_ in sorted(rows):
        if text is None:
            out[doc_id] = (0, 0, None)
            continue
        lines = text.split("\n")
        places = [k for k, line in enumerate(lines) if WORD.search(line)]
        removed = set()
        for at, k in enumerate(places):
            if lines[k] in seen and len(lines[k]) >= least_characters:
                removed.add(k)
            seen.add(lines[k])
            if at + 1 < len(places):
                pair = lines[k], lines[places[at + 1]]
                if pair in seen:
                    removed.update((k, places[at + 1]))
                seen.add(pair)
        kept = "\n".join(x for k, x in enumerate(lines) if k not in removed)
        out[doc_id] = len(lines), len(removed), kept
    return out


def test_line_runs(spark, sf_dir, clean_rows):
    want = {
        k: (n, r, kept if kept is None else sha256(kept.encode()).hexdigest())
        for k, (n, r, kept) in plain_line_runs(clean_rows).items()
    }
    found = {
        r["doc_id"]: (r["n_lines"], r["n_removed"], r["kept_sha256"])
        for r in line_runs_query(spark, sf_dir).collect()
    }
    assert found == want
    assert sum(r for _, r, _ in want.values()) > 5


def test_longest_line_run(spark):
    lines = [f"line number {k} of the text" for k in range(40)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["new", *lines[3:14], "other"]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = without_repeated_runs(docs, "info").orderBy("doc_id").collect()
    assert [r["info"]["longest_run"] for r in found] == [0, 11]
    assert found[1]["text"] == "new\nother"


def test_single_lines_and_a_guard_for_short_ones(spark):
    rows = [
        (1, "a\nfirst text\nAll rights reserved."),
        (2, "second text\nAll rights reserved.\na"),
        (3, "a"),
        (4, "x\nx\nfirst text\nx"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for least in (0, 12):
        found = without_repeated_runs(docs, least_characters=least).collect()
        want = {k: kept for k, (_, _, kept) in plain_line_runs(rows, least).items()}
        if least:
            # A run of two lines counts however short they are: here there is none.
            assert want[2] == "second text\na" and want[3] == "a"
        else:
            assert want[2] == "second text" and want[3] == "" and want[4] == "x"
        assert {r["doc_id"]: r["text"] for r in found} == want


def test_line_runs_keep_columns(odd_documents, no_documents, clashing, odd_rows):
    docs = clashing(odd_documents)
    found = without_repeated_runs(docs)
    assert found.columns == docs.columns and found.count() == len(odd_rows)
    assert without_repeated_runs(no_documents).collect() == []


# Shingles


def shingles(text):
    words = [
        w.encode().lower() for w in WORD.findall(text or "")
    ]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def plain_components(rows):
    sets = {doc_id: shingles(text) for doc_id, text, *_ in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return {k: (len(sets[k]), c) for k, c in least_reachable(ids, links).items()}


def test_jaccard_join(spark, sf_dir, clean_rows):
    found = {
        r["doc_id"]: (r["n_shingles"], r["component_id"])
        for r in jaccard_query(spark, sf_dir).collect()
    }
    want = plain_components(clean_rows)
    assert found == want
    assert sum(k != c for k, (_, c) in want.items()) >= 3


def test_jaccard_join_of_chains_and_shared_passages(spark):
    """Copies that drift apart, around a passage that all texts share."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdef", k=4))
    passage = [word() for _ in range(30)]
    rows, doc_id = [], 0
    for size in (3, 6, 9, 20, 60, 140):
        for _ in range(4):
            text = [word() for _ in range(size)] + passage * (size > 9)
            for _ in range(5):
                rows.append((doc_id, " ".join(text)))
                doc_id += 1
                for _ in range(max(1, len(text) // 60)):
                    text[rng.randrange(len(text))] = word()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {
        r["doc_id"]: (r["near"]["n_shingles"], r["near"]["component_id"])
        for r in near_documents(docs, "near").collect()
    }
    assert found == plain_components(rows)


def test_hidden_pairs_of_a_hot_least_set_that_one_side_drops(spark):
    """Sets 100 and 101 share 14 units, 13 of them by the hot least set 1."""
    stars = [(1, 100, 14), (2, 100, 1), (1, 101, 13), (2, 101, 1)]
    stars += [(1, b, 20) for b in range(200, 220)]
    stars = spark.createDataFrame(
        [(a, b, False, n, 13) for a, b, n in stars],
        "a bigint, b bigint, in_batch boolean, n bigint, remaining bigint",
    )
    rows = rare_rows(stars)
    dropped = {r["b"]: r["dropped"] for r in rows.collect()}
    assert (dropped[100], dropped[101]) == (0, 13)
    labels = spark.createDataFrame([], "node bigint, component bigint")
    found = hidden_pairs(labelled_rows(rows, labels)).collect()
    assert (100, 101) in {(r["a"], r["b"]) for r in found}


def near_group(seed, n, words=400, changes=(20, 60)):
    """Texts made from one by changing some words: many close to the limit."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    texts = []
    for _ in range(n):
        text, start = list(base), rng.randrange(words)
        for k in range(rng.randint(*changes)):
            text[(start + k) % words] = f"x{rng.randrange(10_000)}"
        texts.append(" ".join(text))
    return texts


def test_hot_group_of_near_copies(spark, tmp_path):
    """One large group whose sets link along chains, and some small ones."""
    texts = near_group(1, 500) + near_group(2, 40, 60, (3, 8)) + near_group(3, 3, 30, (1, 2))
    rows = [(k, text) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = jaccard_query(spark, str(tmp_path)).collect()
    sets = [shingle_set(text) for text in texts]
    shared = shared_counts(sets, sets)
    size = np.array([len(x) for x in sets])
    linked = 100 * shared >= 80 * (size[:, None] + size[None, :] - shared)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(linked, 1)))]
    want = least_reachable(range(len(texts)), links)
    assert {r["doc_id"]: r["component_id"] for r in found} == want
    assert len(links) > 1000 and len(set(want.values())) > 10


def test_a_set_of_a_hot_group_has_few_rows(spark, monkeypatch):
    """300 near copies: no rows of what only their batch's least set shares, and one
    row for a set in a block, however many groups it joins."""
    labelled_counts = []

    def counted(rows, labels, side, name):
        labelled_counts.append(rows.count() if side == "b" else 0)
        return labelled(rows, labels, side, name)

    labelled = jaccard_join.labelled
    monkeypatch.setattr(jaccard_join, "labelled", counted)
    rows = [(k, text) for k, text in enumerate(near_group(6, 300, 60, (4, 12)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    stars = jaccard_join.star_table(docs.withColumn("row", F.col("doc_id")), "row", 4)
    assert stars.where("in_batch").isEmpty()
    found = near_documents(docs, "near").collect()
    assert {r["doc_id"]: r["near"]["component_id"] for r in found} == {
        k: c for k, (_, c) in plain_components(rows).items()
    }
    assert 0 < max(labelled_counts) <= 4 * 300


def test_signatures_hot_in_a_batch_are_paired_there(spark):
    texts = near_group(5, 2600, 30, (1, 3)) + near_group(3, 3, 30, (1, 2))
    rows = [(k, text) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    docs = docs.union(spark.createDataFrame([(9000, texts[7] + " z")], docs.schema))
    stars = jaccard_join.star_table(docs.withColumn("row", F.col("doc_id")), "row", 4)
    assert not stars.where("in_batch and a != b").isEmpty()
    found = near_documents(docs, "near").collect()
    sets = [shingle_set(text) for text in [*texts, texts[7] + " z"]]
    shared = shared_counts(sets, sets)
    size = np.array([len(x) for x in sets])
    linked = 100 * shared >= 80 * (size[:, None] + size[None, :] - shared)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(linked, 1)))]
    want = least_reachable(range(len(sets)), links)
    assert {min(r["doc_id"], 2603): r["near"]["component_id"] for r in found} == want


def test_supers_are_compared_at_once_where_groups_overlap(spark):
    chain = [(least, b) for least in (1, 5, 9) for b in range(least, least + 5)]
    heap = [(least, b) for least in (21, 22, 23) for b in range(21, 26)]
    rows = [(least, b, b % 2, 2, 5) for least, b in chain + heap]
    large = spark.createDataFrame(
        rows, "least bigint, b bigint, label bigint, n bigint, members bigint"
    )
    supers, blocks = supers_of(large)
    found = {r["node"]: tuple(r)[1:] for r in supers.collect()}
    assert found == {k: (1, False, 4 if k in (5, 9) else 2) for k in range(1, 14)} | {
        k: (21, True, 6) for k in range(21, 26)
    }
    assert sorted(map(tuple, blocks.collect())) == sorted(
        [(least, b, b % 2) for least, b in chain] + [(-22, b, b % 2) for b in range(21, 26)]
    )


def test_exact_copies_are_indexed_once(spark, monkeypatch):
    indexed = []

    def counted(docs, *rest):
        indexed.extend(r["doc_id"] for r in docs.select("doc_id").collect())
        return star_table(docs, *rest)

    star_table = jaccard_join.star_table
    monkeypatch.setattr(jaccard_join, "star_table", counted)
    texts = ["a b c d e f g", "A b c  d e f g", "x y", "X y", "x z", None, "", "a b c d e f g"]
    data = [(30 - k, text) for k, text in enumerate(texts)] + [(None, "x y"), (None, "x y")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    found = near_documents(docs, "near").select("doc_id", "near.*").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [
            (30, 3, 23, False), (29, 3, 23, False), (23, 3, 23, True),
            (28, 1, 27, False), (27, 1, 27, True), (26, 1, 26, True),
            (25, 0, 25, True), (24, 0, 24, True),
            (None, 1, None, True), (None, 1, None, True),
        ],
        key=str,
    )
    with_words = [x for x in indexed if x not in (24, 25, None)]
    assert len(with_words) == 3 and 26 in with_words


def test_a_set_in_many_groups_has_two_central_pairs_at_most(spark):
    rows = [
        (least, b, b, least, 100 + b if b < 10 else 1)
        for least in range(1, 9)
        for b in (least, *range(50, 70))
    ]
    schema = "least bigint, b bigint, label bigint, least_label bigint, total bigint"
    found = [tuple(r) for r in central_pairs(spark.createDataFrame(rows, schema)).collect()]
    assert {(8, b) for b in range(50, 70)} <= set(found)
    assert len(found) <= 2 * 28


def test_least_sets_get_their_label_once_for_a_group(spark):
    rows = [(1, b, b % 2) for b in range(10, 20)] + [(2, b, 0) for b in range(10, 20, 2)]
    rows = spark.createDataFrame(rows, "least bigint, b bigint, label bigint")
    labels = spark.createDataFrame([(1, 0)], "node bigint, component bigint")
    found = open_rows(rows, labels).select("least", "b", "members", "apart").collect()
    assert sorted(map(tuple, found)) == [(1, b, 10, b % 2 == 1) for b in range(10, 20)]


def test_groups_are_joined_without_an_edge_for_each_set(spark, monkeypatch):
    joined = []

    def counted(edges):
        joined.append(edges.where("a != b").distinct().count())
        return components(edges)

    monkeypatch.setattr(set_tiles, "components", counted)
    rows = [(least, b, b, 1, 200) for least in (1, 2, 3) for b in range(10, 210)]
    rows += [(5, 300, 300, 1, 200), (6, 301, 301, 1, 200)]
    schema = "least bigint, b bigint, label bigint, n bigint, members bigint"
    supers, _ = supers_of(spark.createDataFrame(rows, schema))
    found = {r["node"]: r["super"] for r in supers.collect()}
    assert found == {b: 1 for b in range(10, 210)} | {300: 5, 301: 6}
    assert joined == [2]


def test_a_round_leaves_only_edges_between_labels(spark, monkeypatch):
    edges = []

    def kept(df, name):
        df = stored(df, name)
        edges.extend([df.count()] * (name == "edges"))
        return df

    monkeypatch.setattr(components_module, "stored", kept)
    links = [(1, k) for k in range(2, 50)] + [(60 + k, 61 + k) for k in range(9)]
    labels = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {tuple(r) for r in labels.collect()} == {(k, 1) for k in range(1, 50)} | {
        (60 + k, 60) for k in range(10)
    }
    assert edges[0] == 57 and edges[1] < 9 and edges[-1] == 0


def test_shared_counts_of_sets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 6000))).astype(np.uint64) for _ in range(9)]
    found = shared_counts(sets[:4], sets[4:])
    want = [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]
    assert found.tolist() == want
    same = [sets[0]] * 3
    assert shared_counts(same, same).tolist() == [[len(sets[0])] * 3] * 3


@pytest.mark.parametrize("tile, tile_bytes", [(1000, 1 << 20), (4, 1 << 20), (1000, 2000)])
def test_tile_links_join_what_links(spark, tile, tile_bytes):
    texts = near_group(4, 30, 60, (3, 9)) + ["one two three four five six"] * 3
    sets = [shingle_set(text) for text in texts]
    held = spark.createDataFrame(
        [(k, bytearray(x.tobytes())) for k, x in enumerate(sets)], "row bigint, shingles binary"
    )
    labels = {k: k - k % 2 for k in range(30)} | {30: 30, 31: 30, 32: 32}
    blocks = [(7, k, labels[k]) for k in range(30)] + [(-2, k, labels[k]) for k in range(25, 33)]
    frame = spark.createDataFrame(blocks, "block bigint, b bigint, label bigint")
    found = [tuple(r) for r in tile_links(frame, held, tile, tile_bytes).collect()]
    shared = shared_counts(sets, sets)
    similar = [
        (a, b)
        for a in range(33)
        for b in range(a + 1, 33)
        if 100 * shared[a, b] >= 80 * (len(sets[a]) + len(sets[b]) - shared[a, b])
    ]
    assert set(found) <= set(similar)
    assert all(labels[a] != labels[b] for a, b in found)
    within = list(labels.items())
    assert least_reachable(range(33), found + within) == least_reachable(range(33), similar + within)


def test_segments_find_every_pair_in_reach():
    """Sets at the limit share a signature in a scheme both are indexed in."""
    rng = np.random.default_rng(3)
    for size in (*range(1, 40), 77, 200, 1000):
        for _ in range(6):
            a = rng.integers(0, 1 << 62, size).astype(np.uint64)
            gone = int(rng.integers(0, size // 5 + 1))
            new = int(rng.integers(0, size // 4 + 1))
            fresh = rng.integers(0, 1 << 62, new).astype(np.uint64)
            b = np.concatenate([a[gone:], fresh])
            common = len(a) - gone
            if 100 * common < 80 * (len(a) + new):
                continue
            met = [
                np.intersect1d(signatures(a, k)[0], signatures(b, k)[0])
                for k in set(bands(len(a))) & set(bands(len(b)))
            ]
            assert any(len(m) for m in met), (size, gone, new)


def test_sets_at_the_limit_share_more_units_than_either_has_left():
    rng = np.random.default_rng(11)
    lost = []
    for size in range(6, 61):
        gone, new = max(
            (g, n)
            for g in range(size // 5 + 1)
            for n in range(size // 4 + 1)
            if 100 * (size - g) >= 80 * (size + n)
        )
        for _ in range(400):
            pool = rng.integers(0, 1 << 62, size + new).astype(np.uint64)
            a, b = pool[:size], pool[gone:]
            band = band_of(min(len(a), len(b)))
            assert band in bands(len(a)) and band in bands(len(b))
            (x, units, left), (y, _, other) = signatures(a, band), signatures(b, band)
            if units[np.isin(x, y)].sum() <= max(left, other):
                lost.append((size, gone, new))
    assert not lost


def test_schemes_cover_sizes_and_tolerate_enough():
    high = 0
    for band in range(25):
        plan = scheme(band)
        assert plan.low == high + 1
        high = plan.high
        differences = (high + high * 5 // 4) // 9
        assert plan.segments + plan.neighbourhoods >= differences + 1 + plan.slack


def test_words_are_hashed_alike_wherever_they_stand():
    hashes = word_hashes("ab cd\tab \n é ab".encode())
    assert len(hashes) == 5 and hashes[0] == hashes[2] == hashes[4]
    assert len(set(hashes.tolist())) == 3
    assert len(shingle_set("A b c d e")) == len(shingle_set("x")) == 1
    assert (shingle_set("A b c d e") == shingle_set("a B c d e")).all()
    assert len(shingle_set(None)) == len(shingle_set(" \n")) == 0


def test_first_of_each_group_keeps_rows(odd_documents, no_documents, clashing):
    docs = clashing(odd_documents)
    found = first_of_each_group(docs)
    assert found.columns == docs.columns
    ids = [r["doc_id"] for r in found.collect()]
    # Rows 0 and 12 to 14 copy rows 0 to 2; a NULL doc_id links with nothing.
    assert ids.count(0) == 1 and ids.count(None) == 1
    assert not {12, 13, 14, 15} & set(ids)
    assert first_of_each_group(no_documents).collect() == []


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(k, k + 1) for k in range(400, 460)]
    links += [(500, k) for k in range(501, 600)]
    edges = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    nodes = {x for pair in links if pair[0] != pair[1] for x in pair}
    want = least_reachable({x for pair in links for x in pair}, links)
    assert found == {x: want[x] for x in nodes}


# Passages


def plain_phrases(rows):
    seen, out = set(), {}
    for doc_id, text, *_ in sorted(rows):
        words = WORD.findall(text or "")
        removed = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                removed[k : k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, r in zip(words, removed) if not r)
        out[doc_id] = len(words), sum(removed), sha256(kept.encode()).hexdigest()
    return out


def test_repeated_phrases(spark, sf_dir, clean_rows):
    found = {
        r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
        for r in repeated_phrases_query(spark, sf_dir).collect()
    }
    want = plain_phrases(clean_rows)
    assert found == want
    assert sum(r > 0 for _, r, _ in want.values()) >= 8


def test_repeated_phrases_in_many_blocks(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(50)]
    passage = [rng.choice(words) for _ in range(45)]
    rows = []
    for doc_id in range(900):
        text = [rng.choice(words) for _ in range(rng.randrange(60))]
        if doc_id % 3 == 0:
            start = rng.randrange(20)
            text[5:5] = passage[start : start + rng.randrange(18, 26)]
        rows.append((doc_id, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = {
        r["doc_id"]: (r["info"]["n_words"], r["info"]["n_removed"], r["info"]["kept_sha256"])
        for r in without_repeated_phrases(docs, "info").collect()
    }
    assert found == plain_phrases(rows)


def test_the_automaton_finds_what_the_places_do_not_name():
    words = [f"w{k}" for k in range(80)]
    texts = [
        spaced(" ".join(x).encode())
        for x in (words[:30], ["new", *words[5:33]], words[50:], words[:3])
    ]
    none = np.zeros((0, 2), np.int64)
    empty = phrase_automaton(texts, none)
    assert all(len(located(text, empty)) == 0 for text in texts)
    # One place: the tenth word of the first text. The second text holds it too.
    automaton = phrase_automaton(texts, np.array([[10, 0]]))
    found = [located(text, automaton).tolist() for text in texts]
    assert found == [list(range(0, 11)), list(range(0, 7)), [], []]


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    files = disk.diskBlockManager().getAllFiles()
    names = (files.apply(k).getName() for k in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("write", ["stored", "in_blocks"])
def test_scratch_tables_leave_no_shuffle_files(spark, odd_documents, write):
    docs = odd_documents.repartition(4, "doc_id")
    before = shuffle_files(spark)
    if write == "stored":
        table = stored(docs, "documents")
    else:
        table, _ = repeated_phrases.in_blocks(docs, "row_number", "block")
    for _ in range(40):  # they are deleted in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.05)
    assert not left
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    assert table.count() == docs.count() == odd_documents.count()


def test_repeated_phrases_with_few_characters_in_a_task(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(90)]
    hot = " ".join(rng.choice(words) for _ in range(40))
    rows = [
        (k, " ".join(rng.choice(words) for _ in range(30)) + (" " + hot) * (k % 3 == 0))
        for k in range(300)
    ] + [(300, " ".join(rng.choice(words) for _ in range(20_000)) + " " + hot)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(repeated_phrases, "IN_TASK", 10_000)
    found = {
        r["doc_id"]: (r["info"]["n_words"], r["info"]["n_removed"], r["info"]["kept_sha256"])
        for r in without_repeated_phrases(docs, "info").collect()
    }
    assert found == plain_phrases(rows)


def test_repeated_phrases_keep_columns(odd_documents, no_documents, clashing, odd_rows):
    docs = clashing(odd_documents)
    found = without_repeated_phrases(docs)
    assert found.columns == docs.columns and found.count() == len(odd_rows)
    kept = {r["doc_id"]: r["text"] for r in found.collect()}
    assert kept[0] in (odd_rows[0][1], "") and kept[21] is None
    assert without_repeated_phrases(no_documents).collect() == []


# Vectors


VECTORS = "vec_id bigint, embedding array<float>, label int"


def cosine(x, y):
    dot = sum(a * b for a, b in zip(x, y))
    return dot / math.sqrt(sum(a * a for a in x)) / math.sqrt(sum(b * b for b in y))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(9)
    rows = []
    for k in range(40):
        base = rng.normal(size=16)
        for copy in range(4):
            near = base + (copy > 1) * rng.normal(size=16) * 0.05
            rows.append((len(rows), near.astype(np.float32).tolist(), k % 3))
    odd = [
        None, [0.0] * 16, [None] * 16, [float("nan")] * 16, [1.0, 2.0],
        [float("inf")] * 16, [], rows[0][1],
    ]
    rows += [(1000 + k, x, 0) for k, x in enumerate(odd)]
    rows += [(2000, rows[0][1], None), (2001, rows[0][1], 1)]
    return rows


def plain_links(vectors):
    """(n_links, component_id) by vec_id, by comparing all."""

    def usable(x):
        return x and None not in x and np.isfinite(x).all() and any(x)

    good = [v for v in vectors if v[2] is not None and usable(v[1])]
    links = [
        (a[0], b[0])
        for k, a in enumerate(good)
        for b in good[k + 1 :]
        if a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.98
    ]
    ids = [v[0] for v in vectors]
    counts = {x: sum(x in pair for pair in links) for x in ids}
    return counts, least_reachable(ids, links)


@pytest.mark.parametrize("largest, tile", [(256, 512), (2, 3), (0, 1)])
def test_near_vectors(spark, vectors, tmp_path, monkeypatch, largest, tile):
    monkeypatch.setattr(quantised, "LARGE_BUCKET", largest)
    monkeypatch.setattr(vector_tiles, "TILE", tile)
    docs = spark.createDataFrame(vectors, VECTORS)
    docs.write.parquet(str(tmp_path / "embeddings.parquet"))
    found = {r["vec_id"]: r for r in near_vectors_query(spark, str(tmp_path)).collect()}
    counts, want = plain_links(vectors)
    assert sum(counts.values()) > 120
    assert {x: r["n_links"] for x, r in found.items()} == counts
    assert {x: r["component_id"] for x, r in found.items()} == want
    assert all(r["kept"] == (x == want[x]) for x, r in found.items())


def test_vectors_without_or_with_one_id_and_clashing_columns(spark):
    rows = [
        (None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1),
        (5, [1.0, 0.01], 1), (7, [2.0, 0.0], 1), (8, [0.0, 1.0], 1),
    ]
    clashing = ("class_id", "n", "vector", "length", "key", "block", "n_links")
    docs = spark.createDataFrame(rows, VECTORS)
    docs = docs.selectExpr("*", *(f"'x' AS {name}" for name in clashing))
    found = near_vectors(docs).collect()
    assert sorted(map(tuple, found), key=str) == [
        (5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (8, 0, 8, True),
        (None, 0, None, True), (None, 0, None, True),
    ]


def test_recall_on_a_hot_label(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(300, 32))
    # A third of all rows is one crowd, in which most link and none is equal.
    at = np.where(rng.random(5000) < 0.33, 0, rng.integers(0, 300, 5000))
    x = (centres[at] + rng.normal(size=(5000, 32)) * 0.13).astype(np.float32)
    labels = (at % 4).tolist()
    rows = [(k, v, labels[k]) for k, v in enumerate(x.tolist())]
    monkeypatch.setattr(vector_tiles, "TILE", 200)
    found = near_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    unit = x.astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    link = (unit @ unit.T >= 0.98) & (np.equal.outer(at % 4, at % 4))
    counts = link.sum(axis=1) - 1
    n_links = {r["vec_id"]: r["n_links"] for r in found}
    assert counts.sum() > 500_000
    assert all(n_links[k] <= counts[k] for k in range(5000))
    assert sum(n_links.values()) >= 0.99 * counts.sum()


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], VECTORS)).collect() == []
