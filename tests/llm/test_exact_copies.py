import random
import re
from collections import defaultdict
from hashlib import sha256

import pytest

from termflow.llm.extendible_hash import (
    MOST_DEPTH,
    Directory,
    exact_copies,
    exact_copies_query,
    key_of,
    known_texts,
    read_index,
)


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def plain_copies(rows):
    """Sorted (doc_id, keep_id, group_size, kept, sha256) of rows."""
    groups, out = defaultdict(list), []
    for doc_id, text, *_ in rows:
        groups[squeezed(text)].append((-len(text or ""), doc_id is None, doc_id))
    for text, found in groups.items():
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        digest = sha256(text.encode()).hexdigest()
        for nth, (_, _, doc_id) in enumerate(found):
            out.append((doc_id, found[0][2], len(found), nth == 0, digest))
    return sorted(out, key=repr)


def as_rows(df):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_query(spark, sf_dir, clean_rows):
    assert as_rows(exact_copies_query(spark, sf_dir)) == plain_copies(clean_rows)


@pytest.mark.parametrize("key_bits", [64, 2, 0])
def test_odd_rows_and_colliding_keys(spark, odd_documents, odd_rows, clashing, key_bits):
    found = exact_copies(clashing(odd_documents), key_bits=key_bits, bucket_bytes=50)
    assert as_rows(found) == plain_copies(odd_rows)


def test_empty_table(no_documents):
    assert exact_copies(no_documents).collect() == []


def test_hot_text_ties_and_long_texts(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abc \n") for _ in range(300_000))
    rows = [(k, "same text" + " " * (k % 3)) for k in range(1500)]
    rows += [(k, f"text {k % 700}") for k in range(1500, 3000)]
    rows += [(3000, long), (3001, long.replace(" ", "")), (3002, long + "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    found = exact_copies(docs, bucket_bytes=200)
    assert as_rows(found) == plain_copies(rows)


def test_index_files(spark, odd_documents, odd_rows, tmp_path):
    path = str(tmp_path / "index")
    exact_copies(odd_documents, path, bucket_bytes=100).count()
    index = read_index(spark, path).where("text IS NOT NULL").collect()
    texts = sorted({squeezed(r[1]) for r in odd_rows})
    assert sorted(bytes(r["text"]).decode() for r in index) == texts
    directory = spark.read.parquet(f"{path}/directory").collect()
    by_number = {r["bucket"]: r for r in directory}
    assert len(directory) > 8
    for row in index:
        own = by_number[row["bucket"]]
        key = key_of(bytes(row["text"]))
        assert (row["key"] - key) % (1 << 64) == 0
        assert key >> (64 - own["depth"]) == own["prefix"]
    for row in directory:
        held = [r for r in index if r["bucket"] == row["bucket"]]
        taken = sum(len(r["text"]) for r in held)
        assert taken == row["bytes"] and (taken <= 100 or len(held) == 1)


def test_known_texts(spark, odd_documents, odd_rows, tmp_path):
    path = str(tmp_path / "index")
    exact_copies(odd_documents, path, key_bits=3).count()
    asked = [(1, odd_rows[0][1] + "  "), (2, "never seen"), (3, None), (4, "never seen")]
    docs = spark.createDataFrame(asked, "doc_id bigint, text string")
    found = known_texts(spark, path, docs).collect()
    assert {r["doc_id"]: r["known"] for r in found} == {
        1: True, 2: False, 3: True, 4: False,
    }


def test_directory_doubles_and_splits():
    directory = Directory()
    assert directory.bucket_of(1 << 63) == 0
    assert directory.split(0) == 1 and directory.depth == 1
    assert directory.split(1) == 2 and directory.depth == 2
    # The other bucket keeps its depth and has two slots.
    assert directory.slots == [0, 0, 1, 2]
    assert directory.split(0) == 3 and directory.depth == 2
    assert directory.slots == [0, 3, 1, 2]
    assert [directory.bucket_of(k << 62) for k in range(4)] == [0, 3, 1, 2]


def test_owners_have_ranges_of_keys():
    rng = random.Random(1)
    loads = {rng.randrange(1 << MOST_DEPTH): (2, rng.randrange(1, 99)) for _ in range(900)}
    loads[77] = (1, 10_000)  # one key only: never split further
    directory = Directory.of_loads(loads, 500)
    owners = directory.owners(7)
    in_order = list(dict.fromkeys(directory.slots))
    assert sorted(in_order) == list(range(len(directory.buckets)))
    assert [owners[b] for b in in_order] == sorted(owners) and set(owners) == set(range(7))
    assert sum(directory.loads) == sum(n for _, n in loads.values())
    alone = directory.bucket_of(77 << (64 - MOST_DEPTH))
    assert directory.loads[alone] >= 10_000
    assert all(n <= 500 for b, n in enumerate(directory.loads) if b != alone)
