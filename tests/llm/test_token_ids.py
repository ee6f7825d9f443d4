import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termflow.llm import repair
from termflow.llm.packing import (
    OpenBins,
    best_fit_decreasing,
    pack_documents,
    packing_query,
)
from termflow.llm.prefix_tokens import (
    PieceBpe,
    encode_documents,
    prefix_tokens_query,
)
from termflow.llm.repair import (
    LEAST_COUNT,
    build_grammar,
    expand,
    expand_all,
    read_range,
)
from termflow.llm.token_blocks import (
    BLOCKS,
    read_blocks,
    read_document,
    token_blocks_query,
    write_blocks,
)
from termflow.llm.vocabulary import PIECE_BPE, WORD_BPE, WordBpe, vocabulary_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(WORD_BPE))


@pytest.fixture(scope="module")
def pieces():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=vocabulary_path(PIECE_BPE))


def whole_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


LETTERS = st.text(
    st.sampled_from("abeßÉñΣİı '’.,!?#1²٣½\n\t  ▁́日😀<|>"), max_size=60
)


@settings(max_examples=300, deadline=None)
@given(LETTERS)
def test_word_wise_ids_are_the_whole_text_s(text):
    encoder = WORD_ENCODER.setdefault(0, WordBpe(vocabulary_path(WORD_BPE)))
    found = np.frombuffer(encoder.encode(text), "<u4").tolist()
    assert found == whole_ids(encoder.tokenizer, text)


def test_ascii_words_are_remembered_without_case(tokenizer):
    encoder = WordBpe(vocabulary_path(WORD_BPE))
    text = "Nut nut NUT It'S OAK"
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids
    assert set(encoder) == {"nut", "it's", "oak"}
    assert encoder.encode("Öl Ñ") == b"".join(map(encoder.encode_word, ["öl", "ñ"]))


WORD_ENCODER = {}
PIECE_ENCODER = {}


@settings(max_examples=300, deadline=None)
@given(LETTERS)
def test_prefix_table_equals_the_library(text):
    from sentencepiece import SentencePieceProcessor

    path = vocabulary_path(PIECE_BPE)
    if not PIECE_ENCODER:
        PIECE_ENCODER.update(
            own=PieceBpe(path), theirs=SentencePieceProcessor(model_file=path)
        )
    own, theirs = PIECE_ENCODER["own"], PIECE_ENCODER["theirs"]
    ids = theirs.encode(text)
    assert own.encode(text) == "".join(f"{x}," for x in ids)
    assert own.decode(ids) == theirs.decode(ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=400), st.data())
def test_grammar_gives_back_its_ids(ids, data):
    array = np.array(ids * 3, "<u4")
    grammar = build_grammar(array)
    assert expand(grammar).tolist() == expand_all(grammar).tolist() == array.tolist()
    if len(array):
        start = data.draw(st.integers(0, len(array) - 1))
        stop = data.draw(st.integers(start + 1, len(array)))
        assert read_range(grammar, start, stop).tolist() == array[start:stop].tolist()


def frequent_left(grammar):
    """Pairs of the grammar's symbols with LEAST_COUNT places that do not overlap."""
    counts, ends = {}, {}
    symbols = grammar.symbols.tolist()
    for at, pair in enumerate(zip(symbols, symbols[1:])):
        if ends.get(pair, -1) <= at:
            counts[pair] = counts.get(pair, 0) + 1
            ends[pair] = at + 2 if pair[0] == pair[1] else at
    return [pair for pair, n in counts.items() if n >= LEAST_COUNT]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=600), st.integers(1, 5))
def test_grammar_leaves_no_frequent_pair(ids, copies):
    array = np.array(ids * copies, "<u4")
    grammar = build_grammar(array)
    assert frequent_left(grammar) == []
    assert expand_all(grammar).tolist() == array.tolist()


def test_grammar_with_pairs_that_share_slots(monkeypatch):
    monkeypatch.setattr(repair, "SLOTS", 4)
    array = np.random.default_rng(3).integers(0, 30, 5000).astype("<u4")
    grammar = build_grammar(array)
    assert frequent_left(grammar) == []
    assert expand(grammar).tolist() == array.tolist()


def test_rules_span_a_repeated_passage():
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 40_000, 4096)
    copies = [np.r_[passage, rng.integers(0, 40_000, 50)] for _ in range(64)]
    grammar = build_grammar(np.concatenate(copies).astype("<u4"))
    assert grammar.lengths.max() >= 4096
    assert len(grammar.symbols) < 64 * 60
    assert frequent_left(grammar) == []


def test_grammar_shortens_repeats():
    grammar = build_grammar(np.tile(np.arange(50, dtype="<u4"), 200))
    assert len(grammar.symbols) + 2 * len(grammar.left) < 1500
    sizes = [
        len(expand(grammar, np.array([grammar.base + k], np.uint32)))
        for k in range(len(grammar.left))
    ]
    assert sizes == grammar.lengths.tolist()


def test_token_blocks(spark, sf_dir, clean_rows, tokenizer):
    start, want = 0, []
    for doc_id, text, *_ in sorted(clean_rows):
        ids = [*whole_ids(tokenizer, text), 1]
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, token_blocks_query(spark, sf_dir).collect())) == want


def test_small_blocks_and_random_access(spark, odd_documents, odd_rows, tokenizer, tmp_path):
    path = str(tmp_path / "blocks")
    write_blocks(odd_documents, path, block_ids=100)
    blocks = [r.asDict() for r in spark.read.schema(BLOCKS).parquet(path).collect()]
    assert len(blocks) > 5
    found = sorted(
        (str(doc_id), read_document(block, k).tolist())
        for block in blocks
        for k, doc_id in enumerate(block["doc_ids"])
    )
    assert found == sorted((str(r[0]), [*whole_ids(tokenizer, r[1]), 1]) for r in odd_rows)
    starts = sorted(r["start"] for r in read_blocks(spark, path).collect())
    sizes = [len(ids) for _, ids in found]
    assert starts[0] == 0 and len(starts) == len(odd_rows)
    assert max(starts) < sum(sizes)


def test_token_blocks_of_nothing(spark, no_documents, tmp_path):
    path = str(tmp_path / "blocks")
    write_blocks(no_documents, path)
    assert read_blocks(spark, path).collect() == []


def test_pieces_of_documents(spark, sf_dir, clean_rows, pieces, no_documents):
    want = []
    for doc_id, text, *_ in sorted(clean_rows):
        ids = pieces.encode(text or "")
        digests = [
            sha256(x.encode()).hexdigest()
            for x in (",".join(map(str, ids)), pieces.decode(ids))
        ]
        want.append((doc_id, len(ids), *digests))
    assert sorted(map(tuple, prefix_tokens_query(spark, sf_dir).collect())) == want
    assert encode_documents(no_documents).collect() == []


def check_packing(rows, size):
    by_sequence = defaultdict(list)
    for row in rows:
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(by_sequence)


def test_packing_of_documents(spark, sf_dir, clean_rows, tokenizer):
    rows = packing_query(spark, sf_dir).collect()
    want = []
    for doc_id, text, *_ in clean_rows:
        ids = [*whole_ids(tokenizer, text), 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            own = ids[at : at + 2048]
            want.append((doc_id, piece, at, len(own), crc(own)))
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[n] for n in names) for r in rows) == sorted(want)
    check_packing(rows, 2048)


def test_small_sequences_and_odd_rows(odd_documents, odd_rows, no_documents):
    rows = pack_documents(odd_documents, size=64).collect()
    assert len({(str(r["doc_id"])) for r in rows}) == len({str(r[0]) for r in odd_rows})
    check_packing(rows, 64)
    assert pack_documents(no_documents).collect() == []


def plain_best_fit(lengths, size):
    bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [k for k, room in enumerate(bins) if room >= length]
        if fitting:
            bins[min(fitting, key=lambda k: bins[k])] -= length
        else:
            bins.append(size - length)
    return sorted(bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120), st.integers(30, 40))
def test_runs_are_best_fit_decreasing(lengths, size):
    histogram = {x: lengths.count(x) for x in set(lengths)}
    rows = []
    runs = best_fit_decreasing(histogram, size)
    for k, (length, rank, each, first, offset) in enumerate(runs):
        same = [r for r in runs[k + 1 :] if r[0] == length]
        end = same[0][1] if same else histogram[length]
        for nth in range(end - rank):
            rows.append(
                {
                    "sequence_id": first + nth // each,
                    "offset": offset + nth % each * length,
                    "length": length,
                }
            )
    used = check_packing(rows, size)
    plain = plain_best_fit(lengths, size)
    assert len(rows) == len(lengths) and used == len(plain)


def test_segment_tree_finds_the_tightest():
    bins = OpenBins(20)
    assert bins.tightest(1) is None
    for capacity, first in ((5, 0), (9, 1), (20, 2)):
        bins.add(capacity, first, 1)
    assert [bins.tightest(x) for x in (1, 5, 6, 10, 20)] == [5, 5, 9, 20, 20]
    assert bins.take(9, 4) == (1, 1) and bins.tightest(6) == 20
