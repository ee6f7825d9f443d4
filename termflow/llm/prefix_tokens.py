"""Operator 6: SentencePiece BPE ids by a table of prefix-ending tokens.

For BPE, the encoding of a prefix ends in one certain token, and the encoding
of a text is the encoding of a shorter prefix plus that token. So the table
``last[i]`` holds, for each prefix, its last token. Candidates are the pieces an
Aho-Corasick automaton finds ending there; the right one is compatible with the
token that ends where it begins, that is, merging their two strings gives just
these two tokens. Ids are then read backwards from the end of the table.

Texts are taken apart where no piece reaches across: before a run of spaces, at
a line feed, and between letters and marks after them.

Defined cases: NULL and empty texts have no ids; rows are independent, so
repeated rows, ties and extra columns change nothing; an empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from termflow.llm.storage import documents
from termflow.llm.token_blocks import arrow_schema
from termflow.llm.vocabulary import (
    MARKS,
    PIECE_BPE,
    WordMemory,
    loaded,
    vocabulary_path,
)

SPACE = "▁"
OUT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
#: Segments of a text with runs of spaces: each begins with them or a line feed.
SEGMENTS = re.compile(r" +[^ \n]*|\n[^ \n]*")


class PieceBpe(WordMemory):
    """Segments to ids as text, each followed by a comma."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.texts: list[str | bytes] = []
        self.pieces: list[str] = []
        self.ids: dict[str, int] = {}
        self.piece_scores: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.unknown = model.unk_id()
        self.unknown_text = model.decode([self.unknown])
        self.automaton = ahocorasick.Automaton()
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            self.pieces.append(piece)
            self.texts.append(piece.replace(SPACE, " "))
            if model.is_byte(number):
                value = int(piece[1:-1], 16)
                self.bytes[value] = number
                self.texts[number] = bytes([value])
            elif model.is_control(number) or model.is_unused(number):
                self.texts[number] = ""
            elif number != self.unknown:
                self.ids[piece] = number
                self.piece_scores[piece] = model.get_score(number)
                self.automaton.add_word(piece, (number, len(piece)))
        self.automaton.make_automaton()
        self.singles = {piece for piece in self.ids if len(piece) == 1}
        # Places inside a piece that this class takes apart would be wrong.
        self.joined = {
            piece[k : k + 2] for piece in self.ids for k in range(len(piece) - 1)
        }
        assert not any(
            pair[0].isalpha() and pair[1] in MARKS
            or pair[0] != SPACE and pair[1] == SPACE
            or "\n" in pair
            for pair in self.joined
        ), "pieces reach across the places where texts are taken apart"
        self.pairs: dict[tuple[int, int], bool] = {}
        self.chunks = ChunkIds(self)
        self.decoded = SegmentTexts(self)

    def merged(self, text: str) -> list[str]:
        """Plain BPE of a short string: the best pair first, left to right."""
        parts, score = list(text), self.piece_scores.get
        none = -float("inf")
        ranks = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = max(ranks)
            if best == none:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(ranks):
                ranks[at] = score(parts[at] + parts[at + 1], none)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """No merge reaches across: both strings together give this pair.

        At the start of a text, where ``left`` is -1: the right one's own
        string is encoded as this one piece.
        """
        pieces = [self.pieces[x] for x in (left, right) if x >= 0]
        value = self.merged("".join(pieces)) == pieces
        if len(self.pairs) >= 1_000_000:
            self.pairs.clear()
        self.pairs[left, right] = value
        return value

    def encode_known(self, text: str) -> list[int]:
        """Ids of a string whose characters all are pieces."""
        last = [-1] * (len(text) + 1)  # last[i]: the token that ends prefix i
        starts = [0] * (len(text) + 1)
        known = self.pairs.get
        for end, (token, length) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            begin = end - length
            before = last[begin] if begin else -1
            right = known((before, token))
            if right is None:
                right = self.compatible(before, token)
            if right:
                last[end], starts[end] = token, begin
        ids, end = [], len(text)
        while end:
            ids.append(last[end])
            end = starts[end]
        return ids[::-1]

    def encode_chunk(self, text: str) -> list[int]:
        """Ids of any string; characters that are no pieces become bytes."""
        if self.singles.issuperset(text):
            return self.encode_known(text)
        ids, known = [], []
        for char in text:
            if char in self.singles:
                known.append(char)
                continue
            ids += self.encode_known("".join(known))
            known = []
            if self.bytes:
                ids += [self.bytes[value] for value in char.encode()]
            else:
                ids.append(self.unknown)
        return ids + self.encode_known("".join(known))

    def encode_word(self, segment: str) -> str:
        """A segment: after a space unless it begins with a line feed."""
        if segment[:1] == "\n":
            rest = segment[1:]
            return self.chunks["\n"] + (self.pieces_of(rest) if rest else "")
        return self.pieces_of(SPACE + segment)

    def pieces_of(self, text: str) -> str:
        stem = text.rstrip(MARKS)
        if stem != text and stem[-1:].isalpha():
            return self.chunks[stem] + self.chunks[text[len(stem):]]
        return self.chunks[text]

    def segments(self, text: str | None) -> list[str]:
        """The text in parts whose ids and decoded texts only need joining."""
        if not text:
            return []
        plain = text.replace(SPACE, " ") if SPACE in text else text
        spaced = plain.replace("\n", " \n")
        if "  " in spaced or spaced[0] == " " or spaced[-1] == " ":
            return [
                part[1:].replace(" ", SPACE) if part[0] == " " else part
                for part in SEGMENTS.findall(" " + plain)
            ]
        return spaced.split(" ")

    def encode(self, text: str | None) -> str:
        """All ids of a text, each followed by a comma."""
        return "".join(map(self.__getitem__, self.segments(text)))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes joined to UTF-8, the first space dropped."""
        text = self.joined_text(ids)
        return text[1:] if text[:1] == " " else text

    def joined_text(self, ids: list[int]) -> str:
        out, held = [], b""
        for token in ids:
            text = self.texts[token]
            if isinstance(text, bytes):
                held += text
                continue
            if held:
                out.append(held.decode(errors="replace"))
                held = b""
            out.append(self.unknown_text if token == self.unknown else text)
        if held:
            out.append(held.decode(errors="replace"))
        return "".join(out)


class ChunkIds(WordMemory):
    """Ids of chunks, shared by the segments that contain them."""

    def __init__(self, encoder: PieceBpe):
        self.encoder = encoder

    def encode_word(self, chunk: str) -> str:
        return "".join(f"{x}," for x in self.encoder.encode_chunk(chunk))


class SegmentTexts(WordMemory):
    """Decoded text of a segment's ids.

    A character's bytes lie in one segment, so texts of segments can be joined.
    """

    def __init__(self, encoder: PieceBpe):
        self.encoder = encoder

    def encode_word(self, segment: str) -> str:
        ids = self.encoder[segment][:-1].split(",")
        return self.encoder.joined_text(list(map(int, ids)))


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens and digests of ids and of the text decoded from them."""
    model = model or vocabulary_path(PIECE_BPE)
    schema = arrow_schema(OUT)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(PieceBpe, model)
        sha = hashlib.sha256
        for batch in batches:
            count, ids_sha, text_sha = [], [], []
            for value in batch["text"]:
                segments = encoder.segments(value.as_py())
                ids = "".join(map(encoder.__getitem__, segments))
                text = "".join(map(encoder.decoded.__getitem__, segments))
                count.append(ids.count(","))
                ids_sha.append(sha(ids[:-1].encode()).hexdigest())
                text = text[1:] if text[:1] == " " else text
                text_sha.append(sha(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].cast(pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(ids_sha, pa.string()),
                    pa.array(text_sha, pa.string()),
                ],
                schema=schema,
            )

    return docs.select("doc_id", "text").mapInArrow(encode, OUT)


def prefix_tokens_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: encode and decode all documents."""
    return encode_documents(documents(spark, sf_dir))
