"""Word-wise encoding with the public tokenizers, for use inside tasks.

Whole texts are encoded by putting together what their words encode to. Words
repeat, so a bounded memory of them saves most of the work.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from codecs import charmap_decode

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
#: Words remembered by one Python worker; when it is full it starts afresh.
REMEMBERED = 500_000
#: Words of ``WordBpe``, whose entries are small: some 200 MB.
BPE_REMEMBERED = 1_000_000
LONGEST_REMEMBERED = 64
#: Marks that no token joins with a letter before them.
MARKS = ".,!?;:|#$%&*()"


def vocabulary_path(name: str, folder: str | None = None) -> str:
    """Where a vocabulary file lies: ``folder``, or the installed package."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


class WordMemory(dict):
    """Encoding of each word; words not yet met are encoded on demand."""

    remembered = REMEMBERED

    def __missing__(self, word):
        value = self.encode_word(word)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= self.remembered:
                self.clear()
            self[word] = value
        return value

    def encode_word(self, word):
        raise NotImplementedError


class WordBpe(WordMemory):
    """Ids as unsigned 32-bit little-endian bytes, by the tokenizers library.

    Its pre-tokenizer drops white space and no merge crosses it, so a text's
    ids are those of its words in order.
    """

    remembered = BPE_REMEMBERED

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # The model reads bytes as letters: printable ones as they are, the
        # others as the letters from 256 on.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [x for x in range(256) if x not in shown]
        self.letters = "".join(
            chr(256 + hidden.index(x) if x in hidden else x) for x in range(256)
        )

    def encode_word(self, word: str) -> bytes:
        lower = word.lower()
        stem = lower.rstrip(MARKS)
        # Letters and marks are separate words to it, and case is dropped.
        if stem.isalpha() and (
            word.isascii()
            or "Σ" not in word
            and "İ" not in word
            and unicodedata.is_normalized("NFC", word)
        ):
            if stem != word:
                marks = lower[len(stem):]
                return self[stem] + (self[marks] if marks else b"")
            if not stem.isascii():
                stem, _ = charmap_decode(stem.encode(), "strict", self.letters)
            return array("I", [x.id for x in self.model.tokenize(stem)]).tobytes()
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        # Case is dropped anyway. Beyond ASCII a letter's place may decide its case.
        if text.isascii():
            text = text.lower()
        words = text.replace("\n", " ").replace("\t", " ").split(" ")
        return b"".join(map(self.__getitem__, words))


_loaded: dict[tuple, WordMemory] = {}


def loaded(kind: type, path: str) -> WordMemory:
    """One encoder for each Python worker, kept from task to task."""
    key = kind, path
    if key not in _loaded:
        _loaded[key] = kind(path)
    return _loaded[key]
