"""Words and word n-grams of a text as 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: Odd multipliers of the polynomial over bytes and of the places in a window.
BYTE_BASE = 0x9E3779B97F4A7C15
PLACES = [
    0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
    0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
]
_powers: dict[str, np.ndarray] = {}
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a number spread over all bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """BYTE_BASE to 0, 1, ... and its inverse to 0, 1, ..., modulo 2^64."""
    if len(_powers.get("up", ())) < count:
        size = max(1 << 16, 1 << count.bit_length())
        inverse = pow(BYTE_BASE, -1, 1 << 64)
        for name, base in (("up", BYTE_BASE), ("down", inverse)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=U64)
    return _powers["up"], _powers["down"]


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of every word of UTF-8 text, in order."""
    return hashed_spans(data, *word_spans(data))


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where words start and end."""
    text = np.concatenate(([True], IS_BLANK[np.frombuffer(data, np.uint8)], [True]))
    edges = np.flatnonzero(text[1:] != text[:-1])
    return edges[::2], edges[1::2]


def hashed_spans(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    letters = np.frombuffer(data, np.uint8).astype(U64) + U64(1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(mixed(letters) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words (place k: odd multiplier k)."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, U64)
    total = np.zeros(count, U64)
    for k in range(width):
        factor = (PLACES[k % 5] * (2 * (k // 5) + 1)) & (2**64 - 1)
        total += words[k : k + count] * U64(factor)
    return mixed(total)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct shingles of the text with A-Z lower-cased.

    A text of fewer words is one shingle; a text without words has none.
    """
    words = word_hashes((text or "").encode("utf-8", "replace").lower())
    if len(words) == 0:
        return np.zeros(0, U64)
    if len(words) < width:
        short = window_hashes(words, len(words)) + U64(len(words))
        return mixed(short)
    return np.unique(window_hashes(words, width))
