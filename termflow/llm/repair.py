"""Re-Pair grammars over blocks of token ids (numpy, inside tasks)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: A rule costs two symbols, so a pair has to occur more often than that.
LEAST_COUNT = 4
#: Frequent pairs replaced at once. They are found again each round, so a pair
#: that loses its slot or its overlaps takes part in a later one.
SLOTS = 1 << 18


@dataclass
class Grammar:
    """Symbols below ``base`` are ids; ``base + k`` stands for rule ``k``."""

    base: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray  # of the rules' expansions, in ids
    symbols: np.ndarray


def frequent_pairs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rank of each key's pair or -1, the pairs by rank, what may be frequent).

    The most frequent pair has the highest rank and always has a slot. Keys that
    share a slot with another pair have no rank, but may be frequent.
    """
    ordered = np.sort(keys)
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    counts = np.diff(np.r_[starts, len(ordered)])
    often = counts >= LEAST_COUNT
    pairs, counts = ordered[starts[often]], counts[often]
    pairs = pairs[np.argsort(counts, kind="stable")]

    def slot(key):
        return ((key * -7046029254386353131) >> 40) & (SLOTS - 1)

    table = np.full(SLOTS, -1, np.int32)
    table[slot(pairs)] = np.arange(len(pairs))  # the last, most frequent, win
    if not len(pairs):
        return np.full(len(keys), -1, np.int32), pairs, np.zeros(len(keys), bool)
    rank = table[slot(keys)]
    maybe = rank >= 0
    hit = maybe & (pairs[rank] == keys)  # -1 takes some pair, which is no hit
    return np.where(hit, rank, -1), pairs, maybe


def every_other(at: np.ndarray) -> np.ndarray:
    """Every other one of each run of neighbours, from its start, as a mask."""
    index = np.arange(len(at), dtype=np.int32)
    start = index.copy()
    start[1:][np.diff(at) == 1] = 0
    return (index - np.maximum.accumulate(start)) & 1 == 0


def above_neighbours(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Places whose rank is above those of the places beside them, as a mask."""
    beside = np.diff(at) == 1
    rises = np.diff(rank) > 0
    return np.r_[True, ~beside | rises] & np.r_[~beside | ~rises, True]


def build_grammar(ids: np.ndarray) -> Grammar:
    """Replace frequent pairs by nonterminals until no pair is frequent.

    Many pairs are replaced at once: of pairs that overlap every other one, and
    once that replaces little, those of higher rank than their neighbours. The
    most frequent pair is then replaced wherever it stands, so every round makes
    a rule until no pair has ``LEAST_COUNT`` occurrences that do not overlap.

    A pair that is not frequent becomes so only with a new symbol. Each round
    therefore looks at open positions: those beside a new symbol, and those whose
    pair was, or may have been, frequent.
    """
    symbols = ids.astype(np.uint32)
    base = int(symbols.max()) + 1 if len(symbols) else 1
    lefts, rights = [], []
    rules = 0
    is_open = np.ones(len(symbols), bool)  # of the pair that starts there
    by_rank = False
    while True:
        at = np.flatnonzero(is_open[:-1])
        if len(at) == len(symbols) - 1:
            first, second = symbols[:-1], symbols[1:]
        else:
            first, second = symbols[at], symbols[at + 1]
        # Of x x x, only every other x x counts.
        twins = np.flatnonzero(first == second)
        passed = twins[~every_other(at[twins])]
        keys = np.delete(first.astype(np.int64) << 32 | second, passed)
        kept = np.delete(at, passed)
        if len(keys) < LEAST_COUNT:
            break
        rank, pairs, maybe = frequent_pairs(keys)
        if not len(pairs):
            break
        is_open[:] = False
        is_open[at[passed]] = True
        is_open[kept[maybe]] = True
        chosen = np.flatnonzero(rank >= 0)
        at, rank = kept[chosen], rank[chosen]
        choose = above_neighbours(at, rank) if by_rank else every_other(at)
        choose = np.flatnonzero(choose)  # places are faster than a mixed mask
        at, rank = at[choose], rank[choose]
        used = np.bincount(rank, minlength=len(pairs)) >= LEAST_COUNT
        chosen = np.flatnonzero(used[rank])
        at, rank = at[chosen], rank[chosen]
        by_rank = by_rank or len(at) * 50 < len(symbols)
        number = np.cumsum(used) - 1 + base + rules
        lefts.append((pairs[used] >> 32).astype(np.uint32))
        rights.append((pairs[used] & 0xFFFFFFFF).astype(np.uint32))
        is_open[at] = True
        is_open[at[at > 0] - 1] = True
        # Where the symbol before is replaced too, its new place is open already.
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols[at] = number[rank]
        keep = np.flatnonzero(keep)
        symbols, is_open = symbols[keep], is_open[keep]
        rules += int(used.sum())
    left = np.concatenate(lefts) if lefts else np.zeros(0, np.uint32)
    right = np.concatenate(rights) if rights else np.zeros(0, np.uint32)
    lengths = np.zeros(rules, np.uint32)
    done = 0
    for part in lefts:  # a rule refers to ids and to rules of earlier rounds
        known = np.r_[np.ones(base, np.uint32), lengths[:done]]
        end = done + len(part)
        lengths[done:end] = known[left[done:end]] + known[right[done:end]]
        done = end
    return Grammar(base, left, right, lengths, symbols)


def expand(grammar: Grammar, symbols: np.ndarray | None = None) -> np.ndarray:
    """The ids that symbols (by default all of them) stand for."""
    symbols = grammar.symbols if symbols is None else symbols
    while True:
        rule = symbols >= grammar.base
        if not rule.any():
            return symbols
        starts = np.cumsum(1 + rule) - 1 - rule
        grown = np.empty(len(symbols) + int(rule.sum()), np.uint32)
        grown[starts] = symbols
        which = symbols[rule] - grammar.base
        grown[starts[rule]] = grammar.left[which]
        grown[starts[rule] + 1] = grammar.right[which]
        symbols = grown


def expand_all(grammar: Grammar) -> np.ndarray:
    """All ids, through one table of every rule's expansion."""
    count = len(grammar.left)
    if not count:
        return grammar.symbols
    table = np.r_[
        np.arange(grammar.base, dtype=np.uint32),
        expand(grammar, np.arange(count, dtype=np.uint32) + grammar.base),
    ]
    sizes = np.r_[np.ones(grammar.base, np.int64), grammar.lengths]
    offsets = np.cumsum(sizes) - sizes
    length = sizes[grammar.symbols]
    ends = np.cumsum(length)
    shift = np.repeat(offsets[grammar.symbols] - (ends - length), length)
    return table[shift + np.arange(len(shift))]


def read_range(grammar: Grammar, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop``: only the symbols over them are expanded."""
    sizes = np.r_[np.ones(grammar.base, np.int64), grammar.lengths]
    ends = np.cumsum(sizes[grammar.symbols])
    first = int(np.searchsorted(ends, start, "right"))
    last = int(np.searchsorted(ends, stop, "left")) + 1
    before = int(ends[first - 1]) if first else 0
    ids = expand(grammar, grammar.symbols[first:last])
    return ids[start - before : stop - before]
