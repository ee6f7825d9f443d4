"""Signatures of the n-gram Jaccard join: segments of a hashed universe.

Two sets of sizes a <= c with Jaccard similarity of 4/5 or more differ in at most
(a + c) / 9 elements, and c is at most 5/4 a. Sizes are cut in bands, so that
linked sets lie in one band or in neighbouring ones. The scheme of a band deals
the universe by hash into segments. By the pigeonhole principle, if the segments
tolerate more than the possible differences together, some segment has no more
differences than it tolerates: none for a segment indexed by its subset, one for
a segment indexed by its one-deletion neighbourhood too. A set is indexed in the
scheme of its own band and in that of the band below.

The allocation chooses by cost how many segments have neighbourhoods. The
schemes tolerate ``slack`` more differences than needed, in units of one per
segment and two per segment with a neighbourhood. Linked sets therefore share
signatures of more than ``slack`` units. A set leaves out the empty subset, which
many have, if that costs it no more. What both would leave out is in the omissions
of either, so two sets that do share more units than either has left. If only one
does, they share more than that one has left, and nothing is sure of the other's
slack; a set that leaves out nothing therefore has 0 left.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np

from termflow.llm.shingles import U64, mixed

#: Cost of a segment subset with at most one element, in signatures.
POOR_SUBSET = 10.0


class Scheme(NamedTuple):
    low: int
    high: int  # sizes of the band
    segments: int
    neighbourhoods: int  # the first segments, indexed with one deletion
    slack: int


def allocation(size: int, needed: int) -> tuple[int, int]:
    """(segments, those with neighbourhoods) of least cost for a set's size."""
    best = None
    for deletions in range(needed // 2 + 1):
        segments = needed - deletions
        mean = size / segments
        poor = np.exp(-mean) * (1 + mean)
        poor_deleted = np.exp(-mean) * (1 + mean + mean * mean / 2)
        cost = (segments - deletions) * (1 + POOR_SUBSET * poor)
        cost += deletions * (2 + mean + POOR_SUBSET * poor_deleted)
        if best is None or cost < best[0]:
            best = cost, segments, deletions
    return best[1], best[2]


@cache
def scheme(band: int) -> Scheme:
    low = 1 if band == 0 else scheme(band - 1).high + 1
    high = low * 5 // 4
    most = (high + high * 5 // 4) // 9
    slack = most // 5 + 2 if most else 0
    return Scheme(low, high, *allocation(high, most + 1 + slack), slack)


@cache
def band_of(size: int) -> int:
    band = 0
    while scheme(band).high < size:
        band += 1
    return band


def bands(size: int) -> list[int]:
    """Schemes a set of this size is indexed in."""
    own = band_of(size)
    below = own and size <= scheme(own - 1).high * 5 // 4
    return [own, own - 1] if below else [own]


def signatures(
    elements: np.ndarray, band: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """(signatures, units that each one's omission loses, units left to omit)."""
    plan = scheme(band)
    salt = U64((band + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    spread = mixed(elements ^ salt)
    segment = (spread % U64(plan.segments)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    segment, value = segment[order], mixed(spread[order])
    starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    sums, present = np.add.reduceat(value, starts), segment[starts]
    sizes = np.diff(np.r_[starts, len(value)])
    names, totals = [present], [sums]
    near = segment < plan.neighbourhoods
    if near.any():  # all subsets with one element taken out
        place = np.searchsorted(present, segment[near])
        deeper = sizes[place] > 1
        names.append(segment[near][deeper])
        totals.append((sums[place] - value[near])[deeper])
    empty = np.setdiff1d(np.arange(plan.segments), present)
    lone = present[(sizes == 1) & (present < plan.neighbourhoods)]
    poor = np.r_[empty, lone]
    omitted = int((1 + (poor < plan.neighbourhoods)).sum())
    left = plan.slack - omitted
    if left < 0:
        names.append(poor)
        totals.append(np.zeros(len(poor), U64))
        left = 0  # the other set may have omitted up to its slack
    name, total = np.concatenate(names), np.concatenate(totals)
    units = 1 + (name < plan.neighbourhoods)
    found = mixed(total + mixed((name.astype(U64) + U64(1)) * salt))
    return found, units, left
