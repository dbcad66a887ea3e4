"""Suffix arrays and common prefixes of one shard of bytes, in numpy."""

from __future__ import annotations

import numpy as np

_FIRST = 5  # bytes that the first sort looks at
MOST_BYTES = (1 << 21) - 2  # two ranks and a slot fit in 63 bits


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of ``text`` (uint8, at most MOST_BYTES long) by Larsson-Sadakane refinement.

    Suffixes are sorted by their first bytes, then groups of equal ones by the ranks of what follows,
    which doubles the depth each time; groups of one are settled and left alone.
    """
    n = len(text)
    if n > MOST_BYTES:
        raise ValueError("the shard is too large")
    key = np.zeros(n, np.uint64)
    padded = np.concatenate((text, np.zeros(_FIRST, np.uint8)))
    for i in range(_FIRST):
        key = (key << np.uint64(8)) | padded[i : i + n]
    key = np.sort((key << np.uint64(21)) | np.arange(n, dtype=np.uint64))
    sa = (key & np.uint64((1 << 21) - 1)).astype(np.int64)
    prefix = key >> np.uint64(21)
    # zero padding is not a byte: a suffix shorter than the depth is alone in its group, before longer ones
    new = np.concatenate(([True], prefix[1:] != prefix[:-1]))[:n]
    short = sa > n - _FIRST
    if short.any():
        order = np.lexsort((np.where(short, n - sa, n + 1), prefix))
        sa, prefix, short = sa[order], prefix[order], short[order]
        new = np.concatenate(([True], (prefix[1:] != prefix[:-1]) | short[1:] | short[:-1]))[:n]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    open_ = np.flatnonzero(~(new & np.append(new[1:], True)))
    depth = _FIRST
    while len(open_):
        at = sa[open_]
        follow = rank[np.minimum(at + depth, n)] + 1
        slot = np.arange(len(open_), dtype=np.uint64)
        packed = (rank[at].astype(np.uint64) << np.uint64(42)) | (follow.astype(np.uint64) << np.uint64(21)) | slot
        packed.sort()
        at = at[(packed & np.uint64((1 << 21) - 1)).astype(np.int64)]
        pair = packed >> np.uint64(21)
        new = np.concatenate(([True], pair[1:] != pair[:-1]))
        sa[open_] = at
        rank[at] = np.maximum.accumulate(np.where(new, open_, 0))
        open_ = open_[~(new & np.append(new[1:], True))]
        depth *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in ``sa`` (0 for the first).

    Kasai's rule in array form: from one text position to the next the common prefix loses one byte at
    most, and exactly one where the bytes before both suffixes are equal. So only positions with
    different bytes before them are compared, eight bytes at a time; the rest follow by counting down.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    here = np.arange(n)
    derived = (here > 0) & (before > 0)
    derived[derived] = text[here[derived] - 1] == text[before[derived] - 1]
    at = np.flatnonzero(~derived & (before >= 0))
    word = np.zeros(n + 8, np.uint64)
    padded = np.concatenate((text, np.zeros(16, np.uint8)))
    for i in range(8):
        word |= padded[i : i + n + 8].astype(np.uint64) << np.uint64(8 * i)
    found = np.zeros(n, np.int64)
    going, a, b, length = np.arange(len(at)), at.copy(), before[at], np.zeros(len(at), np.int64)
    while len(going):
        x = word[a] ^ word[b]
        lowest = x & (~x + np.uint64(1))
        same = np.where(x == 0, 8, np.floor(np.log2(np.maximum(lowest, 1).astype(np.float64))).astype(np.int64) // 8)
        room = n - np.maximum(a, b)
        same = np.minimum(same, room)
        length[going] += same
        more = (same == 8) & (room > 8)
        going, a, b = going[more], a[more] + 8, b[more] + 8
    found[at] = length
    source = np.maximum.accumulate(np.where(derived, -1, here))
    plcp = np.where(derived, found[source] - (here - source), found)
    return plcp[sa]
