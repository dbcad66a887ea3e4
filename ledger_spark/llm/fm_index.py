"""A bidirectional FM-index over a shard of word ids, in numpy, good for phrases up to a fixed depth."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_SLOT = 21  # bits of a position; two ranks and a slot fill 63
MOST_WORDS = (1 << _SLOT) - 4
_LOW = np.uint64((1 << _SLOT) - 1)


def _sorted_slots(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots in the order of (high, low), equal ones as they came, and the sorted pairs without slots."""
    key = (high.astype(np.uint64) << np.uint64(2 * _SLOT)) | (low.astype(np.uint64) << np.uint64(_SLOT)) | np.arange(len(high), dtype=np.uint64)
    key.sort()
    return (key & _LOW).astype(np.int64), key >> np.uint64(_SLOT)


def _starts(values: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)


def suffix_order(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``words`` in the order of the ``depth`` words that begin there (past the end: smallest)."""
    n = len(words)

    def rank(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order, pairs = _sorted_slots(high, low)
        new = np.zeros(n, np.int64)
        new[_starts(pairs)] = 1
        ranks = np.empty(n, np.int64)
        ranks[order] = np.cumsum(new)
        return order, ranks

    def after(ranks: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate((ranks[by:], np.zeros(min(by, n), np.int64)))

    order, single = rank(words, np.zeros(n, np.int64))
    ranks, reach = single, 1
    while reach < depth:
        step = min(reach, depth - reach)
        # ranks of ``reach`` words begin every step; the last may overlap, as equal overlaps change nothing
        order, ranks = rank(ranks, after(ranks, step))
        reach += step
    return order


class _Direction:
    """Order, Burrows-Wheeler transform and last-to-first map of one reading direction."""

    def __init__(self, words: np.ndarray, depth: int):
        self.order = suffix_order(words, depth).astype(np.int32)  # a shard's positions and words fit
        self.before = words[self.order - 1].astype(np.int32)
        self.before[self.order == 0] = 0
        by_word, _ = _sorted_slots(self.before, np.zeros(len(words), np.int64))
        self.first = np.empty(len(words), np.int32)
        self.first[by_word] = np.arange(len(words), dtype=np.int32)

    def extend(self, low: np.ndarray, other: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions of intervals by a word in front: (parent, word, low, other, size) of each.

        ``low`` is an interval's begin in this direction, ``other`` in the opposite one. Here an extension
        begins where its first occurrence maps to; there it lies in the parent's interval, behind the
        occurrences with a smaller word.
        """
        parent = np.repeat(np.arange(len(low)), size)
        inside = np.arange(len(parent)) - np.repeat(np.cumsum(size) - size, size)
        rows = low[parent] + inside
        slots, pairs = _sorted_slots(parent, self.before[rows])
        at = _starts(pairs)
        sizes = np.diff(np.append(at, len(pairs)))
        word = (pairs[at] & _LOW).astype(np.int64)
        parent = (pairs[at] >> np.uint64(_SLOT)).astype(np.int64)
        began = (np.cumsum(size) - size)[parent]
        keep = word > 0
        found = parent, word, self.first[rows[slots[at]]], other[parent] + at - began, sizes
        return tuple(part[keep] for part in found)


@dataclass(frozen=True)
class Phrases:
    """Phrases of one length: their intervals in both directions, their sizes and, a row each, their words."""

    forward: np.ndarray
    backward: np.ndarray
    size: np.ndarray
    words: np.ndarray


class BidirectionalIndex:
    """FM-index of a text of word ids (1 and more; 0 separates pieces) and of the text read backwards.

    Both are sorted by ``depth`` words only. For phrases of at most that many words, backward search
    gives the same intervals as with fully sorted suffixes: an extension's begin depends on how many
    rows lie before its parent's interval, and not on their order.
    """

    def __init__(self, words: np.ndarray, depth: int):
        if len(words) > MOST_WORDS:
            raise ValueError("the shard is too large")
        # a separator at either end, so that every word lies before some row of each direction
        words = np.concatenate(([0], np.asarray(words, np.int64), [0]))
        self.depth = depth
        self.ahead, self.back = _Direction(words, depth), _Direction(words[::-1].copy(), depth)
        self.counts = np.bincount(words, minlength=1)

    def single(self) -> Phrases:
        """The words that occur, as phrases of one."""
        low = np.cumsum(self.counts) - self.counts
        present = np.flatnonzero(self.counts)
        present = present[present > 0]
        return Phrases(low[present], low[present], self.counts[present], present[:, None].astype(np.int32))

    def extend_left(self, phrases: Phrases) -> Phrases:
        """Every phrase with one more word in front that occurs."""
        parent, word, forward, backward, size = self.ahead.extend(phrases.forward, phrases.backward, phrases.size)
        return Phrases(forward, backward, size, np.column_stack((word.astype(np.int32), phrases.words[parent])))

    def extend_right(self, phrases: Phrases) -> Phrases:
        """Every phrase with one more word behind that occurs."""
        parent, word, backward, forward, size = self.back.extend(phrases.backward, phrases.forward, phrases.size)
        return Phrases(forward, backward, size, np.column_stack((phrases.words[parent], word.astype(np.int32))))

    def phrases(self, least: int = 1) -> Iterator[Phrases]:
        """All phrases of ``least`` to ``depth`` words, length by length, grown on the right and on the left in turn."""
        found = self.single()
        for m in range(1, self.depth + 1):
            if m > 1:
                found = self.extend_left(found) if m % 2 else self.extend_right(found)
            if m >= least:
                yield found
