"""Canonical length-limited Huffman codes over numpy arrays of ids."""

from __future__ import annotations

import numpy as np


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits of each symbol's code, of which none is above ``limit`` (0 for a symbol that never occurs).

    Package-merge: level by level the cheapest pairs are packed together and merged with the symbols;
    what the cheapest 2n - 2 items of the last level contain says how long each code is.
    """
    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts > 0)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need more than {limit} bits")
    ranked = used[np.argsort(counts[used], kind="stable")]
    weights, packages, is_symbol = counts[ranked], np.zeros(0, np.int64), []
    for _ in range(limit):
        items = np.concatenate((weights, packages))
        order = np.argsort(items, kind="stable")
        items = items[order]
        is_symbol.append(order < len(weights))
        pairs = len(items) // 2
        packages = items[0 : 2 * pairs : 2] + items[1 : 2 * pairs : 2]
    take, bits = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for level in reversed(is_symbol):
        symbols = int(level[:take].sum())
        bits[:symbols] += 1
        take = 2 * (take - symbols)
    lengths[ranked] = bits
    return lengths


class Codebook:
    """Canonical codes for given lengths, highest bit first: shorter codes first, then smaller symbols."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, np.int64)
        self.bits = max(1, int(self.lengths.max(initial=0)))
        used = np.flatnonzero(self.lengths)
        ordered = used[np.lexsort((used, self.lengths[used]))]
        shares = np.left_shift(1, self.bits - self.lengths[ordered])
        first = np.cumsum(shares) - shares
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[ordered] = first >> (self.bits - self.lengths[ordered])
        #: The next ``bits`` bits of a stream say which symbol comes and how long its code is.
        self.symbol_at = np.zeros(1 << self.bits, np.uint32)
        self.length_at = np.ones(1 << self.bits, np.int64)
        end = int(shares.sum())
        self.symbol_at[:end] = np.repeat(ordered, shares)
        self.length_at[:end] = np.repeat(self.lengths[ordered], shares)

    def pack(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """32-bit words of the codes of ``ids`` one after another, and the bit at which each id begins."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        begins = ends - lengths
        words = np.zeros((int(ends[-1]) + 31) // 32 + 1 if len(ids) else 0, np.uint64)
        if len(ids):
            at = begins >> 5
            shift = (64 - lengths - (begins & 31)).astype(np.uint64)
            window = self.codes[ids] << shift
            starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            # codes that begin in one word fill disjoint bits of it and of the next
            words[at[starts]] = np.add.reduceat(window >> np.uint64(32), starts)
            words[at[starts] + 1] += np.add.reduceat(window & np.uint64(0xFFFFFFFF), starts)
        return words.astype(np.uint32), begins

    def unpack(self, words: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ids of sections one after another: section i has ``sizes[i]`` ids and begins at bit ``begins[i]`` of ``words``.

        All sections advance together, one id a step.
        """
        wide = np.zeros(len(words) + 1, np.uint64)
        wide[:-1] = words
        pair = (wide << np.uint64(32)) | np.append(wide[1:], np.uint64(0))
        order = np.argsort(-sizes, kind="stable")
        first = (np.cumsum(sizes) - sizes)[order]
        bit, left = begins[order].astype(np.int64), sizes[order]
        out = np.empty(int(sizes.sum()), np.uint32)
        down = np.uint64(64 - self.bits)
        live = len(order)
        for step in range(int(left[0]) if live else 0):
            while left[live - 1] <= step:
                live -= 1
            at = bit[:live]
            index = (pair[at >> 5] << (at & 31).astype(np.uint64)) >> down
            out[first[:live] + step] = self.symbol_at[index]
            bit[:live] = at + self.length_at[index]
        return out
