"""Vectorised word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 20  # bytes hashed at once

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[ord("A") : ord("Z") + 1] += np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each number."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        p = np.full(n, base, np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


class Hasher:
    """Shingle hashes; keeps the tables of powers."""

    def __init__(self, words: int):
        self.k = words
        self.pw, self.ipw = powers(_BLOCK + 2)
        self.weights = odd_numbers(words + 1, 7)

    def _word_hashes(self, data: bytes) -> np.ndarray:
        """Hashes of the words of one buffer, in order, and their first bytes."""
        buf = np.frombuffer(data, np.uint8)
        edge = np.diff(np.concatenate(([0], _IS_WORD[buf].view(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LOWER[buf] * self.pw[: len(buf)], dtype=np.uint64)))
        return mix((sums[ends] - sums[starts]) * self.ipw[starts] + (ends - starts).astype(np.uint64)), starts

    def _long(self, data: bytes) -> np.ndarray:
        """Word hashes of one text longer than a block: cut between words, never inside one that fits."""
        out, at = [], 0
        while at < len(data):
            end = min(len(data), at + _BLOCK)
            if end < len(data):
                space = max(data.rfind(bytes([c]), at, end) for c in (0x20, *range(0x09, 0x0E)))
                end = space + 1 if space >= at else end
            out.append(self._word_hashes(data[at:end])[0])
            at = end
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def _shingles(self, words: np.ndarray) -> np.ndarray:
        n = len(words) - self.k + 1
        if n >= 1:
            total = words[:n] * self.weights[0]
            for j in range(1, self.k):
                total = total + words[j : j + n] * self.weights[j]
            return mix(total)
        if len(words) == 0:
            return words
        return mix(np.sum(words * self.weights[: len(words)], keepdims=True, dtype=np.uint64) + self.weights[self.k] * np.uint64(len(words)))

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The distinct shingles of each text, sorted; empty for a text without words."""
        at = 0
        while at < len(texts):
            group, size = [], 0
            while at < len(texts) and (not group or size + len(group[-1]) < _BLOCK // 4):
                group.append((texts[at] or "").encode("utf-8", "surrogatepass"))
                size, at = size + len(group[-1]) + 1, at + 1
            if size > _BLOCK:
                for data in group:
                    yield np.unique(self._shingles(self._long(data)))
                continue
            words, starts = self._word_hashes(b" ".join(group))
            bounds = np.searchsorted(starts, np.cumsum([0, *(len(g) + 1 for g in group)]))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield np.unique(self._shingles(words[a:b]))
