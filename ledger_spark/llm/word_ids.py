"""Token ids of texts, word by word, for vocabularies that drop white space."""

from __future__ import annotations

import functools
import itertools
import re
import string
import struct
import sys
import unicodedata
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

_UNIT_END = "</w>"
_UNITS_A_CALL = 2_000
#: Units that a worker's table holds, and text that is split at once: of little memory, and of little work.
SMALL, LARGE = (400_000, 4 << 20), (1_500_000, 16 << 20)
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII marks but the apostrophe, which contractions begin with


class UnitIds:
    """Ids of the units that words consist of, in one array; each unit is encoded once while the table holds it.

    The vocabulary drops white space and never joins over it, so a text has the ids of its words one
    after another. A run of letters or digits and the ASCII marks behind it are encoded apart as well:
    such a word is two units. The table has a fixed bound and starts anew beyond it.
    """

    def __init__(self, path: str, held: int):
        self.held = held
        self.tokenizer = Tokenizer.from_file(path)
        known = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.is_end = np.array([t.endswith(_UNIT_END) for t in known])
        self.width = 2 if len(known) < 1 << 16 else 4
        # case may go before the texts are split, but not where it tells a special token from plain text
        self.lowers = all(self._one(c) == self._one(c.lower()) for c in (string.ascii_uppercase, "Ab", "aB."))
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[str, int] = {"": 0}
        self.ids, self.starts, self.sizes, self.n_ids = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0

    def _one(self, unit: str) -> list[int]:
        return self.tokenizer.encode(unit, add_special_tokens=False).ids

    def _add(self, units: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """New units, their ids one after another, and where each one's ids end."""
        slot, need = len(self.slots), self.n_ids + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.n_ids], np.zeros(2 * need - self.n_ids, np.uint32)))
        if slot + len(units) > len(self.starts):
            room = np.zeros(2 * (slot + len(units)) - slot, np.int64)
            self.starts, self.sizes = np.concatenate((self.starts[:slot], room)), np.concatenate((self.sizes[:slot], room))
        self.ids[self.n_ids : need] = ids
        begins = np.concatenate(([0], ends[:-1]))
        self.starts[slot : slot + len(units)] = self.n_ids + begins
        self.sizes[slot : slot + len(units)] = ends - begins
        self.slots.update(zip(units, range(slot, slot + len(units)), strict=True))
        self.n_ids = need

    def _learn(self, units: list[str]) -> None:
        letters, others = [], []
        for unit in units:
            (letters if unit.isalpha() else others).append(unit)
        for at in range(0, len(letters), _UNITS_A_CALL):
            some = letters[at : at + _UNITS_A_CALL]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(some):
                self._add(some, ids, ends)
            else:  # a letter that the vocabulary cuts a word at
                others += some
        for at in range(0, len(others), _UNITS_A_CALL):
            some = others[at : at + _UNITS_A_CALL]
            each = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            self._add(some, np.array([i for ids in each for i in ids], np.uint32), np.cumsum([len(ids) for ids in each]))

    def find(self, units: list[str]) -> np.ndarray:
        """Slots of ``units``, which may be new."""
        found = np.fromiter(map(self.slots.get, units, itertools.repeat(-1)), np.int64, len(units))
        if len(new := np.flatnonzero(found < 0)):
            self._learn(list(dict.fromkeys(units[i] for i in new)))
            found[new] = np.fromiter((self.slots[units[i]] for i in new), np.int64, len(new))
        return found

    def of_words(self, words: list[str], special: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each has; ``special`` says that some may hold a special token."""
        if len(self.slots) + 2 * len(words) > self.held:
            self._clear()
        cores = [w.rstrip(_MARKS) for w in words]
        cores = [c if c and _stays_letter(c[-1]) else w for c, w in zip(cores, words, strict=True)]
        if special:
            cores = [w if any(t in w for t in self.specials) else c for c, w in zip(cores, words, strict=True)]
        marks = [w[len(c) :] for c, w in zip(cores, words, strict=True)]
        units = np.column_stack((self.find(cores), self.find(marks))).ravel()
        return _gather(self.ids, self.starts[units], self.sizes[units]), self.sizes[units].reshape(-1, 2).sum(axis=1)


@functools.cache
def _stays_letter(char: str) -> bool:
    """Whether the vocabulary's normal form of a letter or digit ends in a letter or digit, and not in a mark."""
    return unicodedata.normalize("NFC", char).lower()[-1].isalnum()


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[start : start + size]`` of each start and size, one after another."""
    total = np.cumsum(sizes)
    return values[np.repeat(starts - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)]


def unit_ids(path: str, held: int) -> UnitIds:
    """The table of this Python worker, which outlives a task."""
    kept = sys.modules.setdefault(f"{__name__}.kept", SimpleNamespace(of=None))
    if kept.of != (path, held):
        kept.of, kept.units = (path, held), UnitIds(path, held)
    return kept.units


def ids_of(texts: pa.Array, units: UnitIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``texts`` (no nulls) one after another, each with ``end_id``, and how many each text has.

    A text is split at ASCII white space; each distinct word is looked up once.
    """
    special = pc.match_substring_regex(texts, "|".join(map(re.escape, units.specials)) or r"\z\A.", ignore_case=True)
    if units.lowers:
        texts = pc.if_else(special, texts, pc.ascii_lower(texts))
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    flat, sizes = units.of_words(coded.dictionary.to_pylist(), bool(pc.any(special).as_py()))
    flat, sizes = np.append(flat, np.uint32(end_id)), np.append(sizes, 1)
    ends = split.offsets.to_numpy()[1:].astype(np.int64) - split.offsets[0].as_py()
    which = np.insert(coded.indices.to_numpy().astype(np.int64), ends, len(sizes) - 1)
    each = sizes[which]
    per_text = np.add.reduceat(each, np.concatenate(([0], ends[:-1] + np.arange(1, len(ends))))) if len(ends) else np.zeros(0, np.int64)
    return _gather(flat, (np.cumsum(sizes) - sizes)[which], each), per_text


def text_slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of about ``size`` bytes of the column."""
    part = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in itertools.pairwise(cuts):
        if b > a:
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()  # a worker outlives its task
