"""SentencePiece encoding and decoding of whole texts, unit by unit."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
HELD = 200_000  # units that a task's table holds; it starts anew beyond that
_SHORT = 64  # characters of a unit that is joined by scanning, and kept
_UNIT = f"\\n|{MARK}+[^{MARK}\\n]*|[^{MARK}\\n]+"
_NONE = float("inf")

#: Fixed values of the model format: field numbers and kinds.
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
_UNIGRAM, _BPE = 1, 2


@dataclass(frozen=True)
class PieceTable:
    """The pieces of a model file, and whether it joins by score (BPE) or by the best path (unigram)."""

    pieces: tuple[tuple[int, str, float, int], ...]  # id, piece, score, kind
    kind: int

    @property
    def first_byte(self) -> int:
        return next(i for i, p, _, k in self.pieces if k == _BYTE and p == "<0x00>")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size


def read_model(data: bytes) -> PieceTable:
    """The piece table of a model file's bytes."""
    pieces, kind = [], _UNIGRAM
    for number, value in _fields(data):
        if number == 1:
            f = dict(_fields(value))
            pieces.append((len(pieces), f[1].decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, _NORMAL)))
        elif number == 2:
            kind = dict(_fields(value)).get(3, _UNIGRAM)
    return PieceTable(tuple(pieces), kind)


class _Segmenter:
    """Ids of units, as the model's rule cuts them: joined by score (BPE) or along the best path (unigram)."""

    def __init__(self, table: PieceTable):
        known = [(p, i, -float(s)) for i, p, s, k in table.pieces if k in (_NORMAL, _USER)]
        self.ids, self.costs = {p: i for p, i, _ in known}, {p: c for p, _, c in known}
        self.first_byte = table.first_byte
        self.longest = max(len(p) for p in self.ids)
        self.cut = self._path if table.kind != _BPE else self._joined

    def __call__(self, unit: str) -> bytes:
        out: list[int] = []
        for part in self.cut(unit):
            found = self.ids.get(part)
            if found is None:  # a character without a piece goes as its bytes
                out += [self.first_byte + byte for byte in part.encode()]
            else:
                out.append(found)
        return struct.pack(f"<{len(out)}i", *out)

    def _joined(self, unit: str) -> list[str]:
        """Parts after joining neighbours by the least cost, leftmost first, until none fits."""
        if len(unit) > _SHORT:
            return self._joined_long(unit)
        get, parts = self.costs.get, list(unit)
        costs = [get(a + b, _NONE) for a, b in pairwise(parts)]
        while costs:
            least = min(costs)
            if least == _NONE:
                break
            k = costs.index(least)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del costs[k]
            if k < len(costs):
                costs[k] = get(parts[k] + parts[k + 1], _NONE)
            if k:
                costs[k - 1] = get(parts[k - 1] + parts[k], _NONE)
        return parts

    def _joined_long(self, unit: str) -> list[str]:
        """The same with a heap of pairs, for units of any length; a part is known by where it begins."""
        n, get = len(unit), self.costs.get
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(c, a, a + 2) for a in range(n - 1) if (c := get(unit[a : a + 2])) is not None]
        heapify(heap)
        gone = bytearray(n)
        while heap:
            _, a, end = heappop(heap)
            if gone[a] or ends[a] == n or ends[ends[a]] != end:
                continue  # one of the two was joined otherwise meanwhile
            gone[ends[a]], ends[a] = 1, end
            if end < n:
                before[end] = a
                if ends[end] - a <= self.longest and (c := get(unit[a : ends[end]])) is not None:
                    heappush(heap, (c, a, ends[end]))
            if a and end - before[a] <= self.longest and (c := get(unit[before[a] : end])) is not None:
                heappush(heap, (c, before[a], end))
        return [unit[a : ends[a]] for a in range(n) if not gone[a]]

    def _path(self, unit: str) -> list[str]:
        """The path of least cost through the lattice of pieces; a character without one costs more than any piece."""
        n, get = len(unit), self.costs.get
        edges = [[(a, c) for a in range(max(0, end - self.longest), end) if (c := get(unit[a:end])) is not None] for end in range(1, n + 1)]
        unknown = max((c for some in edges for _, c in some), default=0.0) + 10.0
        best, back = [0.0], [0]
        for end, some in enumerate(edges, 1):
            ways = [(best[a] + c, a) for a, c in some]
            if not some or some[-1][0] != end - 1:
                ways.append((best[end - 1] + unknown, end - 1))
            cost, a = min(ways)
            best.append(cost)
            back.append(a)
        cuts = [n]
        while cuts[-1]:
            cuts.append(back[cuts[-1]])
        return [unit[a:b] for a, b in pairwise(cuts[::-1])]


def _encode_texts(table: PieceTable):
    """Batches (doc_id, text_crc32, text) to (doc_id, text_crc32, ids). A task cuts each unit once while its table of units holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, find, known = _Segmenter(table), re.compile(_UNIT).findall, {}

        def ids_of(text: str | None) -> bytes:
            if not text:
                return b""
            units = find(MARK + text.replace(" ", MARK))
            found = [known.get(u) for u in units]
            if None in found:
                if len(known) > HELD:
                    known.clear()
                for i, u in enumerate(units):
                    if found[i] is None:
                        own = known.get(u)
                        if own is None:
                            own = segment(u)
                            if len(u) <= _SHORT:
                                known[u] = own
                        found[i] = own
            return b"".join(found)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = pa.array([ids_of(t) for t in part.column(2).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids], ["doc_id", "text_crc32", "ids"])

    return run


def encode(docs: DataFrame, table: PieceTable, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_crc32, ids: little-endian 32-bit ids as bytes) of each row; the checksum is that of the text that decoding should give.

    Texts are cut into units that no piece crosses: a run of spaces with the word behind it, or a line
    break. The tasks that read the texts cut the units, each distinct one once while a bounded table
    holds it; nothing is shuffled or written in between. Characters without a piece become the ids of
    their bytes. A null or empty text has no ids; whole texts are encoded, units of any length as one.
    Each row is encoded by itself, so repeated rows and null ids are as good as any; other columns are not read.
    """
    text = F.col(text_column)
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(" "))
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.crc32(plain.cast("binary")).alias("text_crc32"), text.alias("text"))
    return rows.mapInArrow(_encode_texts(table), "doc_id bigint, text_crc32 bigint, ids binary")


def _decoder(table: PieceTable):
    parts = [bytes([int(p[3:5], 16)]) if k == _BYTE else p.replace(MARK, " ").encode() if k in (_NORMAL, _USER) else b"" for _, p, _, k in table.pieces]

    def text_of(ids: bytes) -> bytes:
        return b"".join([parts[i] for i in np.frombuffer(ids, "<i4").tolist()]).removeprefix(b" ")

    return text_of


def decode(encoded: DataFrame, table: PieceTable) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): pieces end to end, bytes joined to characters, without the space before the text."""
    text_of = _decoder(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text_of(ids).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digest(encoded: DataFrame, table: PieceTable) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, round_trip: whether decoding gives the text back)."""
    text_of = _decoder(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(2).to_pylist()
            back = [zlib.crc32(text_of(i)) == crc for i, crc in zip(ids, batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array(back, pa.bool_())],
                ["doc_id", "n_ids", "ids_crc32", "round_trip"],
            )

    return encoded.mapInArrow(run, "doc_id bigint, n_ids bigint, ids_crc32 bigint, round_trip boolean")
