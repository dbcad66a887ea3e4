"""Packing of token pieces into fixed windows by minimum bin slack."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .word_ids import SMALL, ids_of, text_slices, unit_ids


def pieces_of(ids: memoryview, window: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces: whole windows, then the rest."""
    step = 4 * window
    for at in range(0, len(ids), step):
        piece = ids[at : at + step]
        yield at // 4, len(piece) // 4, zlib.crc32(piece)


def tokenize_pieces(
    docs: DataFrame, tokenizer_path: str, *, window: int = 4096, end_id: int = 2, id_column: str = "doc_id",
    text_column: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens[, ids]): each text's ids and ``end_id``, cut every ``window`` ids.

    A null text is an empty one and still has its ``end_id``. Whole texts are encoded.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    schema = pa.schema([*fields, ("ids", pa.binary())] if with_ids else fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = unit_ids(tokenizer_path, SMALL[0])
        for batch in batches:
            for part in text_slices(batch, 1, SMALL[1]):
                found, sizes = ids_of(pc.fill_null(part.column(1), ""), units, end_id)
                data, rows, at = memoryview(found.astype("<u4").tobytes()), [], 0
                for doc_id, size in zip(part.column(0).to_pylist(), sizes.tolist(), strict=True):
                    ids = data[4 * at : 4 * (at + size)]
                    at += size
                    for start, length, crc in pieces_of(ids, window):
                        rows.append((doc_id, start, length, crc, size, *([bytes(ids[4 * start : 4 * (start + length)])] if with_ids else [])))
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    ddl = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids binary" * with_ids
    return docs.select(id_column, F.col(text_column).cast("string")).mapInArrow(run, ddl)


def fill_windows(counts: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> how often) and how many windows take each, until all lengths are used up.

    Minimum bin slack: the longest remaining length opens a window, a bitset of reachable sums over
    the remaining lengths finds the filling closest to the capacity, and walking the bitsets back
    gives the counts. A pattern is used as long as its lengths last, so the work depends on the
    number of distinct lengths (at most ``window``), not on the number of pieces.
    """
    left = Counter({k: v for k, v in counts.items() if v > 0})
    plan: list[tuple[dict[int, int], int]] = []
    full = lambda room: (1 << (room + 1)) - 1
    while left:
        longest = max(left)
        room = window - longest
        left[longest] -= 1
        reach, trail = 1, []
        for length in sorted((k for k, v in left.items() if v and k <= room), reverse=True):
            before, copies, step = reach, min(left[length], room // length), 1
            while copies > 0:  # binary splitting: 1, 2, 4, ... copies at once
                take = min(step, copies)
                reach |= (reach << (take * length)) & full(room)
                copies, step = copies - take, 2 * step
            trail.append((length, before))
            if reach >> room & 1:
                break
        total, pattern = reach.bit_length() - 1, Counter({longest: 1})
        for length, before in reversed(trail):
            while not before >> total & 1:
                total -= length
                pattern[length] += 1
        left[longest] += 1
        times = min(left[k] // n for k, n in pattern.items())
        plan.append((dict(pattern), times))
        for k, n in pattern.items():
            left[k] -= n * times
        left = +left
    return plan


def _segments(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length rows (first rank, pieces a window, first sequence, offset of the first): where its ranks go."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for length in sorted(pattern, reverse=True):
            out.setdefault(length, []).append((used[length], pattern[length], sequence, offset))
            used[length] += pattern[length] * times
            offset += pattern[length] * length
        sequence += times
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(pieces: DataFrame, *, window: int = 4096, rows_per_block: int = 100_000) -> DataFrame:
    """``pieces`` (doc_id, start, length, ...; length from 1 to ``window``) with sequence_id and offset.

    The plan is made from the counts of each length, at most ``window`` numbers. A piece's rank among
    those of its length says where it goes: ranks are numbered within blocks of about
    ``rows_per_block`` pieces by a hash of the id, and running totals of the blocks make them global,
    so a length that most pieces share is never sorted in one task. Pieces with equal id and start
    (repeated rows) are interchangeable. No pieces give an empty result.
    """
    pieces = stage(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= window rows
    blocks = max(1, sum(counts.values()) // rows_per_block)
    segments = _segments(fill_windows(counts, window))
    placed_in = pieces.withColumn("_block", F.pmod(F.xxhash64("doc_id", "start"), F.lit(blocks)))
    per_block = placed_in.groupBy("_block", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_block.select("_block", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    order = Window.partitionBy("_block", "length").orderBy("doc_id", "start")
    ranked = placed_in.withColumn("_local", F.row_number().over(order)).join(bases, ["_block", "length"])
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_local") - 1).drop("_block", "_base", "_local")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            length, rank = rows["length"].to_numpy(), rows["_rank"].to_numpy()
            sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            for one in np.unique(length):
                at, table = np.flatnonzero(length == one), segments[int(one)]
                row = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1]
                nth = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + nth // row[:, 1]
                offset[at] = row[:, 3] + nth % row[:, 1] * one
            yield rows.drop(columns="_rank").assign(sequence_id=sequence, offset=offset)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.select(*pieces.columns, "_rank").mapInPandas(place, f"{ddl}, sequence_id bigint, offset bigint")
