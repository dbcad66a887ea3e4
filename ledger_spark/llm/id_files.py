"""Token ids in binary files: Huffman-coded blocks with checkpoints, in the order of the documents.

A file, all numbers little-endian but for the coded words (big-endian, so that bits run on):

    "IDBLOCK1"
    code lengths   u32 symbols, u32 packed size, zlib of one byte a symbol
    blocks         u32 ids, u32 words, u32 checkpoints; u32 bit offset of every STEP-th id; the words
    directory      i64 id and u8 is-null and u64 ids of each document; u64 place of each block
    footer         u64 place of the directory, u64 documents, u64 blocks, u64 ids, "IDBLOCK1"

A block can be decoded without the others, and from each checkpoint without what lies before it.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import shared_folder
from .common import stage
from .huffman import Codebook, code_lengths
from .word_ids import LARGE, ids_of, text_slices, unit_ids

MAGIC = b"IDBLOCK1"
BLOCK_IDS = 1 << 16
STEP = 512
MAX_BITS = 18
_BLOCKS_A_STEP = 32

_IDS_DDL = "doc_id bigint, row bigint, n_tokens bigint, ids binary"
_IDS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.large_binary())])


def encode_texts(docs: DataFrame, tokenizer_path: str, *, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, row, n_tokens, ids): each text's ids and ``end_id``; ``row`` tells rows apart. A null text is an empty one.

    ``ids`` has two bytes an id where the vocabulary has fewer than 65,536, otherwise four, little-endian.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, row = unit_ids(tokenizer_path, LARGE[0]), TaskContext.get().partitionId() << 40
        width = units.width if end_id < 1 << 16 else 4
        for batch in batches:
            for part in text_slices(batch, 1, LARGE[1]):
                ids, sizes = ids_of(pc.fill_null(part.column(1), ""), units, end_id)
                offsets = np.concatenate(([0], np.cumsum(width * sizes))).astype(np.int64)
                data = ids.astype(f"<u{width}").tobytes()
                held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                rows = pa.array(np.arange(row, row + len(sizes)), pa.int64())
                row += len(sizes)
                yield pa.RecordBatch.from_arrays([part.column(0), rows, pa.array(sizes, pa.int64()), held], schema=_IDS)

    return docs.select(F.col(id_column).cast("bigint"), F.col(text_column).cast("string")).mapInArrow(run, _IDS_DDL)


def _numbers(value: pa.Scalar, n: int) -> np.ndarray:
    """The ``n`` numbers that a binary value holds."""
    data = value.as_buffer()
    return np.frombuffer(data, f"<u{data.size // max(1, n)}") if n else np.zeros(0, np.uint32)


def count_ids(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs: one number a symbol of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(0, np.int64)
        for batch in batches:
            for value, n_tokens in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(_numbers(value, n_tokens))
                if len(found) > len(totals):
                    totals, found = found, totals
                totals[: len(found)] += found
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(totals[seen], pa.int64())], ["id", "n"])

    rows = encoded.select("ids", "n_tokens").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 + max((r["id"] for r in rows), default=-1), np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


class _FileWriter:
    """One file: ids are added document by document and leave it in whole blocks."""

    def __init__(self, out, book: Codebook):
        self.out, self.book, self.held, self.n_held, self.n_ids = out, book, [], 0, 0
        self.places: list[int] = []
        self.at = 0
        lengths = zlib.compress(book.lengths.astype(np.uint8).tobytes())
        self._write(MAGIC + struct.pack("<II", len(book.lengths), len(lengths)) + lengths)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= BLOCK_IDS:
            ids = np.concatenate(self.held)
            whole = len(ids) // BLOCK_IDS * BLOCK_IDS
            for at in range(0, whole, BLOCK_IDS):
                self._block(ids[at : at + BLOCK_IDS])
            self.held, self.n_held = [ids[whole:].copy()], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        words, begins = self.book.pack(ids)
        marks = begins[::STEP].astype("<u4")
        self.places.append(self.at)
        self._write(struct.pack("<III", len(ids), len(words), len(marks)) + marks.tobytes() + words.astype(">u4").tobytes())

    def close(self, doc_ids: list[int | None], sizes: list[int]) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        place = self.at
        self._write(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + bytes(d is None for d in doc_ids))
        self._write(np.array(sizes, "<u8").tobytes() + np.array(self.places, "<u8").tobytes())
        self._write(struct.pack("<QQQQ", place, len(doc_ids), len(self.places), self.n_ids) + MAGIC)
        self.out.close()


def write_ids(encoded: DataFrame, *, folder: str | None = None, ids_per_file: int = 1 << 23, max_bits: int = MAX_BITS) -> DataFrame:
    """Write ``encoded`` (as ``encode_texts`` gives it) to files in ascending doc_id order; the manifest comes back.

    The manifest (file_no, path, n_docs, n_ids, start) is in the order of the ids, nulls first; rows of
    one id go by their length, then by ``row``. Files get a range of ids each, cut by sampled rows, so
    that equal ids, too, spread over many files. Every attempt of a task writes a file of its own and
    the manifest names those that counted. ``folder`` must be shared.
    """
    encoded = stage(encoded, "ids")
    counts = count_ids(encoded)
    lengths = code_lengths(counts, max(max_bits, int(np.count_nonzero(counts)).bit_length()))
    folder = folder or f"{shared_folder(encoded.sparkSession)}/ids-{uuid.uuid4()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, writer, doc_ids, sizes = TaskContext.get(), None, [], []
        for batch in batches:
            if writer is None and batch.num_rows:
                files, root = fs.FileSystem.from_uri(folder)
                files.create_dir(root, recursive=True)
                name = f"ids-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
                writer = _FileWriter(files.open_output_stream(f"{root}/{name}", compression=None), Codebook(lengths))
            doc_ids += batch.column(0).to_pylist()
            for value, n_tokens in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                sizes.append(n_tokens)
                writer.add(_numbers(value, n_tokens))
        if writer is not None:
            writer.close(doc_ids, sizes)
            row = (task.partitionId(), f"{folder}/{name}", len(sizes), writer.n_ids)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                                             ["file_no", "path", "n_docs", "n_ids"])

    order = [F.col("doc_id").asc_nulls_first(), "n_tokens", "row"]
    files = max(1, -(-int(counts.sum()) // ids_per_file))
    ranged = encoded.repartitionByRange(files, *order).sortWithinPartitions(*order)
    manifest = stage(ranged.select("doc_id", "ids", "n_tokens").mapInArrow(run, "file_no bigint, path string, n_docs bigint, n_ids bigint"), "manifest")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("bigint"))


class IdFile:
    """A file for reading: its directory, all ids in order, or those of a range."""

    def __init__(self, path: str):
        files, at = fs.FileSystem.from_uri(path)
        self.source = files.open_input_file(at)
        tail = 32 + len(MAGIC)
        end = self.source.size()
        footer = self.source.read_at(tail, end - tail)
        head = self.source.read_at(16, 0)
        if footer[32:] != MAGIC or head[:8] != MAGIC:
            raise ValueError(f"{path} is no file of ids")
        place, n_docs, n_blocks, self.n_ids = struct.unpack("<QQQQ", footer[:32])
        symbols, packed = struct.unpack("<II", head[8:])
        lengths = np.frombuffer(zlib.decompress(self.source.read_at(packed, 16)), np.uint8)
        if len(lengths) != symbols:
            raise ValueError(f"the code lengths of {path} are damaged")
        self.book = Codebook(lengths)
        directory = self.source.read_at(end - tail - place, place)
        nulls = np.frombuffer(directory, np.uint8, n_docs, 8 * n_docs)
        self.doc_ids = [None if null else d for d, null in zip(np.frombuffer(directory, "<i8", n_docs).tolist(), nulls.tolist(), strict=True)]
        self.sizes = np.frombuffer(directory, "<u8", n_docs, 9 * n_docs).astype(np.int64)
        self.places = np.append(np.frombuffer(directory, "<u8", n_blocks, 17 * n_docs).astype(np.int64), place)

    def __enter__(self) -> IdFile:
        return self

    def __exit__(self, *_) -> None:
        self.source.close()

    def _decode(self, first: int, last: int, skip: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids of blocks ``first`` up to ``last``; of one block only the sections that hold ids from ``skip`` up to ``stop``."""
        base = int(self.places[first])
        data = self.source.read_at(int(self.places[last]) - base, base)
        words, begins, sizes, bit = [], [], [], 0
        for at in self.places[first:last] - base:
            n_ids, n_words, n_marks = struct.unpack_from("<III", data, at)
            marks = np.frombuffer(data, "<u4", n_marks, at + 12).astype(np.int64)
            size = np.minimum(STEP, n_ids - STEP * np.arange(n_marks))
            wanted = slice(skip // STEP, None if stop is None else -(-stop // STEP))
            words.append(np.frombuffer(data, ">u4", n_words, at + 12 + 4 * n_marks))
            begins.append(marks[wanted] + bit)
            sizes.append(size[wanted])
            bit += 32 * n_words
        return self.book.unpack(np.concatenate(words), np.concatenate(begins), np.concatenate(sizes))

    def all_ids(self) -> Iterator[np.ndarray]:
        """All ids in order, some blocks at a time."""
        for first in range(0, len(self.places) - 1, _BLOCKS_A_STEP):
            yield self._decode(first, min(first + _BLOCKS_A_STEP, len(self.places) - 1))

    def ids_between(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` up to ``stop`` of the file; decodes only sections that hold some of them."""
        parts = [np.zeros(0, np.uint32)]
        for block in range(start // BLOCK_IDS, -(-min(stop, self.n_ids) // BLOCK_IDS)):
            low, high = max(0, start - block * BLOCK_IDS), min(BLOCK_IDS, stop - block * BLOCK_IDS)
            found = self._decode(block, block + 1, low, high)
            from_ = low // STEP * STEP
            parts.append(found[low - from_ : high - from_])
        return np.concatenate(parts)


def _documents(path: str) -> Iterator[tuple[int | None, int, int, int]]:
    """(doc_id, start in the file, ids, crc32 of the ids) of each document of a file."""
    with IdFile(path) as file:
        at, crc, missing, start = 0, 0, int(file.sizes[0]) if len(file.sizes) else 0, 0
        for ids in file.all_ids():
            data, used = memoryview(ids.astype("<u4").tobytes()), 0
            while used < len(ids):
                take = min(missing, len(ids) - used)
                crc = zlib.crc32(data[4 * used : 4 * (used + take)], crc)
                used, missing = used + take, missing - take
                if missing == 0:
                    size = int(file.sizes[at])
                    yield file.doc_ids[at], start, size, crc
                    at, crc, start = at + 1, 0, start + size
                    missing = int(file.sizes[at]) if at < len(file.sizes) else 0
        if at != len(file.sizes) or start != file.n_ids:
            raise ValueError(f"{path} does not hold the ids that its directory names")


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files a manifest names; a file is a task's share.

    A task holds some blocks and a file's directory, however long a document is.
    """
    names = ("doc_id", "start", "n_tokens", "ids_crc32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for doc_id, start, size, crc in _documents(path):
                    rows.append((doc_id, base + start, size, crc))
                    if len(rows) == 50_000:
                        yield _batch(rows, names)
                        rows = []
                if rows:
                    yield _batch(rows, names)

    paths = stage(manifest.select("path", "start"), "starts")
    spread = paths.repartition(max(1, paths.count()))
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], list(names))


def id_file_report(docs: DataFrame, tokenizer_path: str, *, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Encode all texts, write them to files and read the files back: one row per document row.

    A null or empty text has its end id only. Rows with equal id and text are interchangeable, a null id
    comes before all others, extra columns are not read, and an empty table gives an empty result.
    """
    return read_documents(write_ids(encode_texts(docs, tokenizer_path, end_id=end_id), folder=folder))
