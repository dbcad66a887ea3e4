"""WARC archives written and read as a table of record chunks."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import shared_folder
from .common import stage

CHUNK = 16 * 1024
_FILE_BYTES = 64 << 20
_READ = 1 << 18
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

_MANIFEST = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64())])
_CHUNKS = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
    ("declared_bytes", pa.int64()), ("declared_digest", pa.string()), ("chunk_no", pa.int64()), ("is_last", pa.bool_()),
    ("bytes_so_far", pa.int64()), ("sha256_so_far", pa.string()), ("chunk", pa.binary()),
])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "bigint", pa.bool_(): "boolean", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_chunks(pages: DataFrame, *, least_bytes: int = 100) -> DataFrame:
    """One row per record and chunk: what the writer streams.

    The payload is the html in UTF-8 (null: empty). Of equal payloads of ``least_bytes`` or more the
    one with the smallest page_id is a response, the others revisit it and carry no payload. The cell
    of the source is whole; from there on a row holds one chunk, in joins and sorts as well.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", body.alias("body"))
    rows = rows.withColumns({"digest": F.sha2("body", 256), "n": F.octet_length("body").cast("bigint")})
    # narrow and aggregated before the shuffle; only payloads that do recur meet the pages again
    firsts = rows.filter(F.col("n") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    number = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("n") / CHUNK)).cast("int") - 1)).alias("chunk_no")
    cut = rows.select("row", "page_id", "url", "digest", "n", "body", number).withColumn("chunk", F.substring(F.col("body"), F.col("chunk_no") * CHUNK + 1, F.lit(CHUNK)))
    cut = cut.drop("body").join(firsts.filter("copies > 1").drop("copies"), "digest", "left")
    cut = cut.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).filter("refers_to IS NULL OR chunk_no = 0")
    # all chunks of a record have one digest and come from one task, so they lie in one partition
    return cut.sortWithinPartitions("row", "chunk_no").select(
        "page_id", "url", "refers_to", "n", "digest", "chunk_no", F.when(F.col("refers_to").isNull(), F.col("chunk")).otherwise(F.lit(b"")).alias("chunk")
    )


def _head(page_id: int | None, url: str | None, refers_to: int | None, n: int, digest: str) -> bytes:
    """WARC header and HTTP header; ``n`` is the length of the whole payload, present or not."""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {n}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_REVISIT}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(_HTTP) + (n if refers_to is None else 0)}", "", ""]
    return "\r\n".join(lines).encode() + _HTTP


def _writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Chunk rows, in order within a record, to archives; rows of the manifest come out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        task = TaskContext.get()
        out, number, at, began, squeeze = None, 0, 0, 0, None
        for batch in batches:
            done = []
            for page_id, url, refers_to, n, digest, chunk_no, chunk in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chunk_no == 0:
                    if out is None or at >= _FILE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{number:03d}.warc.gz"
                        out, number, at = files.open_output_stream(f"{root}/{name}", compression=None), number + 1, 0
                    began, squeeze = at, zlib.compressobj(3, zlib.DEFLATED, 31)
                    at += out.write(squeeze.compress(_head(page_id, url, refers_to, n, digest)))
                at += out.write(squeeze.compress(chunk))
                if refers_to is not None or (chunk_no + 1) * CHUNK >= n:
                    at += out.write(squeeze.compress(b"\r\n\r\n") + squeeze.flush())
                    done.append((f"{folder}/{name}", began, at - began, page_id))
            columns = zip(*done, strict=True) if done else [()] * len(_MANIFEST)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MANIFEST, strict=True)], schema=_MANIFEST)
        if out is not None:
            out.close()

    return run


def write_archives(chunks: DataFrame, folder: str | None = None) -> DataFrame:
    """Write gzip archives, a member per record, and return the manifest (path, offset, length, page_id).

    Each attempt of a task writes files of its own; the manifest is written by Spark and so names those
    of the attempts that counted. ``folder`` must be shared; by default it lies in the checkpoint folder.
    """
    folder = folder or f"{shared_folder(chunks.sparkSession)}/warc-{uuid.uuid4()}"
    return stage(chunks.mapInArrow(_writer(folder), _ddl(_MANIFEST)), "manifest")


class _Stream:
    """Bytes of a multi-member gzip file, unpacked as they are asked for."""

    def __init__(self, source):
        self.source, self.buffer, self.packed, self.unpack = source, bytearray(), b"", zlib.decompressobj(31)

    def more(self) -> bool:
        if self.unpack.eof:
            self.packed, self.unpack = self.unpack.unused_data or self.packed, zlib.decompressobj(31)
        if not self.packed:
            self.packed = self.source.read(_READ)
            if not self.packed:
                return False
        self.buffer += self.unpack.decompress(self.packed, _READ)
        self.packed = b"" if self.unpack.eof else self.unpack.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.buffer.find(mark)) < 0:
            if not self.more():
                if self.buffer:
                    raise ValueError("the archive ends inside a header")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        """Exactly ``n`` bytes."""
        while len(self.buffer) < n:
            if not self.more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def _page_of(urn: str | None) -> int | None:
    number = urn[len("<urn:page:") : -1] if urn else ""
    return int(number) if number else None


def _reader(with_payload: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def records(path: str) -> Iterator[tuple]:
        files, at = fs.FileSystem.from_uri(path)
        with files.open_input_stream(at, compression=None) as source:
            stream = _Stream(source)
            while (head := stream.until(b"\r\n\r\n")) is not None:
                named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)
                left = int(named["Content-Length"]) - len(stream.until(b"\r\n\r\n"))
                url = named.get("WARC-Target-URI")
                url = url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                fixed = (_page_of(named["WARC-Record-ID"]), named["WARC-Type"], _page_of(named.get("WARC-Refers-To")), url,
                         int(named["Payload-Length"]), named["WARC-Payload-Digest"].removeprefix("sha256:"))
                sha, total, number = hashlib.sha256(), 0, 0
                while True:
                    chunk = stream.take(min(CHUNK, left))
                    left, total = left - len(chunk), total + len(chunk)
                    sha.update(chunk)
                    yield (*fixed, number, left == 0, total, sha.hexdigest(), chunk if with_payload else None)
                    number += 1
                    if left == 0:
                        break
                if stream.take(4) != b"\r\n\r\n":
                    raise ValueError(f"a record of {path} does not end where it says")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                for row in records(path):
                    rows.append(row)
                    if len(rows) == 256:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CHUNKS, strict=True)], schema=_CHUNKS)


def read_archives(spark: SparkSession, manifest: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """The chunk table of the archives a manifest names: (page_id, chunk_no) rows of at most CHUNK bytes.

    Each row carries the bytes and the SHA-256 of the payload up to and with its chunk, so a record is
    checked while it streams and the row with ``is_last`` speaks for the whole. A task holds one chunk
    and a read buffer, however long a record is; each file is a task's share.
    """
    paths = manifest.select("path").distinct()
    return paths.repartition(max(1, paths.count())).mapInArrow(_reader(with_payload), _ddl(_CHUNKS))


def records(chunks: DataFrame) -> DataFrame:
    """One row per record, from the last chunk. A response whose payload does not match its header fails the job."""
    whole = chunks.filter("is_last")
    sound = (F.col("record_type") == "revisit") | (
        (F.col("bytes_so_far") == F.col("declared_bytes")) & (F.col("sha256_so_far") == F.col("declared_digest"))
    )
    digest = F.when(sound, F.col("declared_digest")).otherwise(F.raise_error(F.concat(F.lit("damaged record of page "), F.col("page_id").cast("string"))))
    return whole.select(
        "page_id", F.col("declared_bytes").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to", "url"
    )


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a record per page and read the archives back: one row per page row.

    A null html is an empty payload. Repeated rows of the first page are all responses; a row without
    page_id revisits a page with an equal payload if there is one. Extra columns are not read, and an
    empty table gives an empty result.
    """
    manifest = write_archives(record_chunks(pages), folder)
    return records(read_archives(pages.sparkSession, manifest, with_payload=False))
