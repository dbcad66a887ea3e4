"""Repeated passages: every byte covered by a long string that also starts elsewhere."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PRIVATE, stage
from .shingles import mix, powers
from .suffix_array import MOST_BYTES, common_prefixes, suffix_array

LENGTH = 400
GRAM = 100
_BLOCK = 1 << 20
_MOST_STARTS = 1024  # starts in a region
_SHARD_BYTES = 1 << 20
_REGIONS_A_SHARD = 1000  # of one anchor: more are split over shards and merged
_NO_ID = -(2**63)
_ID, _TK, _FOUND = PRIVATE + "id", PRIVATE + "tk", PRIVATE + "found"
_RUN = pa.schema([("fp", pa.int64()), ("rh", pa.int64()), ("n", pa.int32()), ("id", pa.int64()), ("tk", pa.int64()),
                  ("start", pa.int64()), ("occurs", pa.int32())])
_RUN_DDL = "fp bigint, rh bigint, n int, id bigint, tk bigint, start bigint, occurs int"


def _pack_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, key of the text, text) to (id, key, length, text compressed): what is shuffled of a text."""
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        data = [_bytes(t) for t in batch.column(2).to_pylist()]
        packed = pa.array([codec.compress(d, asbytes=True) for d in data], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(len, data), pa.int64()), packed], ["id", "tk", "size", "packed"])


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values) - width + 1
    pad = -len(values) % width
    rows = np.concatenate((values, np.full(pad, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


class _Anchors:
    """Splits the window starts of texts into regions that share an anchor.

    The anchor of a window of ``length`` bytes is its smallest hash over grams of ``gram`` bytes, which
    depends on the window's bytes alone: equal windows have equal anchors. A region is a run of starts
    with one anchor, of at most _MOST_STARTS.
    """

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.width = length, gram, length - gram + 1
        self.pw, self.ipw = powers(2 * _BLOCK)

    def regions(self, data: bytes, sizes: list[int]) -> list[tuple[int, int, int, int, int]]:
        """(fp, rh, n, first start in ``data``, occurrences of the anchor) for texts laid end to end."""
        buf = np.frombuffer(data, np.uint8)
        if len(buf) < self.length:
            return []
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * self.pw[: len(buf)], dtype=np.uint64)))
        grams = mix((sums[self.gram :] - sums[: -self.gram]) * self.ipw[: len(buf) - self.gram + 1])
        low = _window_minima(grams, self.width)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        inside = np.zeros(len(buf) + 1, np.int32)
        fits = ends - begins >= self.length
        np.add.at(inside, begins[fits], 1)
        np.add.at(inside, ends[fits] - self.length + 1, -1)
        at = np.flatnonzero(np.cumsum(inside[: len(low)]))
        if not len(at):
            return []
        values = low[at]
        first = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (values[1:] != values[:-1]))))
        counts = np.diff(np.append(first, len(at)))
        out = []
        for j, n, fp in zip(at[first].tolist(), counts.tolist(), values[first], strict=True):
            for a in range(0, n, _MOST_STARTS):
                k = min(_MOST_STARTS, n - a)
                b = j + a
                occurs = int(np.count_nonzero(grams[b : b + k - 1 + self.width] == fp)) if k > 1 or n > k else 1
                region = data[b : b + k - 1 + self.length]
                out.append((int(fp) - 2**63, xxhash.xxh3_64_intdigest(region) - 2**63, k, b, min(occurs, 2)))
        return out


def _texts_to_runs(length: int, gram: int):
    """Batches (id, key, text) to the regions of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _Anchors(length, gram)

        def emit(group: list[tuple[tuple[int, int], bytes]]) -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            if len(group) == 1 and len(group[0][1]) > _BLOCK:  # a long text, in blocks that overlap by a window
                doc, data = group[0]
                for at in range(0, len(data) - length + 1, _BLOCK):
                    block = data[at : at + _BLOCK + length - 1]
                    rows += [(fp, rh, n, *doc, at + b, o) for fp, rh, n, b, o in anchors.regions(block, [len(block)])]
            else:
                sizes = [len(d) for _, d in group]
                begins = np.cumsum([0, *sizes])
                found = anchors.regions(b"".join(d for _, d in group), sizes)
                owner = np.searchsorted(begins, np.array([r[3] for r in found], np.int64), side="right") - 1
                rows = [(fp, rh, n, *group[k][0], b - int(begins[k]), o) for (fp, rh, n, b, o), k in zip(found, owner.tolist(), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RUN, strict=True)], schema=_RUN)

        for batch in batches:
            group: list[tuple[tuple[int, int], bytes]] = []
            total = 0
            for id_, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = _bytes(text)
                if len(data) < length:
                    continue
                if group and total + len(data) > _BLOCK:
                    yield from emit(group)
                    group, total = [], 0
                group.append(((id_, key), data))
                total += len(data)
            if group:
                yield from emit(group)

    return run


def _cut_regions(length: int):
    """Batches (text packed, regions of it) to (fp, rh, n, copies, shard, bytes of the region)."""
    schema = pa.schema([("fp", pa.int64()), ("rh", pa.int64()), ("n", pa.int32()), ("copies", pa.int64()),
                        ("shard", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("region", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            rows: list[tuple] = []
            for i, size, packed, r in zip(range(batch.num_rows), *(c.to_pylist() for c in batch.columns), strict=True):
                data = codec.decompress(packed, size, asbytes=True)
                for x in r:
                    at = x["start"]
                    rows.append((x["fp"], x["rh"], x["n"], x["copies"], x["shard"], x["part"], x["parts"], data[at : at + x["n"] - 1 + length]))
                if len(rows) > 2000 or i + 1 == batch.num_rows:
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows = []

    return run


def _spans(flags: np.ndarray) -> list[int]:
    """First and one past the last position of each run of true values, in one list."""
    return np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))).tolist()


_OUT = "fp bigint, rh bigint, n int, spans array<int>, bucket int, keys binary, owners binary, counts binary"


def _search_shard(length: int):
    """The regions of a shard to the starts that are repeated in it, by its suffix array.

    Regions of an anchor that is split over shards also give their windows, sorted by a 64-bit key, to
    the merge: a window may recur only in another part.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("fp", kind="stable", ignore_index=True)  # windows of different anchors are never equal
        fps, ends = rows["fp"].to_numpy(), rows["region"].map(len).cumsum().to_numpy()
        last = np.append(np.flatnonzero(fps[1:] != fps[:-1]), len(rows) - 1)
        found, a, at = [], 0, 0
        for k, end in enumerate(last):
            if k + 1 == len(last) or ends[last[k + 1]] - at > MOST_BYTES:
                found.append(search(rows.iloc[a : end + 1].reset_index(drop=True)))
                a, at = end + 1, ends[end]
        return pd.concat(found)

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        texts = rows["region"].tolist()
        sizes = np.array([len(t) for t in texts], np.int64)
        text = np.frombuffer(b"".join(texts), np.uint8)
        begins = np.cumsum(sizes) - sizes
        sa = suffix_array(text)
        prefixes = common_prefixes(text, sa)
        is_start = np.zeros(len(text) + 1, np.int32)
        np.add.at(is_start, begins, 1)
        np.add.at(is_start, begins + rows["n"].to_numpy(), -1)
        is_start = np.cumsum(is_start[:-1]).astype(bool)
        owner = np.repeat(np.arange(len(texts)), sizes)
        group = np.cumsum(prefixes < length)  # suffixes that share ``length`` bytes
        mine = is_start[sa]
        at, group = sa[mine], group[mine]
        copies = rows["copies"].to_numpy()[owner[at]]
        total = np.bincount(group, weights=np.minimum(copies, 2), minlength=1)
        repeated = np.zeros(len(text), bool)
        repeated[at] = total[group] >= 2
        parts = rows["parts"].to_numpy()
        fp, rh, n = (rows[c].tolist() for c in ("fp", "rh", "n"))
        for k, (b, m) in enumerate(zip(begins.tolist(), n, strict=True)):
            out.append((fp[k], rh[k], m, _spans(repeated[b : b + m]), 0, b"", b"", b""))
        for one in set(np.array(fp)[parts > 1].tolist()):
            keys, owners, counts = [], [], []
            many = 1
            for k in [k for k, x in enumerate(fp) if x == one]:
                many = int(parts[k])
                for j in range(n[k]):
                    keys.append(xxhash.xxh3_64_intdigest(texts[k][j : j + length]))
                    owners.append((rh[k], n[k], j))
                    counts.append(2 if repeated[begins[k] + j] else 1)
            keys, owners, counts = np.array(keys, np.uint64), np.array(owners, np.int64), np.array(counts, np.int8)
            for bucket in range(many):
                some = np.flatnonzero(keys % np.uint64(many) == bucket)
                some = some[np.argsort(keys[some], kind="stable")]
                out.append((one, 0, 0, [], bucket + 1, keys[some].tobytes(), owners[some].tobytes(), counts[some].tobytes()))
        return pd.DataFrame(out, columns=["fp", "rh", "n", "spans", "bucket", "keys", "owners", "counts"])

    return run


def _merge_parts(rows: pd.DataFrame) -> pd.DataFrame:
    """Sorted windows of one anchor and bucket from several shards to the starts repeated across them, by binary search."""
    lists = [np.frombuffer(k, np.uint64) for k in rows["keys"]]
    owners = [np.frombuffer(o, np.int64).reshape(-1, 3) for o in rows["owners"]]
    found: dict[tuple[int, int], list[int]] = {}
    distinct = [np.unique(k) for k in lists]
    everything = np.sort(np.concatenate(distinct))  # a key that several parts hold stands there several times
    for keys, whose in zip(lists, owners, strict=True):
        several = np.searchsorted(everything, keys, side="right") - np.searchsorted(everything, keys, side="left") > 1
        for rh, n, j in whose[several].tolist():
            found.setdefault((rh, n), []).append(j)
    fp = int(rows["fp"].iloc[0])
    out = []
    for (rh, n), starts in found.items():
        flags = np.zeros(n, bool)
        flags[starts] = True
        out.append((fp, rh, n, _spans(flags)))
    return pd.DataFrame(out, columns=["fp", "rh", "n", "spans"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, length, text compressed, found) to what is removed and the digest of the rest."""
    codec = pa.Codec("zstd")
    for batch in batches:
        rows = []
        for id_, size, packed, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = codec.decompress(packed, size, asbytes=True) if size else b""
            cuts = _covered(found)
            rows.append((id_, size, sum(b - a for a, b in cuts), len(cuts), hashlib.sha256(b"".join(_rest(data, cuts))).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _covered(found) -> list[tuple[int, int]]:
    """Disjoint byte ranges covered by the repeated windows of a text, in order."""
    if found is None:
        return []
    windows = sorted((r["start"] + a, r["start"] + b - 1 + r["length"]) for r in found for a, b in zip(r["spans"][::2], r["spans"][1::2], strict=True))
    cuts: list[tuple[int, int]] = []
    for a, b in windows:
        if cuts and a <= cuts[-1][1]:
            cuts[-1] = (cuts[-1][0], max(b, cuts[-1][1]))
        else:
            cuts.append((a, b))
    return cuts


def _rest(data: bytes, cuts: list[tuple[int, int]]) -> Iterator[bytes]:
    at = 0
    for a, b in cuts:
        yield data[at:a]
        at = b
    yield data[at:]


def _without(text: pd.Series, found: pd.Series) -> pd.Series:
    """Texts without the covered bytes; a character that a cut leaves in part goes as a whole."""
    def one(t, f):
        return t if f is None else b"".join(_rest(_bytes(t), _covered(f))).decode("utf-8", "ignore")

    return pd.Series([one(t, f) for t, f in zip(text, found, strict=True)])


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.coalesce(F.col(id_column).cast("bigint"), F.lit(_NO_ID)).alias("id"), F.xxhash64(text).alias("tk"), text.alias("text"))


def find_repeats(rows: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Repeated windows of the texts of ``rows`` (id, tk, text): (id, tk, found: array of (start, spans, length)).

    A window of ``length`` bytes is repeated when it also starts anywhere else. Equal windows share
    their anchor, so the regions around an anchor are all that can hold its repeats: anchors that occur
    once are dropped, equal regions are counted as one, and what is left is dealt to shards by anchor.
    Each shard builds its suffix array and common prefixes, where neighbours with ``length`` bytes in
    common are repeated. An anchor with very many different regions is split over shards; their sorted
    windows are then merged by binary search. A shard holds about a megabyte whatever the input.
    """
    packed = rows.mapInArrow(_pack_text, "id bigint, tk bigint, size bigint, packed binary")
    runs = stage(rows.mapInArrow(_texts_to_runs(length, gram), _RUN_DDL), "runs")
    shared = runs.groupBy("fp").agg(F.sum("occurs").alias("total")).filter("total > 1").select("fp")
    runs = stage(runs.join(shared, "fp", "left_semi").drop("occurs"), "shared-runs")
    regions = stage(
        runs.groupBy("fp", "rh", "n").agg(F.count("*").alias("copies"), F.min(F.struct("id", "tk", "start")).alias("at")), "regions"
    )
    crowded = regions.groupBy("fp").agg(F.count("*").alias("m")).filter(F.col("m") > _REGIONS_A_SHARD)
    size = regions.agg(F.coalesce(F.sum(F.col("n") + length - 1), F.lit(0))).first()[0]
    shards = max(1, size // _SHARD_BYTES)
    parts = F.coalesce(F.ceil(F.col("m") / _REGIONS_A_SHARD), F.lit(1)).cast("int")
    dealt = regions.join(crowded, "fp", "left").withColumn("parts", parts).withColumn("part", F.pmod("rh", F.col("parts")).cast("int"))
    shard = F.when(F.col("parts") > 1, F.lit(shards) + F.pmod(F.xxhash64("fp", "part"), F.lit(2**40))).otherwise(
        F.pmod(F.xxhash64("fp"), F.lit(shards))
    )
    wanted = dealt.withColumn("shard", shard).groupBy(F.col("at.id").alias("id"), F.col("at.tk").alias("tk")).agg(
        F.collect_list(F.struct("fp", "rh", "n", "copies", "shard", "part", "parts", F.col("at.start").alias("start"))).alias("wanted")
    )
    cut = packed.join(wanted, ["id", "tk"]).select("size", "packed", "wanted").mapInArrow(
        _cut_regions(length), "fp bigint, rh bigint, n int, copies bigint, shard bigint, part int, parts int, region binary"
    )
    searched = stage(cut.groupBy("shard").applyInPandas(_search_shard(length), _OUT), "searched")
    merged = searched.filter("bucket > 0").select("fp", "bucket", "keys", "owners").groupBy("fp", "bucket").applyInPandas(
        _merge_parts, "fp bigint, rh bigint, n int, spans array<int>"
    )
    spans = searched.filter("bucket = 0 AND size(spans) > 0").select("fp", "rh", "n", "spans").unionByName(merged)
    return runs.join(spans, ["fp", "rh", "n"]).groupBy("id", "tk").agg(F.collect_list(F.struct("start", "spans", F.lit(length).alias("length"))).alias("found"))


def repeats_digest(
    docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row.

    Texts are UTF-8 bytes, a null text is empty; matches lie within a row. Repeated rows repeat each
    other's text and lose all windows; rows with a null id take part. Texts shorter than ``length`` stay
    whole. Other columns are not read; an empty table gives an empty result.
    """
    rows = _keyed(docs, id_column, text_column)
    packed = rows.mapInArrow(_pack_text, "id bigint, tk bigint, size bigint, packed binary")
    out = packed.join(find_repeats(rows, length=length, gram=gram), ["id", "tk"], "left").select("id", "size", "packed", "found").mapInArrow(
        _digest, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))


def remove_repeats(
    docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with the repeated bytes cut from the text and all other columns unchanged.

    Where a cut falls inside a character, what is left of it goes too; a null text stays null.
    """
    keyed = docs.withColumns({
        _ID: F.coalesce(F.col(id_column).cast("bigint"), F.lit(_NO_ID)), _TK: F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))),
    })
    found = find_repeats(_keyed(docs, id_column, text_column), length=length, gram=gram).toDF(_ID, _TK, _FOUND)
    cut = F.when(F.col(_FOUND).isNull(), F.col(text_column)).otherwise(F.pandas_udf(_without, "string")(F.col(text_column), F.col(_FOUND)))
    return keyed.join(found, [_ID, _TK], "left").withColumn(text_column, cut).select(*docs.columns)
