"""Near-duplicate documents by b-bit MinHash, confirmed on the full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .components import connected_components
from .shingles import Hasher, mix, odd_numbers

BANDS, ROWS, BITS = 32, 4, 2
MINIMA = BANDS * ROWS
LONGS = MINIMA * BITS // 64
WIDE_MINIMA = 1024  # of the members of mixed buckets
WIDE_LONGS = WIDE_MINIMA * BITS // 64
_SCREEN_SIGMAS = 4.5
_BLOCK_ROWS = 512  # members of a bucket compared at once
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _describe(words: int):
    """Batches (id, text) to (id, size of the set, digest of the set, packed low bits, band keys)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, a = Hasher(words), odd_numbers(MINIMA, 11)
        fold, second = odd_numbers(ROWS, 13), np.uint64(0xD6E8FEB86659FD93)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = list(hasher.sets(part.column(1).to_pylist()))
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                low = np.zeros((len(sets), LONGS), np.uint64)
                keys = np.zeros((len(sets), BANDS), np.uint64)
                digest = np.zeros((len(sets), 2), np.uint64)
                if len(full):
                    x = np.concatenate([sets[i] for i in full])
                    cuts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                    minima = np.empty((len(full), MINIMA), np.uint64)
                    for i in range(MINIMA):
                        minima[:, i] = np.minimum.reduceat(x * a[i], cuts)
                    bits = (minima >> np.uint64(24)) & np.uint64((1 << BITS) - 1)
                    per = 64 // BITS
                    shift = (np.arange(per) * BITS).astype(np.uint64)
                    low[full] = np.bitwise_or.reduce(bits.reshape(len(full), LONGS, per) << shift, axis=2)
                    banded = (minima.reshape(len(full), BANDS, ROWS) * fold).sum(axis=2, dtype=np.uint64)
                    keys[full] = mix(banded + np.arange(1, BANDS + 1, dtype=np.uint64) * second)
                    digest[full, 0] = np.add.reduceat(mix(x + second), cuts)
                    digest[full, 1] = np.add.reduceat(mix(x ^ second), cuts)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), _signed(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), _signed(digest[:, 0].copy()), _signed(digest[:, 1].copy()),
                     *[_signed(low[:, i].copy()) for i in range(LONGS)], lists],
                    ["id", "n", "k1", "k2", *[f"s{i}" for i in range(LONGS)], "bands"],
                )

    return run


def _widen(words: int):
    """Batches (id, component, text, bands) to (id, component, packed bits of 1024 minima and the band keys as one string of bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, a = Hasher(words), odd_numbers(WIDE_MINIMA, 17)
        shift = (np.arange(64 // BITS) * BITS).astype(np.uint64)
        for batch in batches:
            packed = []
            for x, bands in zip(hasher.sets(batch.column(2).to_pylist()), batch.column(3).to_pylist(), strict=True):
                minima = np.array([(x * m).min() for m in a])
                low = ((minima >> np.uint64(24)) & np.uint64((1 << BITS) - 1)).reshape(WIDE_LONGS, -1) << shift
                packed.append(np.bitwise_or.reduce(low, axis=1).tobytes() + np.array(bands, np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["id", "component", "wide"])

    return run


def _compare_blocks(enough: int):
    """Batches (key, loose members, other members) to the pairs that may be similar enough, each from its first shared band.

    Members are (id, component, is_center, wide). Work is one block against one block, row by row of the first.
    """

    def columns(block: list[dict]) -> tuple[np.ndarray, ...]:
        wide = np.frombuffer(b"".join(m["wide"] for m in block), np.uint64).reshape(len(block), WIDE_LONGS + BANDS)
        ids, component = (np.array([m[c] for m in block], np.int64) for c in ("id", "component"))
        return ids, component, np.array([m["is_center"] for m in block], bool), wide[:, :WIDE_LONGS], wide[:, WIDE_LONGS:].view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd_bits = np.uint64(0x5555555555555555)
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                ids, parts, _, lows, bands = columns(one["loose"])
                other_ids, other_parts, centers, other_lows, other_bands = columns(one["others"])
                first = np.argmax(bands == one["key"], axis=1)
                found_a, found_b = [], []
                for i in range(len(ids)):
                    to = np.flatnonzero((other_parts != parts[i]) & ~centers)
                    d = other_lows[to] ^ lows[i]
                    equal = WIDE_MINIMA - np.bitwise_count((d | (d >> np.uint64(1))) & odd_bits).sum(axis=1, dtype=np.int64)
                    to = to[equal >= enough]
                    to = to[~(other_bands[to, : first[i]] == bands[i, : first[i]]).any(axis=1)]
                    found_a.append(np.minimum(other_ids[to], ids[i]))
                    found_b.append(np.maximum(other_ids[to], ids[i]))
                if found_a:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], schema=_LINK)

    return run


def _confirm(words: int, percent: int):
    """Batches (a, b, text of a, text of b) to the pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                left, right = hasher.sets(part.column(2).to_pylist()), hasher.sets(part.column(3).to_pylist())
                kept = []
                for x, y in zip(left, right, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    kept.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], schema=_LINK).filter(pa.array(kept, pa.bool_()))

    return run


def _equal_minima(x: str, y: str) -> Column:
    """How many of the packed minima agree."""
    differing = F.lit(0)
    for i in range(LONGS):
        d = F.col(f"{x}.s{i}").bitwiseXOR(F.col(f"{y}.s{i}"))
        differing = differing + F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return F.lit(MINIMA) - differing


def _least_equal(percent: int, minima: int = MINIMA) -> int:
    """Fewest equal low bits that a pair at the limit may show: expected value with chance collisions, less 4.5 deviations."""
    similarity = percent / 100
    p = similarity + (1 - similarity) / 2**BITS
    return int(minima * p - _SCREEN_SIGMAS * (minima * p * (1 - p)) ** 0.5)


def near_duplicates(
    docs: DataFrame, *, words: int = 4, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per id, the smallest id of a component is kept.

    Texts with equal shingle sets form a class, known by its smallest id. Each class keeps 128 minima,
    of which bands of four give candidate buckets (a pair at 0.8 misses all 32 with a chance of 5e-8)
    and two low bits each a packed signature. In a bucket every member is paired with the smallest id
    first; pairs pass a count of equal low bits, corrected for chance collisions, and then a comparison
    of the full sets. What that leaves in different components of a bucket is compared block by block of
    512 members through signatures of 1024 minima, each pair in its first shared band, so no link is lost
    while large groups of copies stay linear.

    A text without words (null, empty) has an empty set and no links. Repeated rows count as one
    document. Rows with a null id are returned as one row, unlinked and kept. An empty table gives an
    empty result. Other columns are not read.
    """
    sig = [f"s{i}" for i in range(LONGS)]
    ddl = "id bigint, n bigint, k1 bigint, k2 bigint, " + ", ".join(f"{s} bigint" for s in sig) + ", bands array<bigint>"
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    seen = stage(rows.mapInArrow(_describe(words), ddl), "described")
    full = seen.filter("n > 0 AND id IS NOT NULL")

    classes = stage(full.groupBy("k1", "k2").agg(F.min("id").alias("rep")), "classes")
    reps = full.join(classes.withColumnRenamed("rep", "id"), ["k1", "k2", "id"]).dropDuplicates(["k1", "k2"])
    buckets = reps.select(F.col("id"), "k1", *sig, F.explode("bands").alias("key"))
    centers = buckets.groupBy("key").agg(F.min("id").alias("center"), F.count("*").alias("n")).filter("n > 1").drop("n")
    members = stage(buckets.join(centers, "key"), "members").drop("k1")

    sides = members.select("id", *sig).dropDuplicates(["id"])
    texts = stage(rows.join(sides.select("id"), "id").dropDuplicates(["id"]), "texts")

    def links(pairs: DataFrame) -> DataFrame:
        """Confirmed pairs; each round is written."""
        both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
        return stage(both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(words, percent), "a bigint, b bigint"), "links")

    enough = _least_equal(percent)
    stars = members.filter("id != center").select("id", "center", *sig).distinct().alias("x")
    stars = stars.join(sides.withColumnRenamed("id", "center").alias("y"), "center").filter(_equal_minima("x", "y") >= enough)
    found = links(stars.select(F.col("center").alias("a"), F.col("id").alias("b")))
    component = connected_components(found)

    labelled = members.join(component.withColumnRenamed("node", "id"), "id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "id"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select("key")
    rest = stage(labelled.join(mixed, "key", "left_semi").select("key", "id", "center", "component"), "rest")
    # members that share the component of the bucket's center have no link to add among themselves
    own = rest.filter("id = center").select("key", F.col("component").alias("main"))
    sizes = rest.groupBy("key").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / _BLOCK_ROWS)
    placed = rest.join(own, "key").join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id"), blocks))

    distinct = rest.select("id", "component").distinct().join(reps.select("id", "bands"), "id").join(texts, "id")
    wide = stage(distinct.select("id", "component", "text", "bands").mapInArrow(_widen(words), "id bigint, component bigint, wide binary"), "wide")
    member = F.struct("id", "component", (F.col("id") == F.col("center")).alias("is_center"), "wide")
    filled = placed.drop("component").join(wide, "id").withColumn("member", member)
    others = filled.groupBy("key", "block").agg(F.collect_list("member").alias("others")).drop("block")
    loose = filled.filter("component != main").groupBy("key", "block").agg(F.collect_list("member").alias("loose")).drop("block")
    pairs = loose.join(others, "key").mapInArrow(_compare_blocks(_least_equal(percent, WIDE_MINIMA)), "a bigint, b bigint").distinct()
    component = stage(connected_components(found.unionByName(links(pairs))), "components")

    named = seen.join(classes, ["k1", "k2"], "left").join(component.withColumnRenamed("node", "rep"), "rep", "left")
    per_row = named.select("id", "n", F.coalesce("component", "rep", "id").alias("component"))
    out = per_row.groupBy("id").agg(F.max("n").alias("n_shingles"), F.min("component").alias("component_id"))
    return out.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id",
        (F.col("id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept"),
    )
