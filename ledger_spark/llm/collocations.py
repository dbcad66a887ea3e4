"""Phrases whose words occur together more often than apart, counted by FM-indexes over shards of word ids."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .fm_index import BidirectionalIndex

PIECE_END = r"[.,;:!?\x0A-\x0D]"
SPACES = r"[\x20\x09]+"
NO_LANGUAGE = "und"
_SHARD_WORDS = 500_000
_BLOCK_WORDS = 1_000_000  # one task sums a block of the phrases of a length, which are at most as many as words
_HELD_WORDS = 4 * _SHARD_WORDS
_ROWS_A_STEP = 512

_SHARDS = pa.schema([
    ("shard", pa.int64()), ("lang", pa.string()), ("sign", pa.int64()), ("n_words", pa.int64()), ("words", pa.list_(pa.string())),
    ("counts", pa.list_(pa.int64())), ("ids", pa.binary()),
])
_PACKED = pa.schema([("block", pa.int64()), ("shard", pa.int64()), ("words", pa.binary()), ("n", pa.binary())])
_PACKED_DDL = "block bigint, shard bigint, words binary, n binary"
_SHARDS_DDL = "shard bigint, lang string, sign bigint, n_words bigint, words array<string>, counts array<bigint>, ids binary"


class _Pieces:
    """Words of one language that wait for a shard: arrays of words, and at which of them a piece begins."""

    def __init__(self) -> None:
        self.words: list[pa.Array] = []
        self.begins: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: pa.Array) -> None:
        pieces = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=PIECE_END).flatten()
        split = pc.split_pattern_regex(pieces, pattern=SPACES)
        words, piece = split.flatten(), np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
        real = pc.not_equal(words, "")
        words, piece = words.filter(real), piece[real.to_numpy(zero_copy_only=False)]
        if len(words):
            self.words.append(words)
            self.begins.append(np.concatenate(([True], piece[1:] != piece[:-1])))
            self.size += len(words)

    def take(self) -> tuple[pa.Array, np.ndarray]:
        out = pa.concat_arrays(self.words), np.concatenate(self.begins)
        self.__init__()
        return out


def _shard_rows(words: pa.Array, begins: np.ndarray, overlap: int, shard_words: int) -> Iterator[tuple]:
    """(sign, n_words, words, counts, ids) of the shards of consecutive words.

    A shard ends at a piece's end if one lies in its last half. Otherwise the piece is cut: the first
    part goes on for ``overlap`` words more, and a shard with sign -1 takes back what both then count.
    """
    at, total = 0, len(words)
    while at < total:
        end, further = min(total, at + shard_words), 0
        if end < total and not begins[end]:
            ends = np.flatnonzero(begins[at + shard_words // 2 : end])
            if len(ends):
                end = at + shard_words // 2 + int(ends[-1])
            else:
                following = np.flatnonzero(begins[end : end + overlap])
                further = min(total - end, int(following[0]) if len(following) else overlap)
        yield _shard_row(1, words.slice(at, end + further - at), begins[at : end + further])
        if further:
            yield _shard_row(-1, words.slice(end, further), begins[end : end + further])
        at = end


def _shard_row(sign: int, words: pa.Array, begins: np.ndarray) -> tuple:
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64) + 1
    counts = np.bincount(ids, minlength=len(coded.dictionary) + 1)[1:]
    apart = np.insert(ids, np.flatnonzero(begins[1:]) + 1, 0)
    return sign, len(ids), coded.dictionary, counts, apart.astype("<i4").tobytes()


def shard_words(docs: DataFrame, *, max_words: int, text_column: str = "text", lang_column: str = "lang", shard_size: int = _SHARD_WORDS) -> DataFrame:
    """Shards of the documents' words: (shard, lang, sign, n_words, words, counts, ids).

    A shard holds words of one language that one task read, about ``shard_size`` at most. ``ids`` are
    numbers from 1 into ``words``, 0 between pieces, as 32-bit little-endian numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 20, {}

        def give(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for sign, n_words, words, counts, ids in _shard_rows(*held.pop(lang).take(), max_words - 1, shard_size):
                row = ([number], [lang], [sign], [n_words], [words], [counts], [ids])
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _SHARDS, strict=True)], schema=_SHARDS)
                number += 1

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_A_STEP):
                part = batch.slice(at, _ROWS_A_STEP)
                texts, langs = part.column(0), part.column(1)
                for lang in langs.unique():
                    held.setdefault(lang.as_py(), _Pieces()).add(texts.filter(pc.equal(langs, lang)))
                for lang in [k for k, p in held.items() if p.size >= shard_size]:
                    yield from give(lang)
                while sum(p.size for p in held.values()) > _HELD_WORDS:
                    yield from give(max(held, key=lambda k: held[k].size))
        for lang in list(held):
            if held[lang].size:
                yield from give(lang)

    columns = F.coalesce(F.col(text_column).cast("string"), F.lit("")), F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANGUAGE))
    return docs.select(*columns).mapInArrow(run, _SHARDS_DDL)


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers, best in rising order, in few bytes: steps, first all their highest bytes, then the next."""
    steps = np.diff(np.asarray(values, np.int64), prepend=0)
    return zlib.compress(steps.astype(">i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _expand(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1).T.copy().view(">i8").ravel().astype(np.int64))


def _bundle(columns: Iterable[np.ndarray]) -> bytes:
    """Columns of whole numbers as one value: Spark's Arrow writer takes much longer for every row that has a list of values."""
    parts = [_squeeze(c) for c in columns]
    return struct.pack(f"<{len(parts) + 1}I", len(parts), *map(len, parts)) + b"".join(parts)


def _columns(data: bytes) -> list[np.ndarray]:
    m = struct.unpack_from("<I", data)[0]
    ends = list(accumulate(struct.unpack_from(f"<{m}I", data, 4), initial=4 * (m + 1)))
    return [_expand(data[a:b]) for a, b in pairwise(ends)]


def _packed(phrases: np.ndarray, words: np.ndarray, counts: np.ndarray, shard: int, blocks: int) -> Iterator[tuple]:
    """Rows (block, shard, words, n) of one shard's ``phrases`` (rows of places in ``words``), all of one length.

    Where a phrase goes depends on its words alone, so a block meets all counts of its phrases.
    """
    m = phrases.shape[1]
    order = np.lexsort(phrases.T[:3][::-1])
    columns, counts = words[phrases[order].T], counts[order]
    mixed = np.zeros(len(order), np.uint64)
    for column in columns:
        mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    block = ((mixed >> np.uint64(20)) % np.uint64(blocks)).astype(np.int64)
    by_block = np.argsort(block, kind="stable")
    for some in np.split(by_block, np.flatnonzero(np.diff(block[by_block])) + 1):
        if len(some):
            yield int(block[some[0]]) + m * blocks, shard, _bundle(c[some] for c in columns), _squeeze(counts[some])


def _words_of(shard: pa.Table, listed: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The shard's text as places (from 1) in its list of frequent words, and that list in the order of the words' numbers."""
    ids = np.frombuffer(shard.column("ids")[0].as_py(), "<i4")
    listed = listed.sort_by("word")
    word_id = listed.column("word_id").to_numpy()
    place = np.zeros(int(max(ids.max(), word_id.max())) + 1, np.int64)
    place[word_id] = np.arange(1, len(word_id) + 1)
    return place[ids], listed.column("word").to_numpy()


def _count_pairs(blocks: int):
    def run(shard: pa.Table, listed: pa.Table) -> pa.Table:
        """Pairs of frequent words of one shard, and how often each occurs there."""
        rows: list[tuple] = []
        if shard.num_rows and listed.num_rows:
            text, words = _words_of(shard, listed)
            pairs = next(BidirectionalIndex(text, 2).phrases(least=2))
            sign = shard.column("sign")[0].as_py()
            rows += _packed(pairs.words - 1, words, sign * pairs.size, shard.column("shard")[0].as_py(), blocks)
        return _rows(rows)

    return run


def _sum_blocks(min_count: int, tell_shards: bool):
    def run(rows: pa.Table) -> pa.Table:
        """Sums a block of phrases over all shards: one row of those that are frequent and their sums, with shard -1.

        With ``tell_shards`` each shard also gets a row of those of its own that are frequent.
        """
        own = [(_columns(words), _expand(n)) for words, n in zip(rows.column("words").to_pylist(), rows.column("n").to_pylist(), strict=True)]
        columns = [np.concatenate(c) for c in zip(*(words for words, _ in own), strict=True)]
        own = [n for _, n in own]
        key = np.zeros(len(columns[0]), np.int64)
        for column in columns:
            _, rank = np.unique(column, return_inverse=True)
            _, key = np.unique((key << 32) | rank, return_inverse=True)
        sums = np.zeros(int(key.max()) + 1, np.int64)
        np.add.at(sums, key, np.concatenate(own))
        first = np.empty(len(sums), np.int64)
        first[key[::-1]] = np.arange(len(key))[::-1]
        enough = sums >= min_count
        out = [(None, -1, _bundle(c[first][enough] for c in columns), _squeeze(sums[enough]))]
        at = 0
        for shard, n in zip(rows.column("shard").to_pylist(), own, strict=True) if tell_shards else ():
            keep = np.flatnonzero(enough[key[at : at + len(n)]]) + at
            at += len(n)
            if len(keep):
                out.append((None, shard, _bundle(c[keep] for c in columns), None))
        return _rows(out)

    return run


def _rows(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(_PACKED)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _PACKED, strict=True)], schema=_PACKED)


def _phrase_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed phrases and sums as rows (phrase, f)."""
    for batch in batches:
        for row in batch.to_pylist():
            phrases = np.column_stack(_columns(row["words"]))
            n, m = phrases.shape
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * m + 1, m), pa.int32()), pa.array(phrases.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([lists, pa.array(_expand(row["n"]), pa.int64())], ["phrase", "f"])


def _keep_runs(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``ids`` without the words that are in no pair (a, b), and 0 wherever two neighbours are no such pair."""
    allowed = np.sort((a << 32) | b)
    key = (ids[:-1] << 32) | ids[1:]
    at = np.minimum(np.searchsorted(allowed, key), len(allowed) - 1)
    linked = np.concatenate(([False], allowed[at] == key, [False]))
    keep = linked[1:] | linked[:-1]
    cut = keep & ~linked[:-1]  # a run begins
    kept = ids[keep]
    return np.insert(kept, np.flatnonzero(cut[keep]), 0)


def _count_longer(max_words: int, blocks: int):
    def run(shard: pa.Table, lists: pa.Table) -> pa.Table:
        """Phrases of three words and more that consist of frequent pairs, and how often each occurs in the shard."""
        rows: list[tuple] = []
        pairs = lists.filter(pc.is_valid(lists.column("words"))).column("words").to_pylist()
        if shard.num_rows and pairs:
            text, words = _words_of(shard, lists.filter(pc.is_valid(lists.column("word"))))
            a, b = (np.searchsorted(words, np.concatenate(parts)) + 1 for parts in zip(*map(_columns, pairs), strict=True))
            sign = shard.column("sign")[0].as_py()
            for found in BidirectionalIndex(_keep_runs(text, a, b), max_words).phrases(least=3):
                rows += _packed(found.words - 1, words, sign * found.size, shard.column("shard")[0].as_py(), blocks)
        return _rows(rows)

    return run


def phrase_counts(docs: DataFrame, *, min_count: int = 100, max_words: int = 5, text_column: str = "text", lang_column: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, m, f) of all phrases of up to ``max_words`` words found ``min_count`` times, (lang, n) of all words).

    Every shard is counted on its own and the counts are summed. A phrase is frequent only if its words
    and its pairs of neighbours are, so words are summed first, then the pairs of frequent words, then
    what consists of frequent pairs; each shard is told which of its own words and pairs those are.
    """
    if max_words < 2:
        raise ValueError("a phrase has two words or more")
    shards = stage(shard_words(docs, max_words=max_words, text_column=text_column, lang_column=lang_column), "shards")
    total = shards.groupBy("lang").agg(F.sum(F.col("sign") * F.col("n_words")).alias("n"))
    blocks = max(1, -(-(shards.agg(F.sum("n_words")).first()[0] or 0) // _BLOCK_WORDS))
    enough = F.col("f") >= min_count

    entry = F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry")
    vocabulary = shards.select("shard", "lang", "sign", entry).select(
        F.col("shard").alias("of"), "lang", (F.col("place") + 1).alias("word_id"), F.col("entry.words").alias("text"),
        (F.col("sign") * F.col("entry.counts")).alias("n"), F.expr("shard << 20 | place").alias("own"),
    )
    # one shuffle sums the counts, names a word by its first place and keeps the shards' rows of what is frequent
    same = Window.partitionBy("lang", "text")
    listed = vocabulary.withColumns({"f": F.sum("n").over(same), "word": F.min("own").over(same)}).filter(enough)
    once = F.col("word") == F.col("own")
    listed = stage(listed.select("of", "word_id", "word", *[F.when(once, F.col(c)).alias(c) for c in ("lang", "text", "f")]), "words")
    words = listed.filter("text IS NOT NULL").select("word", "lang", "text", "f")
    texts = shards.select("shard", "sign", "ids").groupBy("shard")
    of_shard = listed.select("of", "word_id", "word")
    pairs = texts.cogroup(of_shard.groupBy("of")).applyInArrow(_count_pairs(blocks), _PACKED_DDL)
    pairs = stage(pairs.groupBy("block").applyInArrow(_sum_blocks(min_count, True), _PACKED_DDL), "pairs")
    lists = of_shard.unionByName(pairs.filter("shard >= 0").select(F.col("shard").alias("of"), "words"), allowMissingColumns=True)
    longer = texts.cogroup(lists.groupBy("of")).applyInArrow(_count_longer(max_words, blocks), _PACKED_DDL)
    longer = longer.groupBy("block").applyInArrow(_sum_blocks(min_count, False), _PACKED_DDL)
    summed = pairs.filter("shard < 0").select("words", "n").unionByName(longer.select("words", "n"))
    found = stage(summed.mapInArrow(_phrase_rows, "phrase array<bigint>, f bigint").withColumn("id", F.monotonically_increasing_id()), "phrases")
    named = found.select("id", "f", F.posexplode("phrase").alias("at", "word")).join(words.select("word", "lang", "text"), "word")
    spelled = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda w: w["text"]), " ")  # max_words at most
    named = named.groupBy("id").agg(F.first("lang").alias("lang"), spelled.alias("phrase"), F.count("*").cast("int").alias("m"), F.first("f").alias("f"))
    single = words.select("lang", F.col("text").alias("phrase"), F.lit(1).alias("m"), "f")
    return stage(single.unionByName(named.drop("id")), "counts"), total


def _part(phrase: Column, words: Column) -> Column:
    """The first words of a phrase, or the last ones where ``words`` is negative."""
    return F.call_function("substring_index", phrase, F.lit(" "), words.cast("int"))


def collocations(docs: DataFrame, *, min_count: int = 100, max_words: int = 5, top: int = 2000, covered_percent: int = 100,
                 text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split into pieces and words. a counts a phrase, l and r the two parts
    of its weakest cut, n all words of the language; score = floor(1000 * a * n / (l * r)), of which the
    lowest cut counts, the first of those as low. Phrases inside a longer one that is found in
    ``covered_percent`` of their places are left out. Ties go by count, then by the bytes of the phrase.

    A null text is empty, a null language is ``und``, repeated rows count as often as they stand there,
    extra columns are not read, and a table without frequent phrases gives an empty result.
    """
    counts, total = phrase_counts(docs, min_count=min_count, max_words=max_words, text_column=text_column, lang_column=lang_column)
    phrase, m = F.col("phrase"), F.col("m")
    candidates = counts.filter(m >= 2)
    # a phrase is found in the extension by one word at least as often as in a longer one around that
    around = candidates.filter(m >= 3).select("lang", "f", F.explode(F.array(_part(phrase, m - 1), _part(phrase, 1 - m))).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("widest"))
    kept = candidates.join(around, ["lang", "phrase"], "left").filter(
        F.col("widest").isNull() | (F.lit(100) * F.col("widest") < F.lit(covered_percent) * F.col("f"))
    )
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "m", F.explode(F.sequence(F.lit(1), m - 1)).alias("k"))
    cuts = cuts.withColumns({"first": _part(phrase, F.col("k")), "rest": _part(phrase, F.col("k") - m)})
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = lambda name: F.col(name).cast("decimal(18,0)")  # noqa: E731 - products of two have 36 digits
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(total, "lang").withColumn(
        "score", F.call_function("div", (F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n")).cast("decimal(38,0)"), wide("l") * wide("r"))
    )
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    rows = weakest.select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
