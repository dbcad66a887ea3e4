"""Lines that nearly repeat an earlier line, by an exact set-similarity join in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PRIVATE, stage

PERCENT = 80
_LEVEL_BITS = 4
_WORD_GROUPS = 1 << 18  # words are counted by so many groups of their codes
_ALL_RARE = 1 << 21  # up to so many words in all, the rarest level is of words that occur once
_CODE = 0x7FFFFFFF  # the part of a word's code that prefixes hold: words that share it only make more pairs to compare
_CROWDED = 64  # sets that share one of their rarest words: from here on the earliest of them is compared with the others first
_RAREST = 4  # words by which that is done: nearly all sets of a family of near copies share one of them
_SIZES = 64  # classes of sizes, each up to twice the one before
_LONG = 6  # from this class on (64 words) sets are told apart by 128 parity bits instead of 64
_BROADCAST_LINES = 1_000_000  # some 60 MB
_NO_ID = -(2**63)
_ID, _TK, _REMOVED = PRIVATE + "id", PRIVATE + "tk", PRIVATE + "removed"


def _key(id_column: str, text_column: str) -> tuple[Column, Column]:
    """What a document is known by: its id and a key of its text, as rows may share an id or have none."""
    return F.coalesce(F.col(id_column).cast("bigint"), F.lit(_NO_ID)), F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))


def _plain(text: Column) -> Column:
    """A text (null: empty) in lower case, with spaces for the ASCII white space that is not the end of a line."""
    text = F.coalesce(text, F.lit(""))
    for space in "\t\x0b\f\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.lower(text)


def _lines(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, tk, line_no, line) of all texts, the lines in plain form."""
    id_, tk = _key(id_column, text_column)
    return docs.select(id_.alias("id"), tk.alias("tk"), F.posexplode(F.split(_plain(F.col(text_column)), "\n", -1)).alias("line_no", "line"))


def _code(word: Column) -> Column:
    """59 bits for a word."""
    return F.shiftrightunsigned(F.xxhash64(word), _LEVEL_BITS + 1)


def _levels(docs: DataFrame, text_column: str) -> Column:
    """How frequent each group of words is, counted over all texts: a scalar, 2 MB, of a level for each group.

    A word's group is the last bits of its code. A level is a factor of two in frequency, and stands where codes have no bits.
    """
    words = docs.select(F.explode(F.split(F.replace(_plain(F.col(text_column)), F.lit("\n"), F.lit(" ")), " ", -1)).alias("w"))
    group = _code(F.col("w")).bitwiseAND(F.lit(_WORD_GROUPS - 1))
    counts = stage(words.groupBy(group.alias("id")).agg(F.count("*").alias("n")), "word-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    level = F.floor(F.log2(F.col("n") * (_ALL_RARE / max(total, _ALL_RARE)))).cast("bigint")
    level = F.shiftleft(F.greatest(F.lit(0), F.least(level, F.lit((1 << _LEVEL_BITS) - 1))).cast("bigint"), 63 - _LEVEL_BITS)
    every = docs.sparkSession.range(_WORD_GROUPS).join(counts, "id", "left").select(F.struct("id", F.coalesce(level, F.lit(0).cast("bigint")).alias("level")).alias("entry"))
    return every.agg(F.sort_array(F.collect_list("entry")).getField("level")).scalar()


def _codes(line: Column, levels: Column | None = None) -> Column:
    """The distinct words of a plain line as sorted codes; with ``levels`` these come first, so the rarest words do."""
    codes = F.transform(F.split(line, " ", -1), _code)
    if levels is None:
        return F.array_distinct(F.sort_array(F.array_remove(codes, _code(F.lit("")))))
    # never null, and Spark sees that, or it would sort objects
    level = lambda c: F.coalesce(F.get(levels, c.bitwiseAND(F.lit(_WORD_GROUPS - 1)).cast("int")), F.lit(0).cast("bigint"))
    codes = F.filter(codes, lambda c: c != _code(F.lit("")))
    return F.array_distinct(F.sort_array(F.transform(codes, lambda c: level(c).bitwiseOR(c))))


def _described(docs: DataFrame, levels: Column, percent: int, id_column: str, text_column: str) -> DataFrame:
    """All lines with a word, written once: (sid, id, tk, line_no, n, k1, k2, bits0, bits1, prefix).

    sid numbers the rows, n is the size of a line's set, (k1, k2) a 128-bit key of it. Two sets at the limit
    share a word among their rarest n - ceil(limit * n) + 1, the prefix. Sets of up to three words or so are
    similar to equal ones only and have no prefix.
    """
    # the scalar has a column of its own as it may not stand in a lambda; Spark puts it there, so rows do not hold it
    # numbered before those without a word go, or Spark would make the codes once more for that filter
    coded = _lines(docs, id_column, text_column).withColumn("levels", levels).select(
        F.monotonically_increasing_id().alias("sid"), "id", "tk", "line_no", _codes(F.col("line"), F.col("levels")).alias("codes")
    )
    n = F.size("codes")
    count = n - F.ceil(n * percent / 100).cast("int") + 1
    joins = 100 * n >= percent * (n + 1)
    prefix = F.transform(F.slice("codes", F.lit(1), count), lambda c: c.bitwiseAND(F.lit(_CODE)).cast("int"))
    return stage(coded.filter(n > 0).select(
        "sid", "id", "tk", "line_no", n.alias("n"), F.xxhash64("codes").alias("k1"), F.xxhash64(F.lit(1), F.col("codes")).alias("k2"),
        *[F.when(joins, _parity(F.col("codes"), i)).alias(f"bits{i}") for i in range(2)], F.when(joins, prefix).alias("prefix"),
    ), "lines")


def _parity(codes: Column, part: int) -> Column:
    """64 bits, each the parity of the codes that fall on it: sets that differ in d words differ in d bits at most."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("bigint"), c.bitwiseAND(F.lit(63)).cast("int"))
    mine = F.filter(codes, lambda c: F.shiftright(c, 12).bitwiseAND(F.lit(1)) == part)
    return F.aggregate(mine, F.lit(0).cast("bigint"), lambda total, c: total.bitwiseXOR(bit(c)))


def _may_match(percent: int, n: Column, m: Column, at_x: Column, at_y: Column) -> Column:
    """Whether prefix words x and y may belong to similar sets of n and m words: by length, by the words left
    behind the shared one, and by the parity bits in which the sets differ."""
    both, left = n + m, F.least(n - at_x, m - at_y)
    differ = sum((F.bit_count(F.col(f"x.bits{i}").bitwiseXOR(F.col(f"y.bits{i}"))) for i in range(2)), F.lit(0))
    return (
        (100 * F.least(n, m) >= percent * F.greatest(n, m))
        & ((100 + percent) * left >= percent * both)
        & ((100 + percent) * differ <= (100 - percent) * both)
    )


def _size_class(n: Column) -> Column:
    return F.floor(F.log2(n)).cast("int")


def _keyed(words: DataFrame, size: Column) -> DataFrame:
    """What is shuffled of a prefix word: (key, packed, sid, id, bits0, bits1).

    The key is its code with a class of sizes. One number holds the small ones: the set's size, the word's place
    and whether the set is settled. Short sets are told apart by the parity of all their words.
    """
    key = F.shiftleft(F.col("code").cast("bigint"), _SIZES.bit_length() - 1).bitwiseOR(size.cast("bigint"))
    packed = F.shiftleft(F.col("n").cast("bigint"), 32) + 2 * F.col("at").cast("bigint") + F.coalesce("settled", F.lit(0))
    bits = [F.when(size >= _LONG, F.col("bits0")).otherwise(F.col("bits0").bitwiseXOR(F.col("bits1"))), F.when(size >= _LONG, F.col("bits1")).otherwise(F.lit(0).cast("bigint"))]
    return words.select(key.alias("key"), packed.alias("packed"), "sid", "id", *[b.alias(f"bits{i}") for i, b in enumerate(bits)])


def _met(marked: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets of which the later is not settled, that share a prefix word and may be similar.

    The smaller set of a pair shares at least 2 * limit / (1 + limit) of its words, so its prefix is about half as
    long; it takes part in the classes of all sizes that it can match, the larger one in its own.
    """
    columns = ["sid", "id", "n", "bits0", "bits1", "settled"]
    larger = _keyed(marked.select(*columns, F.posexplode("prefix").alias("at", "code")), _size_class(F.col("n")))
    fewer = F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent) - F.lit(1e-9)).cast("int") + 1
    largest = F.floor(F.col("n") * 100 / percent + F.lit(1e-9))
    sizes = F.sequence(_size_class(F.col("n")), _size_class(largest))
    smaller = marked.select(*columns, sizes.alias("sizes"), F.posexplode(F.slice("prefix", F.lit(1), fewer)).alias("at", "code"))
    smaller = _keyed(smaller.select("*", F.explode("sizes").alias("size")), F.col("size"))

    x, y = F.col("x.packed"), F.col("y.packed")
    n, m = (F.shiftright(v, 32) for v in (x, y))
    at = [F.shiftright(v.bitwiseAND(F.lit(0xFFFFFFFF)), 1) for v in (x, y)]
    settled = [v.bitwiseAND(F.lit(1)) == 1 for v in (x, y)]
    once = (n < m) | ((n == m) & (F.col("x.sid") < F.col("y.sid")))
    # of sets of one id, the later one is told from the other when they are compared
    open_ = ~(settled[0] & settled[1]) & ((F.col("x.id") <= F.col("y.id")) | ~settled[0]) & ((F.col("x.id") >= F.col("y.id")) | ~settled[1])
    met = smaller.alias("x").join(larger.alias("y"), (F.col("x.key") == F.col("y.key")) & once & open_ & _may_match(percent, n, m, *at))
    return met.select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"))


def _small(rows: DataFrame) -> DataFrame:
    """``rows``, broadcast if they are few: the plan only, beyond that the other side is shuffled."""
    return F.broadcast(rows) if rows.count() <= _BROADCAST_LINES else rows


def _later_of(docs: DataFrame, pairs: DataFrame, lines: DataFrame, percent: int, id_column: str, text_column: str, name: str) -> DataFrame:
    """sid of the later set of each pair (a, b) of similar ones; verified on all words.

    Words come from each set's first line, of documents that have such a line. ``name`` begins the staged tables' names.
    """
    pairs = stage(pairs.distinct(), f"{name}-pairs")
    ends = _small(pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct())
    ends = _small(stage(lines.select("sid", "id", "tk", "line_no").join(ends, "sid", "left_semi"), f"{name}-ends"))
    id_, tk = _key(id_column, text_column)
    holders = ends.select(F.col("id").alias(_ID), F.col("tk").alias(_TK))
    some = docs.withColumns({_ID: id_, _TK: tk}).join(holders, [_ID, _TK], "left_semi")
    found = _lines(some, id_column, text_column).join(ends, ["id", "tk", "line_no"])
    sets = found.select("sid", F.struct("id", "tk", "line_no", "sid").alias("place"), _codes(F.col("line")).alias("codes"))
    sets = stage(sets.dropDuplicates(["sid"]), f"{name}-sets")
    x, y = (sets.select(F.col("sid").alias(c), F.col("place").alias(f"place_{c}"), F.col("codes").alias(f"codes_{c}")) for c in ("a", "b"))
    shared = F.size(F.array_intersect("codes_a", "codes_b"))
    similar = pairs.join(x, "a").join(y, "b").filter(100 * shared >= percent * (F.size("codes_a") + F.size("codes_b") - shared))
    return similar.select(F.greatest("place_a", "place_b").getField("sid").alias("sid")).distinct()


def _repeating_sets(docs: DataFrame, lines: DataFrame, firsts: DataFrame, percent: int, id_column: str, text_column: str) -> DataFrame:
    """sid of the sets that are similar to one whose first line is earlier.

    One earlier match is enough. So where many sets share one of their rarest words they are compared with
    the earliest of them first, which takes no more pairs than there are such words. In a family of near
    copies that settles nearly all; then every two sets that share a prefix word are compared unless the
    later one is settled. The crowded words and their earliest sets are few enough to be broadcast.
    """
    firsts = firsts.filter("prefix IS NOT NULL")
    rarest = F.slice("prefix", 1, _RAREST)
    crowd = max(_CROWDED, _RAREST * lines.count() // _BROADCAST_LINES)  # so that crowded words are at most as many as are broadcast
    crowded = stage(firsts.select(F.explode(rarest).alias("code")).groupBy("code").agg(F.count("*").alias("m")).filter(F.col("m") >= crowd).select("code"), "crowded-words")
    words = firsts.select("sid", "id", "tk", "line_no", "n", "bits0", "bits1", F.posexplode(rarest).alias("at", "code"))
    place = F.struct("id", "tk", "line_no", "sid", "n", "bits0", "bits1", "at")
    earliest = words.join(F.broadcast(crowded), "code").groupBy("code").agg(F.min(place).alias("r")).select("code", "r.*")
    earliest = F.broadcast(stage(earliest, "crowded-firsts"))
    near = (F.col("x.code") == F.col("y.code")) & (F.col("x.sid") != F.col("y.sid"))
    pairs = words.alias("x").join(earliest.alias("y"), near & _may_match(percent, *(F.col(c) for c in ("x.n", "y.n", "x.at", "y.at"))))
    pairs = pairs.select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"))
    settled = stage(_later_of(docs, pairs, lines, percent, id_column, text_column, "crowded"), "settled-lines")

    marked = firsts.join(_small(settled.withColumn("settled", F.lit(1))), "sid", "left")
    others = _later_of(docs, _met(marked, percent), lines, percent, id_column, text_column, "met")
    return settled.unionByName(others).distinct()


def repeated_lines(
    docs: DataFrame, *, percent: int = PERCENT, least_words: int = 1, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, line_no) of the lines to remove: those similar to an earlier one.

    A line is its set of lower-case words; two are similar when 100 * intersection >= ``percent`` *
    union. Lines are ordered by (id, line number); a line goes if any earlier line of the table is
    similar to it. Different texts under one id, or without id, are documents of their own, ordered by a
    hash of the text, and their rows here cannot be told apart. Lines of fewer than ``least_words`` different
    words always stay, as blank ones do.
    Line numbers count from 0 in the text split at ``\\n``. Rows that repeat an id with its text are one
    document, also those with a null id, which come first, under the smallest id; a null text is one empty line; an
    empty table gives an empty result. Other columns are not read.
    """
    return _repeated(docs, percent, least_words, id_column, text_column).select("id", "line_no")


def _repeated(docs: DataFrame, percent: int, least_words: int, id_column: str, text_column: str) -> DataFrame:
    """(id, tk, line_no) of the lines to remove."""
    levels = _levels(docs, text_column)
    lines = _described(docs, levels, percent, id_column, text_column).filter(F.col("n") >= least_words)
    # only sets of several lines are gathered: a line without an equal one is its set's first
    several = lines.groupBy("k1", "k2").agg(F.min(F.struct("id", "tk", "line_no", "sid")).alias("first"), F.count("*").alias("copies"))
    several = stage(several.filter("copies > 1").select("k1", "k2", "first"), "line-firsts")
    few = several.count() <= _BROADCAST_LINES
    several = F.broadcast(several) if few else several
    firsts = lines.join(several.select("k1", "k2", F.col("first.sid").alias("first_sid")), ["k1", "k2"], "left").filter("first_sid IS NULL OR first_sid = sid")
    firsts = firsts.select("sid", "id", "tk", "line_no", "n", "bits0", "bits1", "prefix")
    later = _repeating_sets(docs, lines, firsts if few else stage(firsts, "first-lines"), percent, id_column, text_column)
    later = _small(stage(later, "later-lines").select(F.col("sid").alias("first_sid"), F.lit(True).alias("later")))

    # a set goes as a whole when an earlier one is similar, and all but its first line otherwise
    placed = lines.select("sid", "id", "tk", "line_no", "k1", "k2").join(several, ["k1", "k2"], "left")
    placed = placed.withColumn("first_sid", F.coalesce("first.sid", "sid")).join(later, "first_sid", "left")
    behind = F.col("first").isNotNull() & (F.struct("id", "tk", "line_no") > F.struct("first.id", "first.tk", "first.line_no"))
    return placed.filter(F.col("later").isNotNull() | behind).select("id", "tk", "line_no")


def _removed(docs: DataFrame, percent: int, least_words: int, id_column: str, text_column: str) -> DataFrame:
    lines = _repeated(docs, percent, least_words, id_column, text_column)
    return lines.groupBy(F.col("id").alias(_ID), F.col("tk").alias(_TK)).agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def line_report(
    docs: DataFrame, *, percent: int = PERCENT, least_words: int = 1, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed: numbers of the removed lines joined by commas) of each row."""
    id_, tk = _key(id_column, text_column)
    n_lines = F.size(F.split(F.coalesce(F.col(text_column), F.lit("")), "\n", -1)).cast("bigint")
    rows = docs.select(F.col(id_column).alias("doc_id"), id_.alias(_ID), tk.alias(_TK), n_lines.alias("n_lines"))
    out = rows.join(_removed(docs, percent, least_words, id_column, text_column), [_ID, _TK], "left")
    return out.select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"),
    )


def remove_repeated_lines(
    docs: DataFrame, *, percent: int = PERCENT, least_words: int = 1, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` without the repeated lines; all rows and other columns stay, a null text stays null."""
    id_, tk = _key(id_column, text_column)
    keyed = docs.withColumns({_ID: id_, _TK: tk})
    removed = _removed(docs, percent, least_words, id_column, text_column).withColumnRenamed("removed", _REMOVED)
    kept = F.filter(F.split(text_column, "\n", -1), lambda _, i: ~F.array_contains(_REMOVED, i))
    text = F.when(F.col(_REMOVED).isNull(), F.col(text_column)).otherwise(F.array_join(kept, "\n"))
    return keyed.join(removed, [_ID, _TK], "left").withColumn(text_column, text).select(*docs.columns)
