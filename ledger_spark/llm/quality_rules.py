"""Quality rules: a threshold table compiled into one projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words_of

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

# Very frequent words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not",
    "le", "la", "les", "de", "des", "et", "un", "une", "que", "du", "dans", "est",
    "der", "die", "das", "und", "den", "ein", "zu", "nicht", "mit", "sich", "auf",
    "el", "los", "las", "en", "y", "se", "por", "del", "una", "con", "su", "para",
)


@dataclass(frozen=True)
class Threshold:
    """A document fails when ``measure`` is below ``least`` or above ``most``."""

    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0  # shorter texts are not held to this rule


#: Measures are columns of ``measures``. The stop-word rule is case sensitive on purpose: text in capitals has none.
THRESHOLDS = (
    Threshold("n_words", least=10, most=1_000_000),
    Threshold("mean_word_chars", least=2, most=12),
    Threshold("symbols_per_word", most=0.1),
    Threshold("stop_word_ratio", least=0.02, from_words=30),
    Threshold("dup_line_ratio", most=0.4),
)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words found at least twice.

    A window is known by its 64-bit hash. Texts without an equal pair (most) stop after one pass;
    the others sort (hash, position), mark the positions with an equal neighbour, and add up what
    each marked window covers beyond the one before.
    """
    last = F.size(words) - WINDOW

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            def repeated(x: Column, k: Column) -> Column:
                beside = [F.coalesce(F.get(s, k + d)["h"] == x["h"], F.lit(False)) for d in (1, -1)]
                return beside[0] | beside[1]

            return F.sort_array(F.transform(F.filter(s, repeated), lambda x: x["i"]))

        def cover(at: Column) -> Column:
            steps = F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

        return let(let(placed, marked), cover)

    def of(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    window = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)])
    return F.when(last < 0, F.lit(0)).otherwise(let(F.transform(F.sequence(F.lit(0), last), window), of)).cast("bigint")


def measures(text_column: str = "text") -> Column:
    """All counts of a text as one struct. A null or empty text has no words and no lines."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counted(x: Column) -> Column:
        w, ln = x["words"], x["lines"]
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            F.size(ln).cast("bigint").alias("n_lines"),
            (F.size(ln) - F.size(F.array_distinct(ln))).cast("bigint").alias("n_dup_lines"),
            _repeated_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda v: v.isin(*STOP_WORDS))).cast("bigint").alias("n_stop_words"),
        )

    return let(F.struct(words_of(F.col(text_column)).alias("words"), lines.alias("lines")), counted)


def _ratios(m: Column) -> dict[str, Column]:
    over = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    return {
        "n_words": m["n_words"],
        "mean_word_chars": over(m["word_chars"], m["n_words"]),
        "symbols_per_word": over(m["n_symbols"], m["n_words"]),
        "stop_word_ratio": over(m["n_stop_words"], m["n_words"]),
        "dup_line_ratio": over(m["n_dup_lines"], m["n_lines"]),
        "repeat_word_ratio": over(m["n_repeat_words"], m["n_words"]),
    }


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def verdict(m: Column, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """True where every rule of the table holds."""
    ratios, passed = _ratios(m), F.lit(True)
    for t in thresholds:
        held = F.lit(True)
        if t.least is not None:
            held &= ratios[t.measure] >= t.least
        if t.most is not None:
            held &= ratios[t.measure] <= t.most
        passed &= held if not t.from_words else (held | (m["n_words"] < t.from_words))
    return passed


def judge_quality(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", thresholds: tuple[Threshold, ...] = THRESHOLDS
) -> DataFrame:
    """Counts, base rule and verdict of each row.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; a null text has none and fails, like an
    empty one. Each row is judged by itself, so repeated rows get equal verdicts, null ids stay, an
    empty table gives an empty result and other columns are not read.
    """
    m = F.col("_measured")
    return docs.select(F.col(id_column).alias("doc_id"), measures(text_column).alias("_measured")).select(
        "doc_id", *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(m).alias("base_failed"), (~base_failed(m) & verdict(m, thresholds)).alias("kept"),
    )


def keep_good(docs: DataFrame, *, text_column: str = "text", thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """The rows that pass the base rule and the table, with their columns unchanged."""
    return docs.filter(let(measures(text_column), lambda m: ~base_failed(m) & verdict(m, thresholds)))
