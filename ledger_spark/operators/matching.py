"""Matching transactions with rules by one equi-join, the same for few rules and for many.

The three ways a rule can match (merchant equals, description equals, description
contains) are brought to one equi-join on a *probe*:

* a merchant or transaction rule is probed by its identifier,
* a pattern rule by one of its ``GRAM``-character substrings, the one that fewest other
  patterns contain, together with the place of that substring in the pattern. A
  description is probed with the substring at each of its positions. One that meets a
  pattern's substring says where the pattern would have to begin, and the pair counts if
  the pattern's first occurrence begins there: no pair is found twice or tested for
  containment elsewhere.

A probe carries its kind as a prefix, so the join has two keys: probe and direction.

Rows are grouped by match key first, within the tasks that scan them and then across, so a
text is probed and joined once however many rows have it. The probes of all rules make a
Bloom filter, a bit array of bounded size that every task reads; only probes that pass it
go to the join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import rule_rank
from ..functions.text import substrings
from .update import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS

GRAM = 4
ANY_TYPE = "All"
MATCH_KEY = ("merchant_name_cleaned", "description_cleaned", "persona_type", "transaction_type")
# A row without a direction matches nothing; the other parts of its key may be NULL.
NULLABLE_KEY = MATCH_KEY[:3]
# The filter has a 64-bit word for each four probes, three bits a probe, and 8 MB at most: beyond that it only lets more pass.
PROBES_PER_WORD = 4
MAX_FILTER_WORDS = 1 << 20

_RULE_COLUMNS = (
    "rule_id", "rule_type", "identifier", "transaction_type", "persona_type", "category_l1", "category_l2",
    "is_recurring_rule", "confidence_score", "last_updated_timestamp",
)


@dataclass(frozen=True)
class RuleIndex:
    """Rules with their probe, the substring lengths to look up, the filter's size and the measured size class."""

    rules: DataFrame
    gram_sizes: tuple[int, ...]
    filter_words: int
    fits_broadcast: bool
    rule_types: tuple[str, ...]

    def for_join(self) -> DataFrame:
        return F.broadcast(self.rules) if self.fits_broadcast else self.rules

    def _place(self, probe: Column, direction: Column) -> tuple[Column, Column]:
        """Word of the filter and bits in it for a probe."""
        code = F.xxhash64(probe, direction)
        one = F.lit(1).cast("bigint")
        bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(code, n).cast("int") % 32) for n in (33, 38)]
        high = F.call_function("shiftleft", one, F.lit(32) + F.shiftrightunsigned(code, 43).cast("int") % 32)
        return code.bitwiseAND(F.lit(self.filter_words - 1)).cast("int"), bits[0].bitwiseOR(bits[1]).bitwiseOR(high)

    def may_match(self, probe: Column, direction: Column) -> Column:
        """False only if no rule has this probe. The filter is a scalar subquery: built once, sent to every task."""
        word, bits = self._place(F.col("r_probe"), F.col("r_transaction_type"))
        found = self.rules.select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        every = self.rules.sparkSession.range(self.filter_words).select(F.col("id").cast("int").alias("word"))
        dense = every.join(found, "word", "left").select(F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")).alias("entry"))
        words = dense.agg(F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["bits"])).scalar()
        word, bits = self._place(probe, direction)
        return F.get(words, word).bitwiseAND(bits) == bits


def _tagged(kind: Column, text: Column) -> Column:
    return F.concat(kind, F.lit(":"), text)


def _rarest_grams(patterns: DataFrame) -> DataFrame:
    """One probe per pattern: the substring shared with the fewest other patterns, and where it first occurs."""
    identifier = F.col("r_identifier")
    grams = patterns.select(
        "r_identifier",
        F.explode(
            F.when(F.length(identifier) >= GRAM, substrings(identifier, GRAM)).otherwise(F.array(identifier))
        ).alias("gram"),
    )
    frequency = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n_patterns"))
    return (
        grams.join(frequency, "gram")
        .groupBy(F.col("r_identifier").alias("pattern"))
        .agg(F.min_by("gram", F.struct("n_patterns", "gram")).alias("pattern_gram"))
        .withColumn("r_offset", F.instr(F.col("pattern"), F.col("pattern_gram")) - 1)
    )


def index_rules(rules: DataFrame, rule_types: tuple[str, ...] = ("merchant", "pattern", "transaction"),
                best_per_key: bool = False) -> RuleIndex:
    """Build the probe side from rules (already filtered to those that may fire).

    ``best_per_key`` keeps only the highest-ranked rule of each rule key, enough when
    a single winner is wanted. Runs one small job over the rules to measure them.
    """
    usable = rules.filter(F.col("identifier").isNotNull() & F.col("rule_type").isin(*rule_types))
    usable = usable.select(*[F.col(c).alias(f"r_{c}") for c in _RULE_COLUMNS])
    is_pattern = F.col("r_rule_type") == "pattern"
    text_bytes = sum(F.coalesce(F.octet_length(f"r_{c}"), F.lit(0)) for c in _RULE_COLUMNS[:7])
    size = usable.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(text_bytes + 64).alias("bytes"),
        F.collect_set(F.when(is_pattern, F.least(F.length("r_identifier"), F.lit(GRAM)))).alias("gram_sizes"),
    ).first()
    small = size["n"] <= MAX_BROADCAST_ROWS and (size["bytes"] or 0) <= MAX_BROADCAST_BYTES
    words = 1 << max(4, (size["n"] // PROBES_PER_WORD).bit_length())

    if best_per_key:
        key = ["r_identifier", "r_rule_type", "r_transaction_type", "r_persona_type"]
        rank = rule_rank(F.col("r_confidence_score"), F.col("r_last_updated_timestamp"), F.col("r_rule_id"))
        rest = [c for c in usable.columns if c not in key]
        usable = (
            usable.groupBy(*key)
            .agg(F.min_by(F.struct(*rest), F.struct(*rank)).alias("best"))
            .select(*key, *[F.col("best").getField(c).alias(c) for c in rest])
        )
    patterns = usable.filter(is_pattern).select("r_identifier").distinct()
    usable = usable.join(_rarest_grams(patterns), is_pattern & (F.col("r_identifier") == F.col("pattern")), "left")
    gram = F.col("pattern_gram")
    probe = F.when(is_pattern, _tagged(F.concat(F.lit("pattern"), F.length(gram).cast("string")), gram)).otherwise(
        _tagged(F.col("r_rule_type"), F.col("r_identifier"))
    )
    probed = usable.withColumn("r_probe", probe).drop("pattern", "pattern_gram")
    return RuleIndex(probed, tuple(sorted(size["gram_sizes"])), min(words, MAX_FILTER_WORDS), small, rule_types)


def _with_probes(rows: DataFrame, index: RuleIndex) -> DataFrame:
    """One row per row and probe, with the position of a substring in the description (1 for whole texts).

    Position 0 carries the whole texts, position i the substrings that start at the
    i-th character. Only built-in functions with generated code are used.
    """
    merchant, description = F.col("merchant_name_cleaned"), F.col("description_cleaned")
    position = F.col("probe_position")
    whole = []
    if "merchant" in index.rule_types:
        whole.append(_tagged(F.lit("merchant"), merchant))
    if "transaction" in index.rule_types:
        whole.append(_tagged(F.lit("transaction"), description))
    if 0 in index.gram_sizes:
        whole.append(F.when(description.isNotNull(), F.lit("pattern0:")))
    sizes = [n for n in index.gram_sizes if n > 0]
    if not sizes:
        return rows.select("*", F.lit(1).alias("probe_position"), F.explode(F.array(*whole)).alias("probe"))
    parts = []
    for n in sizes:
        gram = F.substring(description, position, F.lit(n))
        parts.append(F.when(position <= F.length(description) - F.lit(n - 1), _tagged(F.lit(f"pattern{n}"), gram)))
    last = F.coalesce(F.length(description), F.lit(0))
    return (
        rows.withColumn("probe_position", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("probe", F.explode(F.when(position == 0, F.array(*whole)).otherwise(F.array(*parts))))
        .withColumn("probe_position", F.greatest(position, F.lit(1)))
    )


def candidate_probes(rows: DataFrame, index: RuleIndex, *, all_matches_any: bool = False) -> DataFrame:
    """The probes of ``rows`` that some rule may have: a projection of the scanned rows, without a shuffle."""
    direction = F.col("transaction_type")
    probed = _with_probes(rows.filter(direction.isNotNull()), index).filter("probe IS NOT NULL")
    if all_matches_any:
        probed = probed.withColumn("probe_type", F.explode(F.array(direction, F.lit(ANY_TYPE))))
    else:
        probed = probed.withColumn("probe_type", direction)
    return probed.filter(index.may_match(F.col("probe"), F.col("probe_type")))


def match_keys(rows: DataFrame, index: RuleIndex, *, persona: bool = True, all_matches_any: bool = False) -> DataFrame:
    """Every rule that applies to a match key of ``rows``, once. Output: key columns, their number of rows ``n`` and ``r_*``.

    A rule applies when its text matches, its direction equals the row's, and (with
    ``persona``) its persona is NULL or equals the row's; without it, keys have no persona.
    Rules for ``All`` directions fire only with ``all_matches_any``.
    """
    key = [c for c in MATCH_KEY if persona or c != "persona_type"]
    keys = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))  # a text is probed once, however many rows have it
    candidates = candidate_probes(keys, index, all_matches_any=all_matches_any)
    begins = F.instr(F.col("description_cleaned"), F.col("r_identifier"))
    applies = (
        (F.col("probe") == F.col("r_probe"))
        & (F.col("probe_type") == F.col("r_transaction_type"))
        & ((F.col("r_rule_type") != "pattern") | ((begins > 0) & (begins == F.col("probe_position") - F.col("r_offset"))))
    )
    if persona:
        applies = applies & (
            F.col("r_persona_type").isNull() | (F.col("r_persona_type") == F.col("persona_type"))
        )
    return candidates.join(index.for_join(), applies).drop("probe", "probe_type", "probe_position", "r_offset")


def probe_report(rows: DataFrame, index: RuleIndex) -> DataFrame:
    """One row: n_rows, n_texts with a direction, n_probes of all rows, n_shuffled that passed the filter, n_joined after grouping."""
    key = list(MATCH_KEY)
    open_rows = rows.select(*key).filter(F.col("transaction_type").isNotNull())
    texts = open_rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.struct(*key)).alias("n_texts"))
    probes = _with_probes(open_rows, index).filter("probe IS NOT NULL").agg(F.count(F.lit(1)).alias("n_probes"))
    kept = candidate_probes(open_rows, index)
    kept = kept.agg(F.count(F.lit(1)).alias("n_shuffled"), F.count_distinct(F.struct(*key, "probe", "probe_position")).alias("n_joined"))
    one = F.lit(1).alias("one")
    return texts.select("*", one).join(probes.select("*", one), "one").join(kept.select("*", one), "one").drop("one")


def match_rank() -> list[Column]:
    """Ascending rank of a matched rule: persona match, score, recency, id."""
    return [
        F.when(F.col("persona_type") == F.col("r_persona_type"), 1).otherwise(2),
        *rule_rank(F.col("r_confidence_score"), F.col("r_last_updated_timestamp"), F.col("r_rule_id")),
    ]


__all__ = [
    "MATCH_KEY", "NULLABLE_KEY", "RuleIndex", "candidate_probes", "index_rules", "match_keys", "match_rank", "probe_report",
]
