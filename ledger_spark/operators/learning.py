"""Learning rules from labelled rows, and backfilling rule scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scoring import CONFIDENT_SINGLE_ROW, SINGLE_ROW_RULE_SCORE, USER_RULE_SCORE, confidence_score
from ..schema import (
    METHOD_BULK_MERCHANT,
    METHOD_BULK_PATTERN,
    METHOD_SINGLE,
    PATTERN_PREFIX_LENGTH,
    RULE_KEY,
    has_text,
)
from ..sources.staging import Staging
from .matching import index_rules, match_keys
from .rules import rule_insert
from .update import keyed_update, keyed_upsert, new

# Rows a group needs before it is learned from.
MIN_MERCHANT_ROWS = 2
MIN_PATTERN_ROWS = 3

# In this order; rules that one part adds or improves are known to the next.
MERCHANT, PATTERN, TRANSACTION, SINGLE_MERCHANT = "merchant", "pattern", "transaction", "single-merchant"
PARTS = (MERCHANT, PATTERN, TRANSACTION, SINGLE_MERCHANT)

Observations = tuple[Observation, Observation]


def _labelled_groups(transactions: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows (part, key, label) with their counts: one pass over the transactions, one aggregation, for all parts."""
    method = F.col("categorization_method")
    merchant, description = F.col("merchant_name_cleaned"), F.col("description_cleaned")
    confident = (method == METHOD_SINGLE) & (F.col("llm_confidence_score") >= CONFIDENT_SINGLE_ROW)
    sources = {
        MERCHANT: ((method == METHOD_BULK_MERCHANT) & has_text("merchant_name_cleaned"), merchant),
        PATTERN: ((method == METHOD_BULK_PATTERN) & has_text("description_cleaned"), F.substring(description, 1, PATTERN_PREFIX_LENGTH)),
        TRANSACTION: (confident & has_text("description_cleaned"), description),
        SINGLE_MERCHANT: (confident & has_text("merchant_name_cleaned"), merchant),
    }
    given = [
        F.when(sources[part][0], F.struct(F.lit(part).alias("part"), sources[part][1].alias("identifier")))
        for part in PARTS if part in parts
    ]
    learned_from = transactions.filter(method.isin(METHOD_BULK_MERCHANT, METHOD_BULK_PATTERN, METHOD_SINGLE))
    labels = ["transaction_type", "persona_type", "category_l1", "category_l2"]
    rows = learned_from.select(F.explode(F.array_compact(F.array(*given))).alias("given"), *labels, "is_recurring", "transaction_id")
    return rows.groupBy(F.col("given.part").alias("part"), F.col("given.identifier").alias("identifier"), *labels).agg(
        F.bool_and(F.coalesce("is_recurring", F.lit(False))).alias("always_recurring"),
        F.min_by("is_recurring", "transaction_id").alias("first_recurring"),
        F.count("transaction_id").alias("transaction_count"),
    )


def learned_rules(transactions: DataFrame, *, parts: Sequence[str] = PARTS, min_score: int = 0) -> DataFrame:
    """What the transactions teach, one row per rule key: ``best``, or the labels of ``singles``.

    Groups of enough rows give one candidate per key: the label with the best score, then most rows,
    then name. Confident single rows give one per label, its flag taken from the smallest transaction
    id; where a group taught the key already they are left out, as its rule comes first.
    """
    part = F.col("part")
    single = part.isin(TRANSACTION, SINGLE_MERCHANT)
    groups = _labelled_groups(transactions, parts).withColumn(
        "score", F.when(single, F.lit(SINGLE_ROW_RULE_SCORE)).otherwise(confidence_score(F.col("transaction_count")))
    )
    enough = F.col("transaction_count") >= F.when(part == MERCHANT, MIN_MERCHANT_ROWS).otherwise(MIN_PATTERN_ROWS)
    groups = groups.filter(single | (enough & (F.col("score") >= min_score)))
    flag = F.when(single, F.col("first_recurring")).otherwise(F.col("always_recurring"))
    label = F.struct("category_l1", "category_l2", flag.alias("is_recurring_rule"), F.col("score").cast("bigint").alias("confidence_score"), "part")
    order = F.struct((-F.col("score")).alias("by_score"), (-F.col("transaction_count")).alias("by_count"), "category_l1", "category_l2")
    return (
        groups.groupBy("identifier", F.when(part == SINGLE_MERCHANT, MERCHANT).otherwise(part).alias("rule_type"), "transaction_type", "persona_type")
        .agg(
            F.min(F.when(~single, F.struct(order.alias("order"), label.alias("label")))).getField("label").alias("best"),
            F.collect_list(F.when(single, label)).alias("singles"),  # at most as many as there are labels
        )
        .withColumn("singles", F.when(F.col("best").isNull(), F.col("singles")).otherwise(F.array().cast("array<" + _LABEL + ">")))
    )


_LABEL = "struct<category_l1:string,category_l2:string,is_recurring_rule:boolean,confidence_score:bigint,part:string>"


def _upsert_learned(rules: DataFrame, learned: DataFrame, as_of: Column, observations: Observations | None = None,
                    by_part: Observation | None = None) -> DataFrame:
    """Insert unknown keys; replace known ones only by a group with a higher score."""
    fields = rules.schema.fields

    def row(label: Column, *id_labels: str) -> Column:
        made = rule_insert(F.col("rule_type"), label["confidence_score"], as_of, *id_labels, label=label)
        return F.struct(*[made[f.name].cast(f.dataType).alias(f.name) for f in fields])

    best = F.col("best")
    one_each = F.transform("singles", lambda label: row(label, "category_l1", "category_l2"))
    source = learned.withColumn("part", F.coalesce(best["part"], F.element_at("singles", 1)["part"]))

    def count_parts(joined: DataFrame, hit: Column, added: Column) -> DataFrame:
        changed = [F.coalesce(F.sum(F.when(new("part") == part, hit.cast("int") + added)), F.lit(0)).alias(part) for part in PARTS]
        return joined.observe(by_part, *changed)

    return keyed_upsert(
        rules,
        source,
        on=RULE_KEY,
        null_safe=("persona_type",),
        when=new("best").getField("confidence_score") > F.col("confidence_score"),
        assign={
            "category_l1": new("best").getField("category_l1"),
            "category_l2": new("best").getField("category_l2"),
            "is_recurring_rule": new("best").getField("is_recurring_rule"),
            "confidence_score": new("best").getField("confidence_score"),
            "last_updated_timestamp": as_of,
        },
        insert=F.when(best.isNotNull(), F.array(row(best))).otherwise(one_each),
        observations=observations,
        on_change=count_parts if by_part is not None else None,
    )


def learn_merchant_rules(transactions: DataFrame, rules: DataFrame, as_of: Column, *, min_score: int = 0,
                         observations: Observations | None = None) -> DataFrame:
    """Merchant rules from rows labelled by merchant decisions."""
    return _upsert_learned(rules, learned_rules(transactions, parts=[MERCHANT], min_score=min_score), as_of, observations)


def learn_pattern_rules(transactions: DataFrame, rules: DataFrame, as_of: Column, *, min_score: int = 0,
                        observations: Observations | None = None) -> DataFrame:
    """Pattern rules from rows labelled by pattern decisions."""
    return _upsert_learned(rules, learned_rules(transactions, parts=[PATTERN], min_score=min_score), as_of, observations)


def learn_transaction_rules(transactions: DataFrame, rules: DataFrame, as_of: Column,
                            observations: Observations | None = None) -> DataFrame:
    """Whole-description rules from confident single rows; known keys stay as they are.

    Rows that disagree on the label give one rule each; conflict resolution settles those.
    """
    return _upsert_learned(rules, learned_rules(transactions, parts=[TRANSACTION]), as_of, observations)


def learn_single_merchant_rules(transactions: DataFrame, rules: DataFrame, as_of: Column,
                                observations: Observations | None = None) -> DataFrame:
    """Merchant rules from confident single rows; known keys stay as they are."""
    return _upsert_learned(rules, learned_rules(transactions, parts=[SINGLE_MERCHANT]), as_of, observations)


def learn_all_rules(
    transactions: DataFrame,
    rules: DataFrame,
    as_of: Column,
    *,
    include_patterns: bool = False,
    min_score: int = 0,
    staging: Staging | None = None,
    affected: dict[str, int] | None = None,
) -> DataFrame:
    """All learning parts, each with the rules of the one before: one scan of the transactions and one of the rules.

    The parts meet only in merchant rules, and there a group's rule comes before those of single rows,
    so one aggregate settles what each key gets. Patterns are left out unless ``include_patterns``.
    With ``staging`` the rules are written, and ``affected`` receives the updated and inserted rules of
    each part.
    """
    parts = [part for part in PARTS if part != PATTERN or include_patterns]
    learned = learned_rules(transactions, parts=parts, min_score=min_score)
    if staging is None:
        return _upsert_learned(rules, learned, as_of)
    by_part = Observation()
    rules = staging.table(_upsert_learned(rules, learned, as_of, by_part=by_part), "rules-learned")
    if affected is not None:
        affected.update({f"learn-{part}": by_part.get[part] for part in parts})
    return rules


def count_rule_matches(transactions: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of the rule's direction that each merchant or pattern rule matches, labelled or not, any persona.

    Rows are counted per text before they meet the rules.
    """
    index = index_rules(rules, rule_types=("merchant", "pattern"))
    return (
        match_keys(transactions.filter(F.col("transaction_id").isNotNull()), index, persona=False)
        .groupBy(F.col("r_rule_id").alias("rule_id"))
        .agg(F.sum("n").alias("transaction_count"))
    )


def backfill_rule_scores(transactions: DataFrame, rules: DataFrame, *, protect_user_rules: bool = False,
                         observation: Observation | None = None) -> DataFrame:
    """Re-score every merchant and pattern rule by the rows it matches; 0 when it matches none.

    Other rule types keep their score. User rules lose their 99 unless
    ``protect_user_rules`` is set.
    """
    counted = F.col("rule_type").isin("merchant", "pattern")
    if protect_user_rules:
        counted = counted & ~F.col("confidence_score").eqNullSafe(F.lit(USER_RULE_SCORE))
    due = rules.filter(counted)
    scores = (
        due.select("rule_id")
        .distinct()
        .join(count_rule_matches(transactions, due), "rule_id", "left")
        .select(
            "rule_id",
            confidence_score(F.coalesce("transaction_count", F.lit(0))).alias("confidence_score"),
        )
    )
    return keyed_update(
        rules, scores, on=["rule_id"], rows=counted, on_duplicate="unique", small_source=False,
        observation=observation, assign={"confidence_score": new("confidence_score")},
    )
