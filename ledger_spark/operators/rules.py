"""Rule engine: match, rank and apply; conflicts; deactivation; user rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scoring import USER_RULE_SCORE, rule_rank, stable_rule_id
from ..functions.text import clean_description, clean_merchant
from ..schema import METHOD_RULES_PREFIX, RULE_KEY, TAXONOMY, is_valid_category
from ..sources.staging import Staging
from .matching import MATCH_KEY, NULLABLE_KEY, index_rules, match_keys, match_rank
from .update import fits_broadcast, key_condition, keyed_update, keyed_upsert, new

USER_RULE_TYPES = ("merchant", "pattern")
USER_TRANSACTION_TYPES = ("Debit", "Credit", "All")


def match_rules(transactions: DataFrame, rules: DataFrame, *, all_matches_any: bool = False) -> DataFrame:
    """Every (open transaction, active rule) pair that matches, with the rule's rank parts.

    Texts are matched once per distinct key; the pairs are then attached to the rows.
    """
    open_rows = transactions.filter(F.col("category_l1").isNull()).select("transaction_id", *MATCH_KEY)
    index = index_rules(rules.filter(F.col("is_active")))
    pairs = match_keys(open_rows, index, all_matches_any=all_matches_any)
    renamed = pairs.select(
        *[F.col(c).alias(f"k_{c}") for c in MATCH_KEY],
        *[F.col(c) for c in pairs.columns if c.startswith("r_") and c != "r_probe"],
    )
    condition = key_condition({c: F.col(c) for c in MATCH_KEY}, {c: F.col(f"k_{c}") for c in MATCH_KEY}, NULLABLE_KEY)
    return open_rows.join(renamed, condition).select(
        "transaction_id",
        F.col("r_rule_id").alias("rule_id"),
        F.col("r_rule_type").alias("rule_type"),
        F.col("r_category_l1").alias("category_l1"),
        F.col("r_category_l2").alias("category_l2"),
        F.col("r_is_recurring_rule").alias("is_recurring_rule"),
        F.when(F.col("persona_type") == F.col("r_persona_type"), 1).otherwise(2).alias("persona_rank"),
        F.col("r_confidence_score").alias("confidence_score"),
        F.col("r_last_updated_timestamp").alias("last_updated_timestamp"),
    )


def winning_rules(transactions: DataFrame, rules: DataFrame, *, all_matches_any: bool = False) -> DataFrame:
    """The one rule that labels each distinct match key of the open rows."""
    open_rows = transactions.filter(F.col("category_l1").isNull())
    index = index_rules(rules.filter(F.col("is_active")), best_per_key=True)
    matched = match_keys(open_rows, index, all_matches_any=all_matches_any)
    winner = F.struct(
        F.col("r_category_l1").alias("category_l1"),
        F.col("r_category_l2").alias("category_l2"),
        F.col("r_rule_id").alias("rule_id"),
        F.col("r_is_recurring_rule").alias("is_recurring_rule"),
        F.concat(F.lit(METHOD_RULES_PREFIX), F.lower("r_rule_type")).alias("method"),
    )
    return (
        matched.groupBy(*MATCH_KEY)
        .agg(F.min_by(winner, F.struct(*match_rank())).alias("winner"))
        .select(*MATCH_KEY, "winner.*")
    )


def apply_rules(
    transactions: DataFrame,
    rules: DataFrame,
    as_of: Column,
    *,
    all_matches_any: bool = False,
    staging: Staging | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Label rows without an L1 by their winning rule.

    Winner: a rule for the row's persona before a global one, then the higher score,
    then the more recent rule, then the smaller rule id. The rule's recurring flag
    replaces the row's unless it is NULL.

    With ``staging`` the winners are written first; when they turn out small they are
    broadcast and the transactions are not shuffled at all.
    """
    winners = winning_rules(transactions, rules, all_matches_any=all_matches_any)
    small = False
    if staging is not None:
        winners = staging.table(winners, "winning-rules")
        small = fits_broadcast(winners)
    return keyed_update(
        transactions,
        winners,
        on=MATCH_KEY,
        null_safe=NULLABLE_KEY,
        rows=F.col("category_l1").isNull(),
        on_duplicate="unique",
        small_source=small,
        observation=observation,
        assign={
            "category_l1": new("category_l1"),
            "category_l2": new("category_l2"),
            "rule_id": new("rule_id"),
            "is_recurring": F.coalesce(new("is_recurring_rule"), F.col("is_recurring")),
            "categorization_method": new("method"),
            "categorization_update_timestamp": as_of,
        },
    )


def rule_hits_by_type(labelled: DataFrame) -> DataFrame:
    """How many rows the engine labelled, by method and label."""
    return (
        labelled.filter(F.col("categorization_method").startswith(METHOD_RULES_PREFIX) & F.col("rule_id").isNotNull())
        .groupBy("categorization_method", "category_l1", "category_l2")
        .agg(F.count("transaction_id").alias("transaction_count"))
    )


def _conflicting_keys(rules: DataFrame) -> DataFrame:
    """Keys of active rules with more than one label, their size, and the rule to keep."""
    rank = rule_rank(F.col("confidence_score"), F.col("last_updated_timestamp"), F.col("rule_id"))
    best = F.struct(*[part.alias(f"rank_{i}") for i, part in enumerate(rank)])
    per_label = (
        rules.filter(F.col("is_active"))
        .groupBy(*RULE_KEY, "category_l1", "category_l2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(best).alias("best"))
    )
    return (
        per_label.groupBy(*[F.col(c).alias(f"c_{c}") for c in RULE_KEY])
        .agg(
            F.count(F.lit(1)).alias("n_labels"),
            F.sum("n").alias("n_rules"),
            F.min("best").getField(f"rank_{len(rank) - 1}").alias("rule_to_keep"),
        )
        .filter(F.col("n_labels") > 1)
    )


def rule_conflicts(rules: DataFrame) -> DataFrame:
    """Active rules that share a key but disagree on the label, one row per rule.

    ``n_labels`` and ``n_rules`` describe the key, ``rule_to_keep`` is the rule that
    the deterministic resolution would keep.
    """
    keys = _conflicting_keys(rules)
    condition = key_condition({c: F.col(c) for c in RULE_KEY}, {c: F.col(f"c_{c}") for c in RULE_KEY}, RULE_KEY)
    return rules.filter(F.col("is_active")).join(keys, condition).select(
        *RULE_KEY, "rule_id", "category_l1", "category_l2", "confidence_score", "last_updated_timestamp",
        "n_labels", "n_rules", "rule_to_keep",
    )


def deactivate_rules(rules: DataFrame, rule_ids: DataFrame, as_of: Column,
                     observation: Observation | None = None) -> DataFrame:
    """Switch off the rules whose ``rule_id`` is in ``rule_ids``."""
    return keyed_update(
        rules,
        rule_ids.select("rule_id").distinct(),
        on=["rule_id"],
        on_duplicate="unique",
        small_source=False,
        observation=observation,
        assign={"is_active": F.lit(False), "last_updated_timestamp": as_of},
    )


def resolve_rule_conflicts(rules: DataFrame, as_of: Column, observation: Observation | None = None) -> DataFrame:
    """Keep the best rule of every conflicting key and deactivate the others."""
    losers = rule_conflicts(rules).filter(F.col("rule_id") != F.col("rule_to_keep"))
    return deactivate_rules(rules, losers, as_of, observation)


def _user_rule_problem() -> Column:
    return (
        F.when(~F.coalesce(F.lower("rule_type").isin(*USER_RULE_TYPES), F.lit(False)), F.lit("invalid rule_type"))
        .when(
            ~F.coalesce(F.col("transaction_type").isin(*USER_TRANSACTION_TYPES), F.lit(False)),
            F.lit("invalid transaction_type"),
        )
        .when(~is_valid_category(F.col("category_l1"), F.col("category_l2")), F.lit("invalid category combination"))
    )


def check_user_rules(user_rules: DataFrame) -> DataFrame:
    """Add ``problem``: why a user rule is refused, NULL when it is fine."""
    return user_rules.withColumn("problem", _user_rule_problem())


def upsert_user_rules(
    rules: DataFrame,
    user_rules: DataFrame,
    as_of: Column,
    *,
    on_invalid: str = "error",
    normalize_identifier: bool = False,
) -> DataFrame:
    """Add user rules, or replace and reactivate the rules with the same key. Score 99.

    Identifiers are lower-cased. They match cleansed text only if they look like it;
    ``normalize_identifier`` runs them through the cleansers as well. ``on_invalid``
    is ``"error"`` or ``"skip"``. Two user rules for one key fail the job.
    """
    checked = check_user_rules(user_rules)
    if on_invalid == "skip":
        checked = checked.filter(F.col("problem").isNull())
    elif on_invalid != "error":
        raise ValueError(f"unknown on_invalid policy {on_invalid!r}")
    identifier = F.lower("identifier")
    if normalize_identifier:
        identifier = F.when(
            F.lower("rule_type") == "merchant", F.coalesce(clean_merchant(F.col("identifier")), identifier)
        ).otherwise(clean_description(F.col("identifier")))
    keyed = checked.select(
        identifier.alias("identifier"),
        F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(F.col("problem"), F.lit(" in user rule"))))
        .otherwise(F.lower("rule_type"))
        .alias("rule_type"),
        "transaction_type",
        "persona_type",
        "category_l1",
        "category_l2",
        F.coalesce("is_recurring_rule", F.lit(False)).alias("is_recurring_rule"),
    )
    label = F.struct("category_l1", "category_l2", "is_recurring_rule")
    single = (
        keyed.groupBy(*RULE_KEY)
        .agg(F.count(F.lit(1)).alias("n"), F.min(label).alias("label"))
        .select(
            F.when(F.col("n") > 1, F.raise_error(F.lit("two user rules for one key")))
            .otherwise(F.col("identifier"))
            .alias("identifier"),
            *RULE_KEY[1:],
            "label.*",
        )
    )
    return keyed_upsert(
        rules,
        single,
        on=RULE_KEY,
        null_safe=("persona_type",),
        assign={
            "category_l1": new("category_l1"),
            "category_l2": new("category_l2"),
            "is_recurring_rule": new("is_recurring_rule"),
            "confidence_score": F.lit(USER_RULE_SCORE),
            "last_updated_timestamp": as_of,
            "is_active": F.lit(True),
        },
        insert=rule_insert(F.col("rule_type"), F.lit(USER_RULE_SCORE), as_of),
    )


def rule_insert(rule_type: Column, score: Column, as_of: Column, *id_labels: str, label: Column | None = None) -> dict[str, Column]:
    """Columns of a new rule, over a source that carries the key and, unless ``label`` is a struct of them, the label columns."""
    of_label = (lambda c: F.col(c)) if label is None else (lambda c: label[c])
    return {
        "rule_id": stable_rule_id(
            rule_type, F.col("identifier"), F.col("transaction_type"), F.col("persona_type"),
            *[of_label(c) for c in id_labels],
        ),
        "rule_type": rule_type,
        "identifier": F.col("identifier"),
        "transaction_type": F.col("transaction_type"),
        "persona_type": F.col("persona_type"),
        "category_l1": of_label("category_l1"),
        "category_l2": of_label("category_l2"),
        "is_recurring_rule": of_label("is_recurring_rule"),
        "confidence_score": score,
        "created_timestamp": as_of,
        "last_updated_timestamp": as_of,
        "is_active": F.lit(True),
    }


def create_rule(
    spark: SparkSession,
    rules: DataFrame,
    as_of: Column,
    *,
    identifier: str,
    rule_type: str,
    category_l1: str,
    category_l2: str,
    transaction_type: str,
    is_recurring_rule: bool = False,
    persona_type: str | None = None,
) -> DataFrame:
    """One user rule, validated before any job runs."""
    if rule_type.lower() not in USER_RULE_TYPES:
        raise ValueError(f"invalid rule_type {rule_type!r}: must be one of {USER_RULE_TYPES}")
    if transaction_type not in USER_TRANSACTION_TYPES:
        raise ValueError(f"invalid transaction_type {transaction_type!r}: must be one of {USER_TRANSACTION_TYPES}")
    if category_l2 not in TAXONOMY.get(category_l1, ()):
        raise ValueError(f"invalid category combination {category_l1!r} / {category_l2!r}")
    rule = spark.range(1).select(
        F.lit(identifier).alias("identifier"),
        F.lit(rule_type).alias("rule_type"),
        F.lit(category_l1).alias("category_l1"),
        F.lit(category_l2).alias("category_l2"),
        F.lit(transaction_type).alias("transaction_type"),
        F.lit(is_recurring_rule).alias("is_recurring_rule"),
        F.lit(persona_type).cast("string").alias("persona_type"),
    )
    return upsert_user_rules(rules, rule, as_of)
