"""Labeller decisions: JSON payloads in, validated frames out, labels applied.

Payloads are parsed with VARIANT, element by element, so one odd element does not
spoil its neighbours and a bare object is not mistaken for a list. What VARIANT
refuses though the labellers' JSON allows it is read by a second, permissive path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schema import (
    METHOD_BULK_MERCHANT,
    METHOD_BULK_PATTERN,
    METHOD_SINGLE,
    is_unlabelled,
    is_valid_category,
)
from .batches import MERCHANT_GROUP, PATTERN_GROUP, with_description_prefix
from .update import keyed_update, new

FENCE_OPEN = "```json"
FENCE = "```"


def unfenced(payload: Column) -> Column:
    """The text between a JSON code fence and its end, or the whole text when there is none."""
    after = F.element_at(F.split(payload, FENCE_OPEN), 2)
    inside = F.element_at(F.split(after, FENCE), 1)
    return F.trim(F.when(payload.contains(FENCE_OPEN), inside).otherwise(payload), F.lit(" \t\n\r\f"))


def _decision_list(payload: Column) -> Column:
    """The elements of a JSON list as VARIANTs, NULL for any other text.

    VARIANT refuses numbers such as NaN and objects that repeat a key, which the labellers' JSON may
    hold. A list it refuses is read again by a permissive reader: such a number becomes text, which no
    check takes for a number, and of a repeated key the last value counts. An element that is still no
    JSON is NULL.
    """
    text = unfenced(payload)
    listed = text.startswith("[") & text.endswith("]")
    strict = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    permissive = {"allowNonNumericNumbers": "true", "allowSingleQuotes": "false"}

    def last_values(element: Column) -> Column:
        entries = F.map_entries(F.from_json(element, "map<string,variant>", permissive))
        kept = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
        return F.coalesce(F.to_variant_object(F.map_from_entries(kept)), F.try_parse_json(element))

    return F.when(listed, F.coalesce(strict, F.transform(F.from_json(text, "array<string>", permissive), last_values)))


def parse_decisions(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """One row per element of each JSON list, as VARIANT ``decision`` with its ``position``.

    Text that is no JSON list gives no rows. Other columns of ``payloads`` are kept.
    """
    kept = [c for c in payloads.columns if c != column]
    return payloads.select(*kept, F.posexplode(_decision_list(F.col(column))).alias("position", "decision"))


def unparsable_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Payloads that give no rows because they are no JSON list."""
    return payloads.filter(_decision_list(F.col(column)).isNull())


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _is_object(decision: Column) -> Column:
    return _kind(decision).startswith("OBJECT")


def _field(decision: Column, key: str) -> Column:
    return F.try_variant_get(decision, f"$.{key}", "variant")


def _text(decision: Column, key: str) -> Column:
    return F.try_variant_get(decision, f"$.{key}", "string")


def _label(decision: Column, key: str) -> Column:
    """A label must be a JSON string; anything else is as good as missing."""
    return F.when(_kind(_field(decision, key)) == "STRING", _text(decision, key))


def _has_key(decision: Column, key: str) -> Column:
    """The key is there, be its value null or not."""
    return _field(decision, key).isNotNull()


def validate_transaction_decisions(decisions: DataFrame) -> DataFrame:
    """Single-row decisions with an id, a valid label and a score that converts to an integer."""
    d = F.col("decision")
    fields = decisions.filter(_is_object(d)).select(
        _text(d, "transaction_id").alias("transaction_id"),
        _label(d, "category_l1").alias("category_l1"),
        _label(d, "category_l2").alias("category_l2"),
        F.try_variant_get(d, "$.llm_confidence_score", "bigint").alias("llm_confidence_score"),
    )
    return fields.filter(
        F.col("transaction_id").isNotNull()
        & (F.col("transaction_id") != "")
        & F.col("llm_confidence_score").isNotNull()
        & is_valid_category(F.col("category_l1"), F.col("category_l2"))
    )


def validate_bulk_decisions(decisions: DataFrame, required_keys: Sequence[str]) -> DataFrame:
    """Group decisions that name every required key (its value may be null) and a valid label."""
    d = F.col("decision")
    valid = decisions.filter(_is_object(d))
    for key in required_keys:
        valid = valid.filter(_has_key(d, key))
    return valid.select(
        *[_text(d, key).alias(key) for key in required_keys],
        _label(d, "category_l1").alias("category_l1"),
        _label(d, "category_l2").alias("category_l2"),
    ).filter(is_valid_category(F.col("category_l1"), F.col("category_l2")))


def validate_merchant_decisions(decisions: DataFrame) -> DataFrame:
    return validate_bulk_decisions(decisions, MERCHANT_GROUP)


def validate_pattern_decisions(decisions: DataFrame) -> DataFrame:
    return validate_bulk_decisions(decisions, PATTERN_GROUP)


def validate_recurring_decisions(decisions: DataFrame) -> DataFrame:
    """(merchant, direction) pairs whose ``is_recurring`` is JSON true, not "true" or 1."""
    d = F.col("decision")
    flag = _field(d, "is_recurring")
    return (
        decisions.filter(
            _is_object(d) & (_kind(flag) == "BOOLEAN") & F.try_variant_get(d, "$.is_recurring", "boolean")
        )
        .select(
            _text(d, "merchant_name_cleaned").alias("merchant_name_cleaned"),
            _text(d, "transaction_type").alias("transaction_type"),
        )
        .filter((F.col("merchant_name_cleaned") != "") & (F.col("transaction_type") != ""))
    )


def parse_conflict_answers(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """``rule_id`` of every rule that an external conflict answer asks to deactivate."""
    text = F.replace(F.replace(F.col(column), F.lit(FENCE_OPEN), F.lit("")), F.lit(FENCE), F.lit(""))
    document = F.try_parse_json(F.trim(text, F.lit(" \t\n\r\f")))
    ids = F.try_variant_get(document, "$.rules_to_deactivate", "array<string>")
    return payloads.select(F.explode(ids).alias("rule_id")).filter(F.col("rule_id").isNotNull())


def valid_categories(labels: DataFrame) -> DataFrame:
    """Rows whose label pair is in the taxonomy."""
    return labels.filter(is_valid_category(F.col("category_l1"), F.col("category_l2")))


def contradicts_direction() -> Column:
    """A debit labelled Income, or a credit labelled neither Income nor Transfer."""
    return ((F.col("transaction_type") == "Debit") & (F.col("category_l1") == "Income")) | (
        (F.col("transaction_type") == "Credit") & ~F.col("category_l1").isin("Income", "Transfer")
    )


def direction_violations(labels: DataFrame) -> DataFrame:
    """Labelled rows or decisions that break the direction rule given to labellers."""
    return labels.filter(contradicts_direction())


def _obeying(decisions: DataFrame, enforce_direction: bool) -> DataFrame:
    if not enforce_direction:
        return decisions
    return decisions.filter(~F.coalesce(contradicts_direction(), F.lit(False)))


def apply_merchant_decisions(
    transactions: DataFrame, decisions: DataFrame, as_of: Column, *, on_duplicate: str = "error",
    enforce_direction: bool = False, observation: Observation | None = None,
) -> DataFrame:
    """Label the unlabelled rows of each decided (merchant, direction, persona) group."""
    return keyed_update(
        transactions,
        _obeying(decisions, enforce_direction).select(*MERCHANT_GROUP, "category_l1", "category_l2"),
        on=MERCHANT_GROUP,
        null_safe=("persona_type",),
        rows=is_unlabelled(),
        on_duplicate=on_duplicate,
        observation=observation,
        assign=_labels(METHOD_BULK_MERCHANT, as_of),
    )


def apply_pattern_decisions(
    transactions: DataFrame, decisions: DataFrame, as_of: Column, *, on_duplicate: str = "error",
    enforce_direction: bool = False, observation: Observation | None = None,
) -> DataFrame:
    """Label the unlabelled rows of each decided (prefix, direction, channel, persona) group."""
    updated = keyed_update(
        with_description_prefix(transactions),
        _obeying(decisions, enforce_direction).select(*PATTERN_GROUP, "category_l1", "category_l2"),
        on=PATTERN_GROUP,
        null_safe=("persona_type",),
        rows=is_unlabelled(),
        on_duplicate=on_duplicate,
        observation=observation,
        assign=_labels(METHOD_BULK_PATTERN, as_of),
    )
    return updated.drop("description_prefix")


def apply_transaction_decisions(
    transactions: DataFrame, decisions: DataFrame, as_of: Column, *, on_duplicate: str = "error",
    observation: Observation | None = None,
) -> DataFrame:
    """Label unlabelled rows one by one, with the labeller's confidence."""
    return keyed_update(
        transactions,
        decisions.select("transaction_id", "category_l1", "category_l2", "llm_confidence_score"),
        on=["transaction_id"],
        rows=is_unlabelled(),
        on_duplicate=on_duplicate,
        observation=observation,
        assign={**_labels(METHOD_SINGLE, as_of), "llm_confidence_score": new("llm_confidence_score")},
    )


def _labels(method: str, as_of: Column) -> dict[str, Column]:
    return {
        "category_l1": new("category_l1"),
        "category_l2": new("category_l2"),
        "categorization_method": F.lit(method),
        "categorization_update_timestamp": as_of,
    }


def decision_summary(decisions: DataFrame) -> DataFrame:
    """Validated decisions per label."""
    return decisions.groupBy("category_l1", "category_l2").agg(F.count(F.lit(1)).alias("count"))
