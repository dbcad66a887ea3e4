"""Rule scores, rule ranking and deterministic rule ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores given to rules that do not come from group counts.
USER_RULE_SCORE = 99
SINGLE_ROW_RULE_SCORE = 95
# Fixed value: labeller confidence from which a single row may become a rule.
CONFIDENT_SINGLE_ROW = 9

_FIELD_SEPARATOR = "\u001f"


def confidence_score(count: Column) -> Column:
    """Score of a rule backed by ``count`` rows.

    Not monotonic on purpose: 14 rows score 96 and 15 rows score 80.
    """
    return (
        F.when(count >= 15, 80 + F.least(F.lit(14), count - 15))
        .when(count >= 5, 60 + (count - 5) * 4)
        .when(count >= 3, F.lit(50))
        .otherwise(F.lit(0))
        .cast("bigint")
    )


def descending_nulls_last(value: Column) -> list[Column]:
    """Sort key parts that order ``value`` descending, NULLs last, when compared ascending."""
    return [value.isNull(), -value]


def rule_rank(confidence: Column, last_updated: Column, rule_id: Column) -> list[Column]:
    """Ascending sort key: higher score first, then the more recent rule, then the id."""
    return [
        *descending_nulls_last(confidence),
        *descending_nulls_last(F.unix_micros(last_updated.cast("timestamp"))),
        rule_id,
    ]


def stable_rule_id(rule_type: Column, identifier: Column, transaction_type: Column, persona: Column,
                   *labels: Column) -> Column:
    """Rule id derived from the rule's key, so that recomputed tasks give the same id."""
    parts = [rule_type, identifier, transaction_type, persona, *labels]
    return F.sha2(F.concat_ws(_FIELD_SEPARATOR, *[F.coalesce(p, F.lit("")) for p in parts]), 256)
