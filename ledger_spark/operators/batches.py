"""Work batches for a labeller: frequent groups with examples, and single rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PATTERN_PREFIX_LENGTH, has_text, is_unlabelled
from ..sources.staging import Staging
from .recurring import latest_examples
from .update import broadcast_limited, key_condition

# Rows a group needs, examples per group.
MIN_GROUP_ROWS = 2
MERCHANT_EXAMPLES = 3
PATTERN_EXAMPLES = 2

MERCHANT_GROUP = ("merchant_name_cleaned", "transaction_type", "persona_type")
PATTERN_GROUP = ("description_prefix", "transaction_type", "channel", "persona_type")
SINGLE_ROW_COLUMNS = (
    "transaction_id", "description_cleaned", "merchant_name_cleaned", "amount", "transaction_type", "persona_type",
    "channel", "account_type",
)


def _not_transfer() -> Column:
    return ~F.col("category_l1").eqNullSafe(F.lit("Transfer"))


def with_description_prefix(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("description_prefix", F.substring("description_cleaned", 1, PATTERN_PREFIX_LENGTH))


def _top_groups(rows: DataFrame, key: tuple[str, ...], batch_size: int | None) -> DataFrame:
    groups = (
        rows.groupBy(*key)
        .agg(F.count("transaction_id").alias("uncategorized_count"))
        .filter(F.col("uncategorized_count") >= MIN_GROUP_ROWS)
    )
    if batch_size is None:
        return groups
    ranking = [F.desc("uncategorized_count"), *[F.asc_nulls_first(c) for c in key]]
    return groups.orderBy(*ranking).limit(batch_size)


def top_merchant_groups(transactions: DataFrame, batch_size: int | None = None) -> DataFrame:
    """All (merchant, direction, persona) groups among unlabelled rows that are no transfers, or the ``batch_size`` most frequent."""
    rows = transactions.filter(is_unlabelled() & has_text("merchant_name_cleaned") & _not_transfer())
    return _top_groups(rows, MERCHANT_GROUP, batch_size)


def top_pattern_groups(transactions: DataFrame, batch_size: int | None = None) -> DataFrame:
    """All (description prefix, direction, channel, persona) groups, or the most frequent, as for merchants."""
    rows = transactions.filter(is_unlabelled() & has_text("description_cleaned") & _not_transfer())
    return _top_groups(with_description_prefix(rows), PATTERN_GROUP, batch_size)


def _with_examples(groups: DataFrame, rows: DataFrame, key: tuple[str, ...], order: list[Column], fields: list[str],
                   limit: int, batch_size: int | None, staging: Staging | None) -> DataFrame:
    """Attach examples. Groups match rows on all keys, the persona null-safely; other NULLs match nothing.

    A limited set of groups is used twice, to pick rows and to attach counts; with
    ``staging`` it is computed once.
    """
    candidates = rows.filter(F.expr(" AND ".join(f"{k} IS NOT NULL" for k in key if k != "persona_type")))
    group_key = {k: F.col(f"g_{k}") for k in key}
    row_key = {k: F.col(k) for k in key}
    keyed = groups.select(*[F.col(k).alias(f"g_{k}") for k in key], "uncategorized_count")
    if batch_size is not None:
        keyed = staging.table(keyed, "top-groups") if staging is not None else keyed
        keyed = broadcast_limited(keyed, batch_size)
        candidates = candidates.join(
            keyed.drop("uncategorized_count"), key_condition(row_key, group_key, ("persona_type",)), "left_semi"
        )
    examples = latest_examples(candidates, key, order, fields, limit)
    return keyed.join(examples, key_condition(group_key, row_key, ("persona_type",))).select(
        *key, "uncategorized_count", "example_transactions"
    )


def merchant_batch(transactions: DataFrame, batch_size: int | None = None,
                   staging: Staging | None = None) -> DataFrame:
    """Merchant groups with their three latest unlabelled rows; ``batch_size`` limits them to the most frequent."""
    return _with_examples(
        top_merchant_groups(transactions, batch_size),
        transactions.filter(is_unlabelled()),
        MERCHANT_GROUP,
        [F.desc("transaction_date"), F.asc("transaction_id")],
        ["description_cleaned", "amount", "channel", "is_recurring"],
        MERCHANT_EXAMPLES,
        batch_size,
        staging,
    )


def pattern_batch(transactions: DataFrame, batch_size: int | None = None,
                  staging: Staging | None = None) -> DataFrame:
    """Pattern groups with two unlabelled rows, by transaction id; ``batch_size`` limits them to the most frequent."""
    return _with_examples(
        top_pattern_groups(transactions, batch_size),
        with_description_prefix(transactions.filter(is_unlabelled())),
        PATTERN_GROUP,
        [F.asc("transaction_id")],
        ["description_cleaned", "merchant_name_cleaned", "amount", "is_recurring"],
        PATTERN_EXAMPLES,
        batch_size,
        staging,
    )


def transaction_batch(transactions: DataFrame, batch_size: int | None = None,
                      transaction_type: str | None = None) -> DataFrame:
    """Single unlabelled rows, optionally of one direction; ``batch_size`` takes the first in id order."""
    rows = transactions.filter(is_unlabelled() & _not_transfer())
    if transaction_type is not None:
        rows = rows.filter(F.col("transaction_type") == transaction_type)
    rows = rows.select(*SINGLE_ROW_COLUMNS)
    return rows if batch_size is None else rows.orderBy("transaction_id").limit(batch_size)
