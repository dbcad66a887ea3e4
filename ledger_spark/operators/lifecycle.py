"""Reset and fallback: row-wise projections over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schema import METHOD_FALLBACK, is_unlabelled

# llm_confidence_score is not among them: a reset leaves it in place.
RESET_COLUMNS = (
    "category_l1", "category_l2", "description_cleaned", "merchant_name_cleaned", "is_recurring", "rule_id",
    "categorization_method", "categorization_update_timestamp",
)


def reset_labels(transactions: DataFrame, confirm: bool = False) -> DataFrame:
    """Clear all labelling and cleansing columns of every row; refuses without ``confirm``."""
    if not confirm:
        raise ValueError("reset_labels clears all labels and cleaned texts; pass confirm=True to proceed")
    kinds = {f.name: f.dataType for f in transactions.schema.fields}
    return transactions.withColumns({c: F.lit(None).cast(kinds[c]) for c in RESET_COLUMNS})


def apply_fallback(transactions: DataFrame, as_of: Column, observation: Observation | None = None) -> DataFrame:
    """Label what is left: credits as other income, debits as other expense.

    An L1 without L2 is replaced as well, and a direction that is neither Debit nor
    Credit ends without labels but with the method set.
    """
    open_row = is_unlabelled()
    if observation is not None:
        transactions = transactions.observe(observation, F.count_if(open_row).alias("affected"))
    direction = F.col("transaction_type")

    def by_direction(credit: str, debit: str) -> Column:
        return F.when(direction == "Credit", F.lit(credit)).when(direction == "Debit", F.lit(debit))

    fallback = {
        "category_l1": by_direction("Income", "Expense"),
        "category_l2": by_direction("Other Income", "Other Expense"),
        "categorization_method": F.lit(METHOD_FALLBACK),
        "categorization_update_timestamp": as_of,
    }
    return transactions.withColumns(
        {name: F.when(open_row, value).otherwise(F.col(name)) for name, value in fallback.items()}
    )
