"""Table schemas, fixed values and idempotent schema preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSACTIONS_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("account_id", T.StringType(), False),
        T.StructField("consumer_name", T.StringType()),
        T.StructField("persona_type", T.StringType()),
        T.StructField("institution_name", T.StringType()),
        T.StructField("account_type", T.StringType()),
        T.StructField("transaction_date", T.TimestampType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("is_recurring", T.BooleanType()),
        T.StructField("description_raw", T.StringType()),
        T.StructField("description_cleaned", T.StringType()),
        T.StructField("merchant_name_raw", T.StringType()),
        T.StructField("merchant_name_cleaned", T.StringType()),
        T.StructField("category_l1", T.StringType()),
        T.StructField("category_l2", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("categorization_update_timestamp", T.TimestampType()),
        T.StructField("categorization_method", T.StringType()),
        T.StructField("rule_id", T.StringType()),
    ]
)

RULES_SCHEMA = T.StructType(
    [
        T.StructField("rule_id", T.StringType()),
        T.StructField("rule_type", T.StringType()),
        T.StructField("identifier", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("persona_type", T.StringType()),
        T.StructField("category_l1", T.StringType()),
        T.StructField("category_l2", T.StringType()),
        T.StructField("is_recurring_rule", T.BooleanType()),
        T.StructField("confidence_score", T.LongType()),
        T.StructField("created_timestamp", T.TimestampType()),
        T.StructField("last_updated_timestamp", T.TimestampType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

# Columns that identify a rule for every upsert; persona is compared null-safely.
RULE_KEY = ("identifier", "rule_type", "transaction_type", "persona_type")

# The two-level label taxonomy.
TAXONOMY: dict[str, tuple[str, ...]] = {
    "Income": ("Gig Income", "Payroll", "Other Income", "Refund", "Interest Income"),
    "Expense": (
        "Groceries",
        "Pharmacy",
        "Office Supplies",
        "Food & Dining",
        "Coffee Shop",
        "Shopping",
        "Entertainment",
        "Health & Wellness",
        "Auto & Transport",
        "Travel & Vacation",
        "Software & Tech",
        "Medical",
        "Insurance",
        "Bills & Utilities",
        "Fees & Charges",
        "Business Services",
        "Other Expense",
        "Loan Payment",
    ),
    "Transfer": ("Credit Card Payment", "Internal Transfer", "ATM Withdrawal"),
}

# Provenance written to categorization_method. Learning reads them back.
METHOD_RULES_PREFIX = "rules-based-"
METHOD_HARMONIZED = "rules-based-recurring-harmonization"
METHOD_RECURRING = "llm-recurring-identification"
METHOD_BULK_MERCHANT = "llm-bulk-merchant-based"
METHOD_BULK_PATTERN = "llm-bulk-pattern-based"
METHOD_SINGLE = "llm-transaction-based"
METHOD_FALLBACK = "fallback"

# Fixed value: description prefix length that defines a pattern group.
PATTERN_PREFIX_LENGTH = 40


def taxonomy_frame(spark: SparkSession) -> DataFrame:
    """The taxonomy as a 26-row ``(category_l1, category_l2)`` frame, built on the JVM side."""
    pairs = [
        F.struct(F.lit(l1).alias("category_l1"), F.lit(l2).alias("category_l2"))
        for l1, l2s in TAXONOMY.items()
        for l2 in l2s
    ]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def is_valid_category(l1: Column, l2: Column) -> Column:
    """True when the pair is in the taxonomy (exact case); never NULL."""
    valid = F.lit(False)
    for name, l2s in TAXONOMY.items():
        valid = valid | ((l1 == name) & l2.isin(*l2s))
    return F.coalesce(valid, F.lit(False))


def is_unlabelled() -> Column:
    """A row every step but the rules engine treats as still to be labelled."""
    return F.col("category_l1").isNull() | F.col("category_l2").isNull()


def has_text(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add absent columns as typed NULLs; existing columns stay untouched."""
    missing = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def prepare_transactions_schema(transactions: DataFrame) -> DataFrame:
    return add_missing_columns(transactions, {"llm_confidence_score": "bigint"})


def prepare_rules_schema(rules: DataFrame) -> DataFrame:
    """Ensure ``is_active`` exists and backfill it with TRUE where it is NULL."""
    rules = add_missing_columns(rules, {"is_active": "boolean"})
    return rules.withColumn("is_active", F.coalesce("is_active", F.lit(True)))
