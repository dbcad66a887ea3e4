"""The four audit reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import is_unlabelled
from ..sources.staging import Staging


def status_by_persona(transactions: DataFrame) -> DataFrame:
    """Rows per persona and L1 label, the unlabelled included."""
    return (
        transactions.groupBy(
            F.coalesce("persona_type", F.lit("Unknown")).alias("persona"),
            F.coalesce("category_l1", F.lit("Uncategorized")).alias("category"),
        )
        .agg(F.count("transaction_id").alias("transaction_count"))
        .orderBy("persona", F.desc("transaction_count"), "category")
    )


def missing_labels(transactions: DataFrame) -> DataFrame:
    """Rows lacking a label, by which label is missing, direction and channel."""
    no_l1, no_l2 = F.col("category_l1").isNull(), F.col("category_l2").isNull()
    issue = (
        F.when(no_l1 & no_l2, "Missing L1 & L2").when(no_l1, "Missing L1 Only").when(no_l2, "Missing L2 Only")
    )
    return (
        transactions.filter(is_unlabelled())
        .groupBy(
            F.coalesce("persona_type", F.lit("Unknown")).alias("persona"),
            issue.alias("issue_type"),
            "transaction_type",
            "channel",
        )
        .agg(F.count("transaction_id").alias("transaction_count"))
        .orderBy("persona", F.desc("transaction_count"), "issue_type", "transaction_type", "channel")
    )


def direction_mismatch(transactions: DataFrame) -> DataFrame:
    """Rows whose label contradicts their direction or sign, largest amount first."""
    l1, direction, amount = F.col("category_l1"), F.col("transaction_type"), F.col("amount")
    wrong_income = (l1 == "Income") & ((direction == "Debit") | (amount < 0))
    wrong_expense = (l1 == "Expense") & ((direction == "Credit") | (amount > 0))
    return (
        transactions.filter(wrong_income | wrong_expense)
        .select(
            "transaction_id", "persona_type", "transaction_type", "category_l1", "category_l2",
            "merchant_name_cleaned", "amount",
        )
        .orderBy(F.desc("amount"), "transaction_id")
    )


def inconsistent_recurring(transactions: DataFrame) -> DataFrame:
    """Recurring merchants with more than one L2 label within a persona.

    Rows are first counted per label, so the second aggregation sees one row per
    label of a merchant however many transactions the merchant has.
    """
    per_label = (
        transactions.filter(F.col("is_recurring") & F.col("merchant_name_cleaned").isNotNull())
        .groupBy("persona_type", "merchant_name_cleaned", "category_l2")
        .agg(F.count("transaction_id").alias("n"))
    )
    return (
        per_label.groupBy("persona_type", "merchant_name_cleaned")
        .agg(
            F.count("category_l2").alias("distinct_category_count"),
            F.sort_array(F.collect_list("category_l2")).alias("categories_assigned"),
            F.sum("n").alias("total_inconsistent_transactions"),
        )
        .filter(F.col("distinct_category_count") > 1)
        .orderBy("persona_type", F.desc("total_inconsistent_transactions"), "merchant_name_cleaned")
    )


REPORTS = {
    "status_by_persona": status_by_persona,
    "missing_labels": missing_labels,
    "direction_mismatch": direction_mismatch,
    "inconsistent_recurring": inconsistent_recurring,
}


def quality_report(transactions: DataFrame, staging: Staging) -> dict[str, DataFrame | Exception]:
    """All four audits, each computed and written by a job of its own.

    One that fails, in planning or while it runs, is reported by its error; the others are tables.
    """
    report: dict[str, DataFrame | Exception] = {}
    for name, build in REPORTS.items():
        try:
            report[name] = staging.table(build(transactions), name)
        except Exception as problem:  # each audit fails on its own
            report[name] = problem
    return report


def report_sizes(transactions: DataFrame, staging: Staging) -> DataFrame:
    """(report, n_rows, error) of each audit; a failed one has its error's first line and no rows."""
    rows = []
    for name, result in quality_report(transactions, staging).items():
        failed = isinstance(result, Exception)
        error = (str(result).splitlines() or [type(result).__name__])[0] if failed else None
        if failed:
            sizes = transactions.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("n_rows"))
        else:
            sizes = result.agg(F.count(F.lit(1)).alias("n_rows"))
        rows.append(sizes.select(F.lit(name).alias("report"), "n_rows", F.lit(error).cast("string").alias("error")))
    return reduce(DataFrame.unionByName, rows)
