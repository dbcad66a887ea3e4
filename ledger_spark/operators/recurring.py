"""Recurring payments: gaps, candidates, flags and label harmonisation.

A merchant can hold a large share of all rows, so nothing here sorts or collects
the rows of a merchant in one place. Gaps between consecutive rows are derived from
the merchant's distinct days: within a day all gaps are zero, and the first row of a
day is as far from its predecessor as the two days are apart. A merchant has as many
days as the calendar allows, whatever its row count.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..schema import METHOD_HARMONIZED, METHOD_RECURRING, has_text, is_unlabelled
from ..sources.staging import Staging
from .update import broadcast_limited, fits_broadcast, keyed_update, new

MERCHANT_KEY = ("merchant_name_cleaned", "transaction_type")
# Words that hint at a subscription, rows a candidate needs, default batch.
RECURRING_WORDS = "monthly|weekly|annual|subscription|membership|recurring|plan"
MIN_CANDIDATE_ROWS = 5
EXAMPLES_PER_CANDIDATE = 2


def _not_yet_recurring() -> Column:
    return F.col("is_recurring").isNull() | ~F.col("is_recurring")


def open_debits(transactions: DataFrame) -> DataFrame:
    """Debits with a merchant that are not flagged as recurring, with their calendar day."""
    return transactions.filter(
        _not_yet_recurring() & has_text("merchant_name_cleaned") & (F.col("transaction_type") == "Debit")
    ).withColumn("day", F.to_date("transaction_date"))


def _with_previous_day(days: DataFrame) -> DataFrame:
    """Add the merchant's previous day with any row. One row per merchant and day comes in."""
    window = Window.partitionBy(*MERCHANT_KEY).orderBy("day")
    return days.withColumn("gap_days", F.datediff("day", F.lag("day").over(window)))


def transaction_intervals(transactions: DataFrame) -> DataFrame:
    """Days since the previous row of the same merchant and direction, per row.

    Rows are ordered by time, then id. The first row, and rows without a date, have NULL.
    """
    rows = open_debits(transactions)
    days = (
        rows.filter(F.col("day").isNotNull())
        .groupBy(*MERCHANT_KEY, "day")
        .agg(F.min_by("transaction_id", F.struct("transaction_date", "transaction_id")).alias("first_id"))
    )
    firsts = _with_previous_day(days)
    # A row after an undated one has NULL as well, which is what the first day gives.
    gap = F.when(F.col("transaction_id") == F.col("first_id"), F.col("gap_days")).when(
        F.col("day").isNotNull(), F.lit(0)
    )
    return rows.join(firsts, [*MERCHANT_KEY, "day"], "left").select(
        "transaction_id", *MERCHANT_KEY, "transaction_date", "amount", gap.alias("days_since_last_txn")
    )


def interval_histogram(transactions: DataFrame) -> DataFrame:
    """All gaps of a merchant as (days, n) pairs in ascending order: complete, and bounded by the calendar."""
    days = (
        open_debits(transactions)
        .filter(F.col("day").isNotNull())
        .groupBy(*MERCHANT_KEY, "day")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    steps = _with_previous_day(days).select(
        *MERCHANT_KEY,
        F.explode(
            F.array(
                F.struct(F.col("gap_days").alias("days"), F.lit(1).cast("bigint").alias("n")),
                F.struct(F.lit(0).alias("days"), (F.col("n_rows") - 1).alias("n")),
            )
        ).alias("step"),
    ).select(*MERCHANT_KEY, "step.*").filter(F.col("days").isNotNull() & (F.col("n") > 0))
    return (
        steps.groupBy(*MERCHANT_KEY, "days")
        .agg(F.sum("n").alias("n"))
        .groupBy(*MERCHANT_KEY)
        .agg(F.sort_array(F.collect_list(F.struct("days", "n"))).alias("transaction_intervals_days"))
    )


def expand_intervals(histogram: Column) -> Column:
    """A histogram of gaps as a plain array of gaps. Only for merchants of known, moderate size."""
    return F.flatten(F.transform(histogram, lambda h: F.array_repeat(h["days"], h["n"].cast("int"))))


def latest_examples(rows: DataFrame, key: tuple[str, ...], order: list[Column], fields: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows per key as an array of structs.

    The row-number filter is applied by Spark before the shuffle too, so each task
    sends at most ``limit`` rows per key.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return (
        rows.select(*dict.fromkeys([*key, *fields, "transaction_id", "transaction_date"]))
        .withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= limit)
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(F.struct("rank", *fields))).alias("ranked"))
        .select(
            *key,
            F.transform("ranked", lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias("example_transactions"),
        )
    )


# What evidence is made of; all other columns stay behind when rows are staged.
EVIDENCE_COLUMNS = ("transaction_id", *MERCHANT_KEY, "is_recurring", "transaction_date", "amount", "description_cleaned")


def _staged_evidence(transactions: DataFrame, staging: Staging) -> DataFrame:
    return staging.table(open_debits(transactions).select(*EVIDENCE_COLUMNS), "open-debits")


def _candidate_groups(transactions: DataFrame) -> DataFrame:
    mentions = F.lower(F.coalesce("description_cleaned", F.lit(""))).rlike(RECURRING_WORDS)
    return (
        open_debits(transactions)
        .groupBy(*MERCHANT_KEY)
        .agg(
            F.count("transaction_id").alias("transaction_count"),
            F.bool_or(mentions).alias("has_recurring_keywords"),
            F.coalesce(F.stddev_samp(F.abs("amount")), F.lit(0.0)).alias("stddev_amount"),
            F.coalesce(F.avg(F.abs("amount")), F.lit(0.0)).alias("avg_amount"),
        )
        .filter(F.col("transaction_count") >= MIN_CANDIDATE_ROWS)
    )


def _ranking() -> list[Column]:
    return [F.desc("has_recurring_keywords"), F.desc("transaction_count"), *[F.asc(c) for c in MERCHANT_KEY]]


def _with_evidence(groups: DataFrame, transactions: DataFrame) -> DataFrame:
    examples = latest_examples(
        open_debits(transactions),
        MERCHANT_KEY,
        [F.desc("transaction_date"), F.asc("transaction_id")],
        ["description_cleaned", "amount", "transaction_date"],
        EXAMPLES_PER_CANDIDATE,
    )
    return (
        groups.join(interval_histogram(transactions), [*MERCHANT_KEY], "left")
        .join(examples, [*MERCHANT_KEY], "left")
        .select(
            *MERCHANT_KEY, "transaction_count", "transaction_intervals_days", "has_recurring_keywords",
            "stddev_amount", "avg_amount", "example_transactions",
        )
        .orderBy(*_ranking())
    )


def recurring_candidates(transactions: DataFrame, batch_size: int | None = None,
                         staging: Staging | None = None) -> DataFrame:
    """Merchants that may be recurring, with the evidence to decide on.

    Evidence: row count, gap histogram, keyword flag, sample deviation and mean of the
    absolute amount, two latest rows. Keyword merchants first, then the most frequent.
    ``batch_size`` keeps the first so many. With ``staging`` the transactions are
    scanned once, for a narrow table that serves all three kinds of evidence.
    """
    rows = transactions if staging is None else _staged_evidence(transactions, staging)
    groups = _candidate_groups(rows)
    if batch_size is None:
        return _with_evidence(groups, rows)
    return _batch_evidence(groups.orderBy(*_ranking()).limit(batch_size), rows, batch_size, staging, "candidate-groups")


def _batch_evidence(groups: DataFrame, rows: DataFrame, batch_size: int, staging: Staging | None, name: str) -> DataFrame:
    groups = broadcast_limited(staging.table(groups, name) if staging is not None else groups, batch_size)
    return _with_evidence(groups, rows.join(groups.select(*MERCHANT_KEY), [*MERCHANT_KEY], "left_semi"))


def candidate_rounds(transactions: DataFrame, batch_size: int, staging: Staging, max_rounds: int) -> Iterator[DataFrame]:
    """Batches of ``batch_size`` candidates until none is left; no merchant comes twice, whatever was decided on it.

    Groups are computed once. Keys that were offered are added to a staged table, and each round takes
    the best groups that are not in it.
    """
    rows = _staged_evidence(transactions, staging)
    groups = staging.table(_candidate_groups(rows), "candidate-groups")
    offered = staging.path("offered")
    for number in range(1, max_rounds + 1):
        left = groups
        if number > 1:
            known = groups.sparkSession.read.schema(groups.select(*MERCHANT_KEY).schema).parquet(offered)
            left = groups.join(known, [*MERCHANT_KEY], "left_anti")
        batch = staging.table(left.orderBy(*_ranking()).limit(batch_size), f"round-{number}")
        if batch.isEmpty():
            return
        batch.select(*MERCHANT_KEY).write.mode("append").parquet(offered)
        yield _batch_evidence(batch, rows, batch_size, None, "")


def flag_recurring(transactions: DataFrame, flags: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Mark the rows of the given (merchant, direction) pairs as recurring, unless they are already.

    Overwrites the method but neither labels nor the update time.
    """
    return keyed_update(
        transactions,
        flags.select(*MERCHANT_KEY).distinct(),
        on=MERCHANT_KEY,
        rows=_not_yet_recurring(),
        on_duplicate="unique",
        observation=observation,
        assign={"is_recurring": F.lit(True), "categorization_method": F.lit(METHOD_RECURRING)},
    )


def trusted_recurring_labels(transactions: DataFrame) -> DataFrame:
    """The most frequent label of each recurring merchant and direction; ties go to the smaller label."""
    per_label = (
        transactions.filter(F.col("is_recurring") & F.col("merchant_name_cleaned").isNotNull() & ~is_unlabelled())
        .groupBy(*MERCHANT_KEY, "category_l1", "category_l2")
        .agg(F.count(F.lit(1)).alias("category_count"))
    )
    label = F.struct("category_l1", "category_l2", "category_count")
    order = F.struct(-F.col("category_count"), "category_l1", "category_l2")
    return (
        per_label.groupBy(*MERCHANT_KEY).agg(F.min_by(label, order).alias("label")).select(*MERCHANT_KEY, "label.*")
    )


def harmonize_recurring(transactions: DataFrame, as_of: Column, *, trusted: DataFrame | None = None,
                        observation: Observation | None = None) -> DataFrame:
    """Give unlabelled recurring rows the trusted label of their merchant and direction.

    ``trusted`` takes labels that were computed and written before; they are broadcast
    if they are few.
    """
    small = trusted is not None and fits_broadcast(trusted)
    trusted = trusted_recurring_labels(transactions) if trusted is None else trusted
    return keyed_update(
        transactions,
        trusted,
        on=MERCHANT_KEY,
        rows=F.col("is_recurring") & is_unlabelled(),
        on_duplicate="unique",
        small_source=small,
        observation=observation,
        assign={
            "category_l1": new("category_l1"),
            "category_l2": new("category_l2"),
            "categorization_method": F.lit(METHOD_HARMONIZED),
            "categorization_update_timestamp": as_of,
        },
    )
