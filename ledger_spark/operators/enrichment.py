"""Deriving L1, direction, channel and calendar context of incoming rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_description_simple

# Usual channel of each known merchant.
MERCHANT_CHANNELS = {
    "Whole Foods Market": "Point-of-Sale",
    "Trader Joe's": "Point-of-Sale",
    "Blue Bottle Coffee": "Point-of-Sale",
    "Chipotle": "Point-of-Sale",
    "Amazon.com": "Card-Not-Present",
    "Lululemon": "Card-Not-Present",
    "Netflix.com": "Card-Not-Present",
    "Spotify": "Card-Not-Present",
    "CVS Pharmacy": "Point-of-Sale",
    "SilverSneakers Fitness": "ACH",
    "Uber": "Card-Not-Present",
    "Expedia": "Card-Not-Present",
    "Carnival Cruise Line": "Card-Not-Present",
    "Shell Gas Station": "Point-of-Sale",
    "ADOBE INC": "Card-Not-Present",
    "Staples": "Point-of-Sale",
    "Home Depot": "Point-of-Sale",
    "University Bookstore": "Point-of-Sale",
    "City Hospital": "ACH",
    "GEICO": "ACH",
    "T-MOBILE": "ACH",
    "AARP": "ACH",
}
DEFAULT_CHANNEL = "Card-Not-Present"

# L2 labels that make a row income, and the one that makes it a transfer.
INCOME_L2 = ("Income", "Interest Income", "Refund", "Other Income")
PEER_TO_PEER = "Peer to Peer Transfer"
DEFAULT_L1 = "Expense"

# Keys an incoming row must have, and the text of a scheduled debit.
REQUIRED_KEYS = ("category_l2", "merchant_name_raw", "merchant_name_cleaned")
SCHEDULED_PREFIX = "ACH DEBIT - "


def l1_of(l2: Column) -> Column:
    return F.when(l2.isin(*INCOME_L2), F.lit("Income")).when(l2 == PEER_TO_PEER, F.lit("Transfer")).otherwise(
        F.lit(DEFAULT_L1)
    )


def derive_l1(rows: DataFrame) -> DataFrame:
    """Set ``category_l1`` from ``category_l2``; unknown labels are expenses."""
    return rows.withColumn("category_l1", l1_of(F.col("category_l2")))


def _is_credit() -> Column:
    l2 = F.col("category_l2")
    return F.coalesce(l2.isin(*INCOME_L2) | (l2 == PEER_TO_PEER), F.lit(False))


def normalize_direction(rows: DataFrame) -> DataFrame:
    """Credits get a positive amount, all others are debits with a negative one."""
    credit = _is_credit()
    return rows.withColumns(
        {
            "transaction_type": F.when(credit, "Credit").otherwise("Debit"),
            "amount": F.when(credit, F.abs("amount")).otherwise(-F.abs("amount")),
        }
    )


def derive_channel(rows: DataFrame) -> DataFrame:
    """Credits come by ACH (person to person: P2P), debits by the merchant's usual channel."""
    merchant = F.col("merchant_name_cleaned")
    by_merchant = F.lit(DEFAULT_CHANNEL)
    for channel in sorted(set(MERCHANT_CHANNELS.values()) - {DEFAULT_CHANNEL}):
        names = [name for name, usual in MERCHANT_CHANNELS.items() if usual == channel]
        by_merchant = F.when(merchant.isin(*names), F.lit(channel)).otherwise(by_merchant)
    return rows.withColumn(
        "channel",
        F.when(F.col("category_l2") == PEER_TO_PEER, F.lit("P2P"))
        .when(_is_credit(), F.lit("ACH"))
        .otherwise(by_merchant),
    )


def drop_incomplete(rows: DataFrame, keys: Sequence[str] = REQUIRED_KEYS) -> DataFrame:
    """Skip rows that miss a required key."""
    return rows.dropna(subset=list(keys))


def count_incomplete(rows: DataFrame, keys: Sequence[str] = REQUIRED_KEYS) -> DataFrame:
    """How many rows :func:`drop_incomplete` skips, as one row."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return rows.agg(F.count_if(missing).alias("rejected_rows"), F.count(F.lit(1)).alias("total_rows"))


def expand_schedule(bills: DataFrame, months: int, as_of: Column) -> DataFrame:
    """Each bill once per month, for the month of ``as_of`` and the months before it.

    A due day beyond the end of a month moves to its last day.
    """
    dated = bills.withColumn("months_ago", F.explode(F.sequence(F.lit(0), F.lit(months - 1))))
    month = F.trunc(F.add_months(F.to_date(as_of), -F.col("months_ago")), "month")
    day = F.least(F.col("day_of_month"), F.dayofmonth(F.last_day(month)))
    description = F.concat(F.lit(SCHEDULED_PREFIX), F.col("merchant_name"))
    return dated.select(
        *[c for c in bills.columns if c not in ("merchant_name", "day_of_month", "amount_mean")],
        F.date_add(month, day - 1).cast("timestamp").alias("transaction_date"),
        F.lit("Debit").alias("transaction_type"),
        F.round("amount_mean", 2).alias("amount"),
        F.lit(True).alias("is_recurring"),
        description.alias("description_raw"),
        clean_description_simple(description).alias("description_cleaned"),
        F.col("merchant_name").alias("merchant_name_raw"),
        F.col("merchant_name").alias("merchant_name_cleaned"),
        F.lit("ACH").alias("channel"),
    )


def annotate_events(months: DataFrame, events: DataFrame, on: Sequence[str] = ("consumer_name",)) -> DataFrame:
    """Give each consumer month the first event that covers it.

    An event covers the months ``end_month_ago`` < ``month_index`` <= ``start_month_ago``.
    Each event is expanded into the few months it covers, which turns the range join
    into an equi-join; the first event by ``position`` is chosen before joining.
    """
    covered = (
        events.filter(F.col("start_month_ago") > F.col("end_month_ago"))
        .withColumn("month_index", F.explode(F.sequence(F.col("end_month_ago") + 1, F.col("start_month_ago"))))
        .groupBy(*on, "month_index")
        .agg(F.min_by("name", F.struct("position", "name")).alias("active_event"))
    )
    return months.join(covered, [*on, "month_index"], "left")


def season_of(date: Column) -> Column:
    month = F.month(date)
    return F.when(month.isin(11, 12), F.lit("holiday")).when(month.isin(6, 7, 8), F.lit("summer"))


def season_tag(rows: DataFrame, date_column: str = "transaction_date") -> DataFrame:
    """Add ``season``: holiday in November and December, summer in June to August, else NULL."""
    return rows.withColumn("season", season_of(F.col(date_column)))


def enrich_incoming(rows: DataFrame) -> DataFrame:
    """All ingest steps in order: required keys, L1, direction and sign, channel, cleaned description."""
    steps = derive_channel(normalize_direction(derive_l1(drop_incomplete(rows))))
    return steps.withColumn("description_cleaned", clean_description_simple(F.col("description_raw")))
