"""Incremental text cleansing: a projection, no join and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import clean_description, merchant_match, merchant_name


_MATCH = "__merchant_match"


def needs_cleansing() -> Column:
    return F.col("description_cleaned").isNull() | F.col("merchant_name_cleaned").isNull()


def cleanse_transactions(transactions: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Rewrite both cleaned columns of every row where either is NULL.

    A row whose merchant cannot be extracted keeps NULL and is visited again by the
    next run; its values do not change.
    """
    due = needs_cleansing()
    if observation is not None:
        transactions = transactions.observe(observation, F.count_if(due).alias("affected"))
    # A column of its own, so that the extraction is evaluated once although it is used twice.
    matched = transactions.withColumn(_MATCH, F.when(due, merchant_match(F.col("merchant_name_raw"))))
    return matched.withColumns(
        {
            "description_cleaned": F.when(due, clean_description(F.col("description_raw"))).otherwise(
                F.col("description_cleaned")
            ),
            "merchant_name_cleaned": F.when(due, merchant_name(F.col(_MATCH))).otherwise(
                F.col("merchant_name_cleaned")
            ),
        }
    ).drop(_MATCH)
