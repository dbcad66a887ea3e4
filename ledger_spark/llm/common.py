"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import Staging

#: ASCII white space: what lies between the words of a text, in every operator here.
WORD = r"[^\x20\x09-\x0D]+"

#: Begins the names of columns that operators add for themselves and drop again; callers' columns do not begin so.
PRIVATE = "__ledger_llm_"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return a frame over the written table."""
    return Staging(df.sparkSession).table(df, name)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text (null: none): runs of anything but ASCII white space."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)
