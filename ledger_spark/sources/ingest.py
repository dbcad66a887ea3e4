"""Typed JSON load into a Parquet table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TRANSACTIONS_SCHEMA


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job when a required column is NULL, as a load into a REQUIRED column does."""
    checked = {
        key: F.when(F.col(key).isNull(), F.raise_error(F.lit(f"required column {key} is missing"))).otherwise(F.col(key))
        for key in keys
    }
    return df.withColumns(checked) if checked else df


def read_transactions_json(spark: SparkSession, path: str, schema: T.StructType = TRANSACTIONS_SCHEMA) -> DataFrame:
    """JSON lines read with the fixed schema; malformed lines and missing required keys fail the job."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return require_keys(rows, [f.name for f in schema.fields if not f.nullable])


def ingest_json(spark: SparkSession, source: str, table_path: str, *, recreate: bool = False,
                schema: T.StructType = TRANSACTIONS_SCHEMA) -> DataFrame:
    """Load JSON lines into the table at ``table_path``: append, or recreate the table first."""
    rows = read_transactions_json(spark, source, schema)
    rows.write.mode("overwrite" if recreate else "append").parquet(table_path)
    return spark.read.schema(schema).parquet(table_path)
