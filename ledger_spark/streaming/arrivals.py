"""Cleansing and rule labelling of newly arriving rows, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..operators.cleansing import cleanse_transactions
from ..operators.rules import apply_rules
from ..schema import prepare_transactions_schema
from ..sources.staging import Staging, is_written


def _fixed(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; written first unless an earlier attempt has done so to the end."""
    if not is_written(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def label_arrivals(
    arrivals: DataFrame, load_rules: Callable[[SparkSession], DataFrame], table_path: str, checkpoint: str
) -> DataStreamWriter:
    """Writer that cleanses and labels each micro-batch and adds it to the table.

    Ranking rules is not row-wise, so it runs in ``foreachBatch``. Each micro-batch
    owns one ``batch_id`` partition and overwrites it when Spark replays the batch. The
    rules and the time of a batch are written beside the checkpoint when it first runs,
    and a replay reads those: it gives equal rows whatever became of the rules since.
    Cleansed rows are written once for their uses and removed afterwards.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        inputs = f"{checkpoint}-inputs/batch_id={batch_id}"
        began = _fixed(spark, f"{inputs}/began", lambda: spark.range(1).select(F.current_timestamp().alias("as_of"))).first()["as_of"]
        rules = _fixed(spark, f"{inputs}/rules", lambda: load_rules(spark))
        staging = Staging(spark, f"{checkpoint}-inputs")
        rows = staging.table(cleanse_transactions(prepare_transactions_schema(batch)), "cleansed")
        labelled = apply_rules(rows, rules, F.lit(began), staging=staging)
        labelled.write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")
        staging.delete()

    return arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
