"""Contiguous shards of equal bytes, cut from global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

_RUNNING = "doc_id bigint, size bigint, text_crc32 bigint, group_key string, part int, start bigint, rank bigint"


def _running_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bytes and rows before each row of its own partition, in the partition's order."""
    part, start, rank = TaskContext.get().partitionId(), 0, 0
    for rows in batches:
        ends = rows["size"].cumsum() + start
        yield rows.assign(part=part, start=ends - rows["size"], rank=range(rank, rank + len(rows)))
        if len(rows):
            start, rank = int(ends.iloc[-1]), rank + len(rows)


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, *, id_column: str = "doc_id", text_column: str = "text", group_share: float = 0.01
) -> DataFrame:
    """Shard and slot of each row, by the law of equal bytes.

    Rows are ordered by (SHA-256 of the text, id); partitions of that order report their bytes, the
    running total of these gives each row its global offset, and shard k takes the rows whose middle
    lies in the k-th of ``shards`` equal ranges. Equal texts are neighbours: a group of copies of at
    most ``group_share`` of a shard is judged by the middle of the whole group, so it is not torn
    apart; a larger one is cut where the target falls. Shards so differ from the equal share by
    ``group_share`` of it and one text at most.

    A null text counts as an empty one; each row has the size of its text in UTF-8 plus one byte, so
    empty texts are spread too. Repeated rows are rows of their own, null ids come first in their
    group, other columns are not read, an empty table gives an empty result. Only (id, size,
    checksum, digest) is shuffled, never a text.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(id_column).alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("group_key"),
    )
    # range partitioning by digest and id splits a large group of copies as well
    ordered = narrow.repartitionByRange("group_key", "doc_id").sortWithinPartitions("group_key", "doc_id")
    rows = stage(ordered.mapInPandas(_running_sums, _RUNNING), "ordered")

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
    )
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    placed = rows.join(F.broadcast(parts), "part").select(
        "doc_id", "size", "text_crc32", "group_key",
        (F.col("start") + F.col("bytes_before")).alias("start"), (F.col("rank") + F.col("rows_before")).alias("rank"),
    )
    groups = placed.groupBy("group_key").agg(
        F.min("start").alias("group_start"), F.sum("size").alias("group_bytes"), F.count("*").alias("n")
    ).filter((F.col("n") > 1) & (F.col("group_bytes") * shards <= group_share * total)).drop("n")
    twice_middle = F.coalesce(2 * F.col("group_start") + F.col("group_bytes"), 2 * F.col("start") + F.col("size"))
    exact = twice_middle.cast("decimal(28,0)") * F.lit(shards).cast("decimal(8,0)") / F.lit(max(1, 2 * total)).cast("decimal(28,0)")
    dealt = stage(
        placed.join(groups, "group_key", "left").select(
            "doc_id", "size", "text_crc32", "rank", F.least(F.floor(exact).cast("int"), F.lit(shards - 1)).alias("shard")
        ),
        "dealt",
    )
    first = dealt.groupBy("shard").agg(F.min("rank").alias("first_rank"))  # a row per shard
    return dealt.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("first_rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
