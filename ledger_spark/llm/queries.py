"""Registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import collocations, id_files, line_dedup, near_dedup, nearest, packing, pieces, quality_rules, repeats, sharding, toxicity, warc, whitening
from .common import read_table
from .oracle import COLLOCATIONS, QUALITY

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of each text, and whether decoding gives the text back (but for the mark that stands for a space)."""
    docs = read_table(spark, folder, "documents")
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as model:
        table = pieces.read_model(model.read())
    return pieces.digest(pieces.encode(docs, table), table)


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    out = warc.round_trip(read_table(spark, folder, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeats_digest(read_table(spark, folder, "documents"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge_quality(read_table(spark, folder, "documents"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(read_table(spark, folder, "documents"))


def op6_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(read_table(spark, folder, "embeddings"), recall=0.95)


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, folder, "documents"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.tokenize_pieces(read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score_toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(read_table(spark, folder, "documents"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read_table(spark, folder, "documents"))


def op12_id_files(spark: SparkSession, folder: str) -> DataFrame:
    return id_files.id_file_report(read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitening_report(read_table(spark, folder, "embeddings"))


def queries() -> dict[str, Query]:
    named = (
        op1_sentencepiece, op2_warc, op3_suffix_array_dedup, op4_quality_rules, op5_line_dedup, op6_nearest, op7_minhash,
        op8_packing, op9_toxicity, op10_sharding, op11_collocations, op12_id_files, op13_whitening,
    )
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {"op4_quality_rules": QUALITY, "op11_collocations": COLLOCATIONS}
