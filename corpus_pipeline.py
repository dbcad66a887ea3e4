"""A corpus from raw documents to packed sequences: stages that each apply one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger_spark.llm import line_dedup, near_dedup, packing, quality_rules, repeats
from ledger_spark.llm.common import PRIVATE, read_table, stage, words_of

_DROPPED, _BYTES = PRIVATE + "dropped", PRIVATE + "bytes"


#: Bytes of a passage that no two places may share: fifty words of three letters and a space.
PASSAGE_BYTES = 200
#: A document that falls below this many words, which is what the quality rules ask for, leaves with the stage.
LEAST_WORDS = 10


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars brought up to date with the text, where the column exists."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def _with_words(docs: DataFrame) -> DataFrame:
    """The documents that still have enough words; those that a stage emptied, such as copies, go."""
    return docs.filter(F.size(words_of(F.col("text"))) >= LEAST_WORDS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that nearly repeat an earlier one, if enough is left of them."""
    return _with_words(_measured(line_dedup.remove_repeated_lines(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity of 0.8 or more)."""
    dropped = near_dedup.near_duplicates(docs, words=5).filter("NOT kept").select(F.col("doc_id").alias(_DROPPED))
    return docs.join(dropped, docs["doc_id"] == dropped[_DROPPED], "left_anti")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that recur anywhere, if at least half of the text and enough words are left."""
    sized = docs.withColumn(_BYTES, F.octet_length("text"))
    cut = repeats.remove_repeats(sized, length=PASSAGE_BYTES, gram=PASSAGE_BYTES // 4)
    return _with_words(_measured(cut.filter(2 * F.octet_length("text") >= F.col(_BYTES)).drop(_BYTES)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 4096 ids."""
    return packing.pack(packing.tokenize_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality rules", quality), ("line dedup", lines), ("near dedup", near_duplicates), ("suffix-array dedup", passages), ("packing", packed),
]

#: SQL can express neither MinHash nor packing by bin slack; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads the written table of the one before."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
