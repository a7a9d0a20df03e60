"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.

Defined results: a null or empty text has fewer than 50 words, so the quality rules reject it, as they do
any short text. Rows without a doc_id, source or language go through all stages; a null doc_id
stays null. Very long texts are read whole, and cut into pieces only when they are packed. Of equal rows, and of texts that are
alike, one stays after the near-duplicate stage; rows of one doc_id with different texts are judged by their
texts. Other columns, whatever their names, are kept up to the last stage. An empty table gives an empty table of the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runestone.llm import curriculum, line_dedup, line_quality, near_dedup, packing
from runestone.llm.queries import tokenizer_path
from runestone.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that fail them."""
    return line_quality.clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a later document repeats."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return near_dedup.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy that the mix takes, in training order."""
    return curriculum.training_order(curriculum.mix(docs)).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their place in a sequence; a document taken twice is packed twice."""
    pieces = packing.tokenize(docs, tokenizer_path())
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("source_mix", mixture),
    ("packing", sequences),
]

# SQL cannot tokenize; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settle(docs)
    return docs
