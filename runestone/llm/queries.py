"""The thirteen operators as queries over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runestone.llm import byte_cnn, cotraining, curriculum, line_dedup, line_quality, near_dedup, packing, periodic_runs, pii, prefix_hash, score_lists, spelling, substring
from runestone.llm.common import documents
from runestone.sources.tables import spread


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(documents(spark, sf_dir))


def tokenizer_path() -> str:
    """The vocabulary of the packing query, as the tokenizers' package names it."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(documents(spark, sf_dir), tokenizer_path())
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No Python and no RDD here: the table is read as it lies.
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return curriculum.mix(docs).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"),
        F.size("mix_times").alias("copies"), F.round(F.get("mix_times", F.lit(0)), 9).alias("first_time"),
    )


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return near_dedup.near_duplicates(docs, shingle=2).drop("text_key")


def window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = substring.remove_intervals(docs, substring.removal_intervals(docs))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return cotraining.classify(documents(spark, sf_dir), labels)


def prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hash.fingerprints(documents(spark, sf_dir))


# The key of this query's pseudonyms. Whoever must not be able to undo them keeps a secret one.
PSEUDONYM_KEY = b"key of the registered query"


def feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(documents(spark, sf_dir).select("doc_id", "text"), PSEUDONYM_KEY)


def byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return byte_cnn.identify(docs, byte_cnn.train(docs))


def sorted_list_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spread(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), "vec_id")
    return score_lists.top_k(vectors, F.col("vec_id") % 50 == 0)


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(documents(spark, sf_dir).select("doc_id", "text"))


def periodic_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest_runs(documents(spark, sf_dir).select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": quality_rules,
    "op2_best_fit_packing": best_fit_packing,
    "op3_cotrained_quality": cotrained_quality,
    "op4_prefix_fingerprints": prefix_fingerprints,
    "op5_feistel_pseudonyms": feistel_pseudonyms,
    "op6_line_bitmaps": line_bitmaps,
    "op7_byte_cnn_language": byte_cnn_language,
    "op8_source_mix": source_mix,
    "op9_minhash_near_dedup": minhash_near_dedup,
    "op10_window_dedup": window_dedup,
    "op11_sorted_list_search": sorted_list_search,
    "op12_spelling_variants": spelling_variants,
    "op13_periodic_runs": periodic_word_runs,
}
