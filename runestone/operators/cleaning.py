"""Corpus-level cleaning: filters and impact on top of the column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions import text as tx


def clean_corpus(corpus: DataFrame, observation: Observation | None = None, languages: Sequence[str] = ()) -> DataFrame:
    """Replace ``text`` by its clean form, NULL as ''. Narrow: no group per language.

    ``observation`` gets the cleaning impact on these languages while the result is written (``observed_impact``).
    """
    filled = corpus.withColumn("text", F.coalesce("text", F.lit("")).cast("string"))
    cleaned = tx.sanitize(filled, "text", "_clean")
    if observation is not None:
        cleaned = cleaned.observe(observation, *_impact_metrics(languages, "text", "_clean"))
    return cleaned.withColumn("text", F.col("_clean")).drop("_clean")


def drop_ghosts(corpus: DataFrame, min_words: int = settings.MIN_WORDS) -> DataFrame:
    """Keep texts with at least ``min_words`` words; NULL counts as empty."""
    return corpus.filter(tx.has_words(F.col("text"), min_words))


def clean_and_drop(corpus: DataFrame, min_words: int = settings.MIN_WORDS, passes: int = 1) -> DataFrame:
    """Add ``clean_text`` and drop what is NULL, blank or too short once cleaned."""
    # Blank texts go first, before any of the cleaning is done for them.
    cleaned = tx.sanitize(corpus.filter(tx.has_words(F.col("text"), 1)), passes=passes)
    return cleaned.filter(tx.has_words(F.col("clean_text"), min_words))


def cleaning_columns(df: DataFrame, text: str = "text", clean: str = "clean_text") -> DataFrame:
    """Per document: characters removed and non-ASCII characters before."""
    return df.withColumn("chars_removed", F.length(text) - F.length(clean)).withColumn(
        "non_ascii_before", tx.non_ascii_count(F.col(text))
    )


def cleaning_impact(df: DataFrame) -> DataFrame:
    """Cleaning impact per language, in one pass."""
    measured = cleaning_columns(tx.sanitize(df))
    return measured.groupBy("language").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(F.col("chars_removed").cast("long")).alias("chars_removed"),
        F.sum(F.col("non_ascii_before").cast("long")).alias("non_ascii_before"),
    )


def _impact_metrics(languages: Sequence[str], text: str, clean: str) -> list:
    """The sums of ``cleaning_impact``, one of each for every language of a given list."""
    metrics = [F.count(F.lit(1)).alias("documents")]
    removed, non_ascii = F.length(text) - F.length(clean), tx.non_ascii_count(F.col(text))
    for i, language in enumerate(languages):
        here = F.col("language") == language
        metrics += [
            F.count_if(here).alias(f"documents_{i}"), F.sum(F.when(here, removed).otherwise(0).cast("long")).alias(f"removed_{i}"),
            F.sum(F.when(here, non_ascii).otherwise(0).cast("long")).alias(f"non_ascii_{i}"),
        ]
    return metrics


def observed_impact(spark: SparkSession, observation: Observation, languages: Sequence[str]) -> DataFrame:
    """The table of ``cleaning_impact`` from what was observed while a corpus was written.

    No pass of its own: the sums ride on the tasks that clean and write. It waits until the corpus is written. Languages
    without documents have no row. Where a lost executor makes Spark clean rows a second time, they may count twice.
    """
    seen = observation.get
    rows = [
        (language, seen[f"documents_{i}"], seen[f"removed_{i}"], seen[f"non_ascii_{i}"])
        for i, language in enumerate(languages) if seen.get(f"documents_{i}")
    ]
    return spark.createDataFrame(rows, "language string, documents long, chars_removed long, non_ascii_before long")
