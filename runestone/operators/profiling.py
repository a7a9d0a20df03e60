"""Corpus profiles.

Word lengths are first counted per (language, length): a table bounded by the
longest document, from which every statistic below is derived. Quantiles, outliers
and bins therefore never sort or gather documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions import text as tx
from runestone.session import settle

PERCENTS = [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
ALL = "*"


def missing_taxonomy(df: DataFrame, text: str = "text", min_words: int = settings.PROFILE_MIN_WORDS) -> DataFrame:
    """Null / blank / micro / valid counts and percentages; four rows, also when 0."""
    words = F.coalesce(tx.word_count(F.col(text)), F.lit(0))
    null = F.col(text).isNull()
    counted = df.select(null.alias("null"), words.alias("words")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("null").alias("n_null"),
        F.count_if(~F.col("null") & (F.col("words") == 0)).alias("n_blank"),
        F.count_if(~F.col("null") & (F.col("words") > 0) & (F.col("words") < min_words)).alias("n_micro"),
        F.count_if(~F.col("null") & (F.col("words") >= min_words)).alias("n_valid"),
    )
    rows = F.array(
        F.struct(F.lit("NaN / Null").alias("category"), F.col("n_null").alias("count")),
        F.struct(F.lit("Empty / Whitespace").alias("category"), F.col("n_blank").alias("count")),
        F.struct(F.lit(f"Micro (<{min_words} words)").alias("category"), F.col("n_micro").alias("count")),
        F.struct(F.lit("Valid").alias("category"), F.col("n_valid").alias("count")),
    )
    return counted.select("total", F.explode(rows).alias("row")).select(
        F.col("row.category").alias("category"),
        F.col("row.count").alias("count"),
        F.round(F.lit(100.0) * F.col("row.count") / F.nullif(F.col("total"), F.lit(0)), 2).alias("percent"),
    )


def _content_key(text: str):
    """128 bits of the stripped text, so the shuffle for distinct texts stays narrow."""
    return F.unhex(F.md5(tx.strip_edges(F.coalesce(F.col(text), F.lit("")))))


def _duplicate_counts(df: DataFrame, text: str) -> DataFrame:
    # Copies are first counted per content, map-side too, so a text that makes up a
    # third of the corpus reaches the reducer as one row per task.
    copies = df.groupBy(_content_key(text).alias("_content")).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("distinct_texts"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def duplicates(df: DataFrame, text: str = "text") -> DataFrame:
    """Exact copies of the stripped text."""
    return _duplicate_counts(df, text).withColumn(
        "duplicate_percent",
        F.round(F.lit(100.0) * F.col("duplicates") / F.nullif(F.col("total"), F.lit(0)), 2),
    )


def length_counts(df: DataFrame, text: str = "text", by: str = "language",
                  min_words: int = settings.PROFILE_MIN_WORDS) -> DataFrame:
    """Documents per (``by``, words), for documents of at least ``min_words``."""
    counted = (
        df.select(by, F.coalesce(tx.word_count(F.col(text)), F.lit(0)).alias("words"))
        .groupBy(by, "words").agg(F.count(F.lit(1)).alias("n"), F.max("words").alias("_words"))
    )
    # A filter on the grouping key would move below the aggregation and count the
    # words of every text twice; one on an aggregate stays here, on a small table.
    return counted.filter(F.col("_words") >= min_words).drop("_words")


def _describe_columns() -> list:
    n, words = F.col("n"), F.col("words").cast("long")
    total = F.sum(n)
    first, second = F.sum(n * words), F.sum(n * words * words)
    # Sums of integers, so the result does not depend on the order of the rows.
    spread = (second - first.cast("double") * first / total) / F.nullif(total - 1, F.lit(0))
    quantiles = F.percentile("words", F.array(*[F.lit(p) for p in PERCENTS]), n)
    return [
        total.alias("count"),
        F.round(first / total, 6).alias("mean"),
        F.when(total > 1, F.round(F.sqrt(F.greatest(spread, F.lit(0.0))), 6)).alias("std"),
        F.min("words").cast("long").alias("min"),
        *[F.round(quantiles[i], 6).alias(f"p{round(p * 100)}") for i, p in enumerate(PERCENTS)],
        F.max("words").cast("long").alias("max"),
    ]


def length_describe(df: DataFrame, text: str = "text", min_words: int = settings.PROFILE_MIN_WORDS,
                    strict: bool = False) -> DataFrame:
    """Word-length statistics of the whole corpus; ``strict`` raises when none is long enough."""
    lengths = length_counts(df, text, min_words=min_words)
    if strict and lengths.isEmpty():
        raise ValueError("no documents long enough to compute length statistics")
    return lengths.groupBy("words").agg(F.sum("n").alias("n")).agg(*_describe_columns())


def _quartiles() -> list:
    q = F.percentile("words", F.array(F.lit(0.25), F.lit(0.75)), F.col("n"))
    return [q[0].alias("q1"), q[1].alias("q3")]


def length_outliers(df: DataFrame, text: str = "text", min_words: int = settings.PROFILE_MIN_WORDS) -> DataFrame:
    """Documents outside the 1.5 IQR fences, over the whole corpus."""
    lengths = settle(
        length_counts(df, text, min_words=min_words).groupBy("words").agg(F.sum("n").alias("n"))
    )
    fences = lengths.agg(*_quartiles()).select(
        F.greatest(F.lit(0.0), F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lower"),
        (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("upper"),
    )
    lower, upper = fences.select("lower").scalar(), fences.select("upper").scalar()
    outside = (F.col("words") < lower) | (F.col("words") > upper)
    return lengths.select("words", "n", lower.alias("lower"), upper.alias("upper"), outside.alias("out")).agg(
        F.round(F.max("lower"), 6).alias("lower_bound"),
        F.round(F.max("upper"), 6).alias("upper_bound"),
        F.coalesce(F.sum(F.when(F.col("out"), F.col("n"))), F.lit(0)).alias("outliers"),
        F.round(
            F.lit(100.0) * F.coalesce(F.sum(F.when(F.col("out"), F.col("n"))), F.lit(0)) / F.sum("n"), 2
        ).alias("outlier_percent"),
    )


def length_histogram(df: DataFrame, text: str = "text", bins: int = 60,
                     min_words: int = settings.PROFILE_MIN_WORDS) -> DataFrame:
    """Equal-width bins from the shortest to the longest; the longest is in the last bin."""
    lengths = settle(
        length_counts(df, text, min_words=min_words).groupBy("words").agg(F.sum("n").alias("n"))
    )
    low = lengths.agg(F.min("words")).scalar()
    high = lengths.agg(F.max("words")).scalar()
    # Integer arithmetic puts a length that lies on an edge into the same bin everywhere.
    position = F.floor((F.col("words") - low).cast("long") * bins / F.greatest(high - low, F.lit(1)))
    return (
        lengths.select(F.least(position, F.lit(bins - 1)).cast("int").alias("bin"), "n")
        .groupBy("bin").agg(F.sum("n").alias("documents"))
    )


def class_distribution(df: DataFrame, target: str = "label_text") -> DataFrame:
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("documents")).orderBy(
        F.desc("documents"), target
    )


def class_imbalance(df: DataFrame, target: str = "label_text") -> DataFrame:
    """Most and least common class, names break ties, and the max / min ratio."""
    counts = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    largest = F.min(F.struct((-F.col("n")).alias("n"), F.col(target).alias("name")))
    smallest = F.min(F.struct(F.col("n").alias("n"), F.col(target).alias("name")))
    return counts.agg(largest.alias("largest"), smallest.alias("smallest"), F.count(F.lit(1)).alias("classes")).select(
        F.col("largest.name").alias("most_common"),
        (-F.col("largest.n")).alias("most_common_documents"),
        F.col("smallest.name").alias("least_common"),
        F.col("smallest.n").alias("least_common_documents"),
        "classes",
        F.round(-F.col("largest.n") / F.col("smallest.n"), 2).alias("imbalance_ratio"),
    )


def language_distribution(df: DataFrame, language: str = "language") -> DataFrame:
    """Documents per language; an empty table when the corpus has no language column."""
    if language not in df.columns:
        return df.sparkSession.createDataFrame([], f"{language} string, documents long")
    return df.groupBy(language).agg(F.count(F.lit(1)).alias("documents"))


def median_words_by_language(df: DataFrame, text: str = "text") -> DataFrame:
    return length_counts(df, text, min_words=0).groupBy("language").agg(
        F.percentile("words", F.lit(0.5), F.col("n")).alias("median_words")
    )


def profile_by_language(df: DataFrame, text: str = "text", min_words: int = 1) -> DataFrame:
    """The length profile of every language and of the whole corpus ('*'), in one pass."""
    return (
        length_counts(df, text, min_words=min_words)
        .rollup("language").agg(F.grouping("language").alias("_all"), *_describe_columns())
        .withColumn("language", F.when(F.col("_all") == 1, F.lit(ALL)).otherwise(F.col("language")))
        .drop("_all")
    )


def corpus_summary(df: DataFrame, text: str = "text", target: str = "label_text") -> DataFrame:
    """One row per language: size, words, blanks, copies, classes, imbalance.

    The texts are read once: copies have the same words, so word statistics and
    duplicates both come from the counts per content.
    """
    n, words, total = F.col("n"), F.col("words").cast("long"), F.sum("n")
    copies = df.groupBy("language", _content_key(text).alias("_content")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce(tx.word_count(F.col(text)), F.lit(0))).alias("words")
    )
    texts = copies.groupBy("language").agg(
        total.alias("documents"),
        F.percentile("words", F.lit(0.5), n).alias("median_words"),
        F.round(F.sum(words * n) / total, 1).alias("mean_words"),
        F.max(words).alias("max_words"),
        F.coalesce(F.sum(F.when(words == 0, n)), F.lit(0)).alias("empty"),
        F.sum(n - 1).alias("duplicates"),
    )
    # Rows without a class count as documents, not as a class.
    named = F.when(F.col(target).isNotNull(), n)
    classes = (
        df.groupBy("language", target).agg(F.count(F.lit(1)).alias("n"))
        .groupBy(F.col("language").alias("_language")).agg(
            F.count(target).alias("classes"), F.round(F.max(named) / F.min(named), 1).alias("imbalance")
        )
    )
    # One row per language on both sides, the documents without a language included.
    return texts.join(classes, F.col("language").eqNullSafe(F.col("_language"))).drop("_language")
