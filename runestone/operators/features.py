"""TF-IDF as a table, and class weights."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runestone import settings
from runestone.operators.counts import shared_kinds, term_totals, text_by_text, word_counts
from runestone.operators.regression import places_of, row_sums
from runestone.operators.scaling import top_rows
from runestone.session import settle


def tfidf_vocabulary(df: DataFrame, max_features: int = settings.MAX_FEATURES, text: str = "text",
                     key: str = "doc_id") -> DataFrame:
    """``(term, term_count, doc_count, idf)`` of the ``max_features`` commonest terms, ties by term."""
    return vocabulary_of(term_totals(df, text), max_features)


def vocabulary_of(totals: DataFrame, max_features: int = settings.MAX_FEATURES) -> DataFrame:
    """``tfidf_vocabulary`` from what ``term_totals`` counted; the NULL term counts the documents."""
    counts = settle(
        totals.select(F.explode(F.arrays_zip("terms", "term_counts", "doc_counts")).alias("t")).groupBy(F.col("t.terms").alias("term"))
        .agg(F.sum("t.term_counts").alias("term_count"), F.sum("t.doc_counts").alias("doc_count"))
    )
    n = counts.filter(F.col("term").isNull()).agg(F.coalesce(F.max("doc_count"), F.lit(0))).first()[0]
    kept = top_rows(counts.filter(F.col("term").isNotNull()), "term_count", "term", max_features)
    return kept.withColumn(
        "idf", F.log(F.lit(float(1 + n)) / (F.col("doc_count") + 1).cast("double")) + 1.0
    )


def tfidf_weights(df: DataFrame, vocabulary: DataFrame, text: str = "text", key: str = "doc_id",
                  max_bytes: int = settings.BROADCAST_MAX_BYTES, keep: Sequence[str] = ()) -> DataFrame:
    """``(key, term, weight)``, L2-normalised per document, computed inside the row; the columns ``keep`` come with every term.

    The vocabulary is part of the model: it is measured and sent to the workers. One
    larger than ``max_bytes`` raises.
    """
    vocabulary = settle(vocabulary.select("term", "idf"))
    size = vocabulary.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"{size} bytes of terms, more than {max_bytes}")
    shared = vocabulary.sparkSession.sparkContext.broadcast(tuple(vocabulary.toArrow().columns))
    kinds = shared_kinds(df.sparkSession)

    @F.arrow_udf("array<struct<term: string, weight: double>>")
    def weigh(texts: pa.Array) -> pa.Array:
        known, idf = (column.combine_chunks() for column in shared.value)
        # A term outside the vocabulary weighs nothing.
        idf = np.append(idf.to_numpy(zero_copy_only=False), 0.0)

        def documents(own: pa.Array) -> pa.Array:
            terms, rows, numbers, counts = word_counts(own, kinds.value)
            raw = idf[places_of(terms, known)][numbers] * counts
            kept = raw != 0
            rows, numbers, raw = rows[kept], numbers[kept], raw[kept]
            norms = np.sqrt(row_sums(rows, raw * raw, len(own)))
            ends = np.searchsorted(rows, np.arange(len(own) + 1))
            entries = pa.StructArray.from_arrays([terms.take(pa.array(numbers)), pa.array(raw / norms[rows])], ["term", "weight"])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)

        return text_by_text(documents, texts)

    weighed = df.withColumn("_terms", weigh(F.lower(F.col(text))))
    return weighed.select(key, *keep, F.explode("_terms").alias("t")).select(
        key, F.col("t.term").alias("term"), F.col("t.weight").alias("weight"), *keep
    ).filter(F.col("weight") > 0)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, n, weight)`` with balanced weights n / (k * n_c)."""
    counts = settle(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(label, "n", (total.cast("double") / (classes * F.col("n"))).alias("weight"))
