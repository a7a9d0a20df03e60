"""Batch scoring: language -> clean text -> class -> tags, in one plan without a shuffle.

The plan itself is lazy; names, profiles and gazetteers are measured while it is built.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions import arrays as ax
from runestone.functions.text import sanitize, strip_edges
from runestone.operators.language import LanguageProfiles, with_language
from runestone.operators.tagging import annotate as annotate_rows
from runestone.operators.tagging import tag_documents

# A scorer adds ``probability ARRAY<DOUBLE>`` computed from ``clean_text``.
Scorer = Callable[[DataFrame], DataFrame]

def length_scorer(classes: int) -> Scorer:
    """A stand-in model with confidences on both sides of a half.

    Class ``len(clean_text) % classes`` gets 0.3 to 0.9 by the length modulo 7, the class
    after it 0.25, the others 0.
    """

    def score(df: DataFrame) -> DataFrame:
        ids = F.sequence(F.lit(0), F.lit(classes - 1))

        def chances(length: Column) -> Column:
            hit = length % classes
            return F.transform(ids, lambda i: F.when(i == hit, (3 + length % 7) / F.lit(10.0))
                               .when(i == (hit + 1) % classes, F.lit(0.25)).otherwise(F.lit(0.0)))

        # Bound outside the lambda: the optimizer may put the whole cleaning there.
        return df.withColumn("probability", ax.let(F.length("clean_text"), chances))

    return score


def pipeline_scorer(model) -> Scorer:
    """A fitted Spark ML pipeline as a scorer."""
    from runestone.operators.training import score as score_pipeline

    def score(df: DataFrame) -> DataFrame:
        return score_pipeline(model, df).drop("pred")

    return score


def plugin_scorer(load, batch: int = settings.SCORING_BATCH) -> Scorer:
    """An external model as a scorer."""
    from runestone.operators.training import score_plugin

    return lambda df: score_plugin(df, load, batch=batch)


def category_names(
    labels: DataFrame | None, max_bytes: int = settings.NAMES_MAX_BYTES
) -> Callable[[Column], Column]:
    """Id -> name; an id without a name is shown as a number, one with two names has the first in order.

    As many names as a probability row has entries travel with the plan. They are
    measured first; more bytes than that raise.
    """
    if labels is None:
        return lambda i: i.cast("string")
    named = labels.filter(F.col("label").isNotNull() & F.col("label_text").isNotNull()).groupBy("label").agg(
        F.min("label_text").alias("name"))
    size = named.agg(F.sum(F.octet_length("name") + 8)).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"{size} bytes of class names, more than {max_bytes}")
    rows = sorted(named.collect())
    if not rows:
        return lambda i: i.cast("string")
    by_id = {row.label: row.name for row in rows}
    if 0 <= rows[0].label and rows[-1].label < 4 * len(rows):
        names = F.array(*[F.lit(by_id.get(i)).cast("string") for i in range(rows[-1].label + 1)])
        return lambda i: F.coalesce(F.get(names, i), i.cast("string"))
    # Sparse ids: as many entries as names, not as the largest id.
    known = F.create_map(*[F.lit(v) for row in rows for v in (int(row.label), row.name)])
    return lambda i: F.coalesce(F.element_at(known, i.cast("int")), i.cast("string"))


def classify(df: DataFrame, scorer: Scorer, labels: DataFrame | None = None,
             top: int = settings.TOP_CATEGORIES) -> DataFrame:
    """Add category id and name, confidence, low-confidence flag and the top categories."""
    name = category_names(labels)
    scored = scorer(df)
    p = F.col("probability")
    return (
        scored.withColumn("category_id", ax.argmax(p))
        .withColumn("category", name(F.col("category_id")))
        .withColumn("confidence", F.round(F.array_max(p), 4))
        .withColumn("low_confidence", F.col("confidence") < settings.LOW_CONFIDENCE)
        .withColumn("top_categories", F.transform(ax.top_entries(p, top), lambda e: F.struct(
            name(e["category_id"]).alias("category"), F.round(e["probability"], 4).alias("probability"))))
        .drop("probability")
    )


def score_batch(
    df: DataFrame,
    scorer: Scorer,
    labels: DataFrame | None = None,
    profiles: LanguageProfiles | None = None,
    gazetteer: DataFrame | None = None,
    lexicon: DataFrame | None = None,
    supported: Sequence[str] = settings.SUPPORTED_LANGUAGES,
    key: str = "doc_id",
    text: str = "text",
    strict: bool = False,
    annotate: Callable | None = None,
) -> DataFrame:
    """Score and tag a batch or a stream.

    A given language is used as it is; others are detected. Blank documents are
    scored with status 'blank' and no tags; ``strict`` raises instead. ``annotate``
    loads an external annotator that is used instead of the rules; where it fails the document
    has no entities and the reason in ``error``, and is scored all the same.
    """
    blank = F.col(text).isNull() | (F.length(strip_edges(F.col(text))) == 0)
    if strict and not df.filter(blank).isEmpty():
        raise ValueError("cannot process an empty document")
    kept = [key, text] + (["language"] if "language" in df.columns else [])
    rows = df.select(*kept).withColumn(text, F.coalesce(text, F.lit("")))
    rows = with_language(rows, profiles, text, key, supported)
    rows = sanitize(rows, text).withColumn("status", F.when(blank, F.lit("blank")).otherwise(F.lit("ok")))
    rows = classify(rows, scorer, labels)
    if annotate is not None:
        rows = annotate_rows(rows, annotate, "clean_text")
    rows = tag_documents(rows, gazetteer, lexicon, "clean_text", key)
    return rows.select(
        key, "status", "language", "category", "category_id", "confidence", "low_confidence",
        "top_categories", "tags", "keywords", "entities", *(["error"] if annotate is not None else []),
    )


def score_one(spark, document: str, language: str | None, scorer: Scorer, **options) -> DataFrame:
    """One document through the batch plan; blank raises."""
    if document is None or not document.strip():
        raise ValueError("cannot process an empty document")
    df = spark.createDataFrame([(0, document, language)], "doc_id long, text string, language string")
    return score_batch(df, scorer, **options)


def benchmark(df: DataFrame) -> DataFrame:
    """Run a scoring plan to the end without keeping it: documents, seconds, documents per second."""
    spark = df.sparkSession
    documents = df.count()
    started = time.time()
    df.write.format("noop").mode("overwrite").save()
    seconds = time.time() - started
    return spark.createDataFrame(
        [(documents, round(seconds, 2), round(documents / max(1e-9, seconds), 1))],
        "documents long, seconds double, docs_per_sec double",
    )
