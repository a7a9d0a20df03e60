"""Corpus build: label space -> standardize -> union -> clean -> drop ghosts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from runestone import settings
from runestone.operators.cleaning import clean_corpus, drop_ghosts
from runestone.operators.labels import (
    encode_labels, language_label_map, standardize, union_corpora,
)
from runestone.operators.sampling import demo_sample, stratified_sample
from runestone.sources.tables import write_corpus


def combine_sources(
    sources: Mapping[str, DataFrame], text_col: str = "text", label_text_col: str = "label_text", key: str = "doc_id"
) -> DataFrame:
    """One raw table from a source per language; ``key`` must be unique over all of them."""
    return union_corpora([
        source.select(key, text_col, label_text_col, F.lit(language).alias("language"))
        for language, source in sources.items()
    ])


def build_corpus(
    raw: DataFrame,
    languages: Sequence[str] = settings.SUPPORTED_LANGUAGES,
    default_language: str = settings.DEFAULT_LANGUAGE,
    text_col: str = "text",
    label_text_col: str = "label_text",
    language_col: str = "language",
    key: str = "doc_id",
    sample_size: int | None = None,
    labels: DataFrame | None = None,
    strict: bool = True,
    observation: Observation | None = None,
) -> DataFrame:
    """``doc_id, text, label, label_text, language`` over all languages.

    The label space is the default language's, taken before any sampling, and is
    computed once for all languages. ``observation`` gets the cleaning impact while the corpus is
    written, for ``cleaning.observed_impact``.
    """
    wanted = raw.filter(F.col(language_col).isin(list(languages)))
    labels = labels if labels is not None else language_label_map(raw, default_language, label_text_col, language_col)
    if sample_size is not None:
        wanted = union_corpora([
            stratified_sample(wanted.filter(F.col(language_col) == lang), sample_size, label_text_col, key)
            for lang in languages
        ])
    # One scan for all languages: the language is a column, not a source.
    shaped = standardize(
        wanted.withColumn("_label", F.lit(None).cast("int")), text_col, "_label", label_text_col,
        F.col(language_col), key,
    )
    encoded = encode_labels(shaped, labels, "doc_id", strict)
    return drop_ghosts(clean_corpus(encoded, observation, languages)).select(
        "doc_id", "text", "label", "label_text", "language"
    )


def build_and_write(raw: DataFrame, corpus_path: str, sample_path: str | None = None, **options) -> DataFrame:
    """Write the corpus once and read it back, so the demo sample does not clean again."""
    write_corpus(build_corpus(raw, **options), corpus_path)
    corpus = raw.sparkSession.read.parquet(corpus_path)
    if sample_path:
        demo_sample(corpus).write.parquet(sample_path)
    return corpus
