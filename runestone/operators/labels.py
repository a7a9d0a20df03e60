"""Schema standardisation and one label space for all languages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runestone import settings
from runestone.operators.scaling import join_dimension, prefix_sums
from runestone.session import settle


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise KeyError(f"source is missing required columns: {missing}")


def check_language(language: str, supported: Sequence[str] = settings.SUPPORTED_LANGUAGES) -> str:
    if language not in supported:
        raise ValueError(f"unsupported language {language!r}, expected one of {list(supported)}")
    return language


def standardize(
    df: DataFrame,
    text_col: str,
    label_col: str,
    label_text_col: str,
    language: str | Column,
    key: str | None = None,
) -> DataFrame:
    """Canonical columns; ``language`` is stamped on, or read from a column when the
    source holds several. ``key`` is kept as ``doc_id``."""
    require_columns(df, [text_col, label_col, label_text_col] + ([key] if key else []))
    kept = [F.col(key).alias("doc_id")] if key else []
    return df.select(
        *kept,
        F.col(text_col).cast("string").alias("text"),
        F.col(label_col).alias("label"),
        F.col(label_text_col).cast("string").alias("label_text"),
        (F.lit(language) if isinstance(language, str) else language).alias("language"),
    )


def label_map(df: DataFrame, name_col: str = "label_text") -> DataFrame:
    """Distinct names in code-point order with dense ids from 0: ``(label_text, label)``."""
    names = (
        df.filter(F.col(name_col).isNotNull())
        .select(F.col(name_col).cast("string").alias("label_text"))
        .distinct()
        .withColumn("_one", F.lit(1))
    )
    ranked = settle(
        prefix_sums(names, [], ["label_text"], {"label": "_one"})
        .select("label_text", F.col("label").cast("int").alias("label"))
    )
    if ranked.isEmpty():
        raise ValueError("cannot build a label map from zero names")
    return ranked


def language_label_map(
    df: DataFrame,
    language: str = settings.DEFAULT_LANGUAGE,
    name_col: str = "label_text",
    language_col: str = "language",
) -> DataFrame:
    """The label space set by one language's whole, unsampled data."""
    require_columns(df, [name_col, language_col])
    return label_map(df.filter(F.col(language_col) == language), name_col)


def unknown_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct names that the shared map does not hold."""
    names = df.select("label_text").filter(F.col("label_text").isNotNull()).distinct()
    return names.join(labels.select("label_text"), "label_text", "left_anti")


def encode_labels(df: DataFrame, labels: DataFrame, key: str = "doc_id", strict: bool = True) -> DataFrame:
    """Add ``label`` from the shared map. ``strict`` raises on an unknown name first,
    which costs one pass over the name column."""
    if strict:
        unknown = [row.label_text for row in unknown_labels(df, labels).limit(5).collect()]
        if unknown:
            raise KeyError(f"names absent from the shared label map: {unknown}")
    return join_dimension(df.drop("label"), labels, ["label_text"], "left", salt_by=key, settled=True)


def decode_labels(df: DataFrame, labels: DataFrame, label_col: str = "label", out: str = "category",
                  key: str = "doc_id") -> DataFrame:
    """Id -> name; an id that the map does not hold is shown as a number."""
    names = labels.select(F.col("label").alias(label_col), F.col("label_text").alias("_name"))
    return join_dimension(df, names, [label_col], "left", salt_by=key).withColumn(
        out, F.coalesce(F.col("_name"), F.col(label_col).cast("string"))
    ).drop("_name")


def unsupported_language_rows(df: DataFrame, supported: Sequence[str] = settings.SUPPORTED_LANGUAGES) -> DataFrame:
    return df.filter(~F.col("language").isin(list(supported)))


def union_corpora(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union of per-language corpora."""
    if not frames:
        raise ValueError("at least one source is needed")
    return reduce(DataFrame.unionByName, frames)
