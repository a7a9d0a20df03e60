"""What several operators share: words, texts as bytes, sources of Arrow batches.

A word is ``[^\\x20\\x09-\\x0D]+``. ``bytes.split``, ``bytes.strip`` and
``bytes.lower`` treat exactly these ASCII characters as white space and exactly
A-Z as capitals, so texts are handled as UTF-8 bytes throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runestone.sources.tables import spread

# Stands for a null doc_id where ids are ordered: below every other id.
NO_ID = -(1 << 63)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table; a single small file is dealt to all cores."""
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")


def column_of(batch: pa.RecordBatch, name: str) -> list:
    """A column as Python values; texts as bytes, null as None."""
    values = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        values = values.cast(pa.large_binary())
    return values.to_pylist()


def map_batches(
    rows: DataFrame, columns: list[str | Column], schema: str, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """``function`` over the Arrow batches of the named columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        # Workers are used again by later stages; what Arrow keeps in reserve goes back.
        pa.default_memory_pool().release_unused()

    return rows.select(*columns).mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(text)


def id_or_lowest(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def with_length(docs: DataFrame) -> DataFrame:
    """An integer column ``n_chars`` follows the text."""
    kind = dict(docs.dtypes).get("n_chars")
    if kind not in ("int", "bigint"):
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))
