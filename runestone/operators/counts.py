"""Counted words and hashed pieces of texts, as blocks that the regression learns from.

Texts go through Python a block at a time: what is counted are numbers, and each different word of a block is a
Python object once at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runestone.functions.hashing import buckets, gram_buckets
from runestone.functions.tokens import character_kinds, split_words
from runestone.operators import regression

# Characters of the rows that are counted at a time.
BLOCK_CHARS = 1 << 19

TERMS_SCHEMA = "terms array<string>, term_counts array<long>, doc_counts array<long>"


def shared_kinds(spark: SparkSession) -> Broadcast:
    """What ``word_counts`` needs in the tasks."""
    return spark.sparkContext.broadcast(character_kinds(spark))


def text_cuts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and end of the rows that are counted at a time."""
    return regression.cuts(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False) + 1, BLOCK_CHARS)


def text_by_text(work: Callable[[pa.Array], pa.Array], texts: pa.Array) -> pa.Array:
    """``work`` on as many texts as are counted at a time, put together again."""
    return pa.concat_arrays([work(texts.slice(start, end - start)) for start, end in text_cuts(texts)] or [work(texts)])


def tally(rows: np.ndarray, places: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and count of the different (row, place), sorted; places are below ``size``."""
    keys = rows * size + places
    if n * size <= 4 * len(keys):
        counts = np.bincount(keys, minlength=n * size)
        keys = np.flatnonzero(counts)
        counts = counts[keys]
    else:
        keys, counts = np.unique(keys, return_counts=True)
    return keys // max(1, size), keys % max(1, size), counts


def word_counts(texts: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The different words; row, number of the word and count of what the texts have of them."""
    words, lengths = split_words(texts, kinds)
    coded = words.dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.dictionary, *tally(np.repeat(np.arange(len(texts)), lengths), numbers, len(texts), len(coded.dictionary))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end in text_cuts(batch.column("text")):
            yield batch.slice(start, end - start)


def _totals(n: int, terms: pa.Array, numbers: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
    """Behind the terms stands NULL, which every row has, so that one pass counts terms and rows."""
    term_counts = np.append(np.bincount(numbers, counts, len(terms)).astype(np.int64), 0)
    doc_counts = np.append(np.bincount(numbers, minlength=len(terms)), n)
    columns = pa.concat_arrays([terms, pa.nulls(1, terms.type)]), pa.array(term_counts), pa.array(doc_counts)
    return [pa.ListArray.from_arrays(pa.array([0, len(terms) + 1], pa.int32()), column) for column in columns]


def term_totals(df: DataFrame, text: str) -> DataFrame:
    """For the rows of a block each: their terms, and how often and in how many rows a term occurs."""
    kinds = shared_kinds(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            terms, _, numbers, counts = word_counts(part.column("text"), kinds.value)
            yield pa.RecordBatch.from_arrays(
                _totals(part.num_rows, terms, numbers, counts), ["terms", "term_counts", "doc_counts"])

    return df.select(_lower(text)).mapInArrow(run, TERMS_SCHEMA)


def term_blocks(df: DataFrame, text: str, label: str, weight: str) -> DataFrame:
    """``term_totals``, and the block itself: its places are positions in its own ``terms``."""
    kinds = shared_kinds(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            terms, rows, numbers, counts = word_counts(part.column("text"), kinds.value)
            raw = regression.raw_block(np.bincount(rows, minlength=part.num_rows), numbers, counts, *_given(part))
            yield pa.RecordBatch.from_arrays(
                [*_totals(part.num_rows, terms, numbers, counts), *(pa.array([r], pa.binary()) for r in raw)],
                ["terms", "term_counts", "doc_counts", *regression.BLOCK])

    return _rows(df, text, label, weight).mapInArrow(run, f"{TERMS_SCHEMA}, {regression.BLOCK_SCHEMA}")


def _lower(text: str) -> Column:
    return F.lower(F.col(text)).alias("text")


def _rows(df: DataFrame, text: str, label: str, weight: str) -> DataFrame:
    return df.select(F.col(label).cast("int").alias("label"), F.col(weight).alias("weight"), _lower(text))


def _given(part: pa.RecordBatch) -> list[np.ndarray]:
    return [part.column(name).to_numpy(zero_copy_only=False) for name in ("label", "weight")]


def hashed_blocks(df: DataFrame, text: str, label: str, weight: str, word_size: int, gram_size: int) -> DataFrame:
    """Blocks of hashed words, and behind their places hashed 3-grams of the characters."""
    kinds = shared_kinds(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            found = hashed_counts(part.column("text"), kinds.value, word_size, gram_size)
            yield regression.batch_of(regression.raw_block(*found, *_given(part)))

    return _rows(df, text, label, weight).mapInArrow(run, regression.BLOCK_SCHEMA)


def hashed_counts(texts: pa.Array, kinds: np.ndarray, word_size: int, gram_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of each row, their places and counts."""
    n = len(texts)
    terms, rows, numbers, counts = word_counts(texts, kinds)
    # Words of one bucket are counted together.
    keys, at = np.unique(rows * word_size + buckets(terms, word_size)[numbers], return_inverse=True)
    counts = np.bincount(at, counts, len(keys)).astype(np.int64)
    gram_places, lengths = gram_buckets(texts.to_pylist(), gram_size)
    gram_rows, gram_places, gram_counts = tally(np.repeat(np.arange(n), lengths), gram_places, n, gram_size)
    rows = np.concatenate([keys // word_size, gram_rows])
    order = np.argsort(rows, kind="stable")
    return (np.bincount(rows, minlength=n), np.concatenate([keys % word_size, word_size + gram_places])[order],
            np.concatenate([counts, gram_counts])[order])


def doc_counts(blocks: DataFrame, size: int) -> np.ndarray:
    """In how many rows each place occurs."""
    return regression.summed(blocks.select(*regression.BLOCK), _place_counts, None, size)


def _place_counts(block: regression.Block, _: None, size: int) -> np.ndarray:
    return np.bincount(block[1], minlength=size)
