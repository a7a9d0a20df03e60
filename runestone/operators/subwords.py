"""Sub-word vocabulary and encoding for languages with long inflected words."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions.arrow import in_slices, list_ends, lists_of
from runestone.functions.tokens import word_tokens
from runestone.operators.scaling import top_rows
from runestone.session import settle

CONTINUATION = "##"
UNKNOWN = "[UNK]"
MAX_PIECE = 8
VOCABULARY_SIZE = 8_000


def piece_counts(corpus: DataFrame, text: str = "text", max_piece: int = MAX_PIECE) -> DataFrame:
    """``(piece, n, length)`` over all tokens. Tokens are counted first, so pieces are
    cut once per distinct word; a piece inside a word carries the '##' prefix."""
    words = (
        corpus.select(F.explode(word_tokens(F.col(text))).alias("word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )

    def windows(k: int) -> Column:
        # A look-ahead matches at every character: all windows of k in one pass.
        found = F.regexp_extract_all("word", F.lit("(?s)(?=(" + "." * k + "))"), F.lit(1))
        return F.transform(found, lambda piece, i: F.struct(
            F.when(i == 0, piece).otherwise(F.concat(F.lit(CONTINUATION), piece)).alias("piece"),
            F.lit(k).alias("length"),
        ))

    pieces = F.concat(*[windows(k) for k in range(1, max_piece + 1)])
    return (
        words.select("n", F.explode(pieces).alias("p"))
        .groupBy(F.col("p.piece").alias("piece"), F.col("p.length").alias("length"))
        .agg(F.sum("n").alias("n"))
    )


def learn_subwords(corpus: DataFrame, text: str = "text", size: int = VOCABULARY_SIZE,
                   max_piece: int = MAX_PIECE) -> DataFrame:
    """``(piece, n)``: every single character, and the ``size`` longer pieces that
    would save most tokens, n * (length - 1), ties by piece."""
    counts = settle(piece_counts(corpus, text, max_piece))
    letters = counts.filter(F.col("length") == 1).select("piece", "n")
    longer = counts.filter(F.col("length") > 1).withColumn("saved", F.col("n") * (F.col("length") - 1))
    return letters.unionByName(top_rows(longer, "saved", "piece", size).select("piece", "n"))


def subword_encoder(vocabulary: DataFrame, max_bytes: int = settings.BROADCAST_MAX_BYTES):
    """A function on columns ``array<string> -> array<string>``: greedy longest match.

    The vocabulary is measured and sent to every worker; one of more than ``max_bytes``
    raises. The longest piece to look for is the vocabulary's. Tokens stay in their row, so common words are not shuffled; a worker encodes
    each word once per batch. A word with a character outside the vocabulary
    becomes [UNK].
    """
    vocabulary = settle(vocabulary.select("piece"))
    size = vocabulary.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"{size} bytes of sub-word pieces, more than {max_bytes}")
    pieces = frozenset(r.piece for r in vocabulary.collect())
    max_piece = max((len(p.removeprefix(CONTINUATION)) for p in pieces), default=1)
    shared = vocabulary.sparkSession.sparkContext.broadcast(pieces)

    def split(word: str) -> list[str]:
        known, pieces, at = shared.value, [], 0
        while at < len(word):
            prefix = CONTINUATION if at else ""
            for end in range(min(len(word), at + max_piece), at, -1):
                if prefix + word[at:end] in known:
                    pieces.append(prefix + word[at:end])
                    at = end
                    break
            else:
                return [UNKNOWN]
        return pieces

    @F.arrow_udf("array<string>")
    def encode(batch: pa.Array) -> pa.Array:
        done: dict[str, list[str]] = {}

        def documents(lists: pa.Array) -> pa.Array:
            tokens = lists.flatten().dictionary_encode()
            words = tokens.dictionary.to_pylist()
            for word in words:
                if word not in done:
                    done[word] = split(word)
            sizes = np.array([len(done[word]) for word in words], np.int64)
            codes = tokens.indices.to_numpy(zero_copy_only=False)
            n = sizes[codes]
            ends = np.concatenate([[0], np.cumsum(n)])
            at = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], n) + np.arange(ends[-1])
            pieces = pa.array([piece for word in words for piece in done[word]], pa.string())
            return lists_of(ends[list_ends(lists)], pieces.take(pa.array(at, pa.int64())), lists)

        return in_slices(documents, batch)

    return encode


def subword_tokens(text: Column, encoder) -> Column:
    return encoder(word_tokens(text))


def route_tokens(df: DataFrame, encoder, subword_languages: Sequence[str] = ("fi",), text: str = "text") -> DataFrame:
    """Add ``tokens``: sub-words for the listed languages, words for all others. The
    encoder is fed NULL for the others, so their text never leaves the JVM."""
    listed = F.col("language").isin(list(subword_languages))
    return (
        df.withColumn("_words", word_tokens(F.col(text)))
        .withColumn("_pieces", encoder(F.when(listed, F.col("_words"))))
        .withColumn("tokens", F.when(listed, F.col("_pieces")).otherwise(F.col("_words")))
        .drop("_words", "_pieces")
    )


def require_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Strict mode of the tokenizers: NULL text raises; otherwise NULL gives NULL."""
    if not df.filter(F.col(text).isNull()).isEmpty():
        raise ValueError("cannot tokenize NULL text")
    return df


