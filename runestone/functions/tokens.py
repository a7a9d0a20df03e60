"""Word tokens."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions.text import NOT_SPACE, SPACE

LETTER = r"[\p{L}\p{M}\p{N}]"
LETTER_RUN = rf"{LETTER}++"
TOKEN = rf"(?U){LETTER_RUN}|{NOT_SPACE}"


def word_tokens(text: Column) -> Column:
    """Words and single punctuation marks in order, case kept; [] for blank, NULL for NULL."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def truncate_tokens(tokens: Column, limit: int = settings.MAX_TOKENS) -> Column:
    return F.slice(tokens, 1, limit)


def character_kinds(spark: SparkSession) -> np.ndarray:
    """What each character is to ``TOKEN``, as the JVM has it: 0 white space, 1 part of a word, 2 a mark of its own."""
    if not _KINDS:
        every = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
        letters = F.regexp_replace("s", rf"(?U){LETTER}", "a")
        row = spark.createDataFrame([("".join(map(chr, every)),)], "s string").select(
            F.regexp_replace(letters, rf"(?U)[^a{SPACE}]", "!").alias("s")).first()
        kinds = np.zeros(sys.maxunicode + 1, np.uint8)
        kinds[every] = [{"a": 1, "!": 2}.get(c, 0) for c in row.s]
        _KINDS.append(kinds)
    return _KINDS[0]


_KINDS: list[np.ndarray] = []


def split_words(texts: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """``word_tokens`` of many texts in a row, and how many each text has; NULL has none."""
    strings = [t or "" for t in texts.to_pylist()]
    ends = np.cumsum([len(t) for t in strings], dtype=np.int64)
    codes = np.frombuffer("".join(strings).encode("utf-32-le"), "<u4")
    kind = kinds[codes]
    letter = kind == 1
    begins = kind == 2
    # A word begins at a letter behind anything else, and at the first character of a text.
    begins[1:] |= letter[1:] & ~letter[:-1]
    first = np.concatenate([[0], ends[:-1]])[np.diff(ends, prepend=0) > 0]
    begins[first] |= letter[first]
    kept = kind > 0
    codes = codes[kept]
    at = np.flatnonzero(begins[kept])
    if codes.max(initial=0) >= 0x80:
        widths = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        at = np.concatenate([[0], np.cumsum(widths)])[np.append(at, len(codes))]
    else:
        at = np.append(at, len(codes))
    data = codes.tobytes().decode("utf-32-le").encode()
    words = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data))
    through = np.concatenate([[0], np.cumsum(begins)])[ends]
    return words, np.diff(through, prepend=0)
