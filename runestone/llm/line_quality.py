"""Quality rules, line first.

Every line is judged alone by punctuation, navigation, repetition and boilerplate
rules. Lines that fail go; a document that loses more than a given share of its
words, or fails the base rules on its whole text, is rejected.

Everything happens inside the row: no shuffle, and memory is that of one batch.

Defined results: a null or empty text has no words, so it is rejected and its text
stays as it is. Repeated rows are judged alike and independently. An empty table
gives an empty table. Columns of any other name are passed through ``clean``
unchanged; ``judge`` reads only ``doc_id`` and ``text``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runestone.llm.common import column_of, map_batches, with_length

MIN_WORDS = 50
# Rejected above these shares of words, in percent.
MAX_REPEATED = 50
MAX_LOST = 50

# A line fails when at least a tenth of its bytes outside white space are marks.
MARKS = b"!?#*$%&|<>=_~^@\\/{}[]+\""
SYMBOLS = b"#*$%&|<>"
# A line fails as a menu with this many separated entries of at most three words on average.
MENU_SEPARATORS = 2
MENU_WORDS = 3
# A line fails when one word stands this often in a row.
RUN = 5
# A line of this many words fails when it has this many capitals, no small letter of any script, and no more letters
# of scripts without capitals than capitals.
SHOUT = 4
# A line with a boilerplate phrase fails up to this many words; a longer one when phrases make up this share of its words, in percent.
BOILERPLATE_WORDS = 20
BOILERPLATE_SHARE = 20

BOILERPLATE = (
    "licensed under", "all rights reserved", "released under the", "general public license", "copyright (c)",
    "terms of service", "terms of use", "privacy policy", "cookie policy", "we use cookies",
)
_BOILERPLATE = re.compile(b"|".join(re.escape(x.encode()) for x in BOILERPLATE))
_SMALL = re.compile(b"[a-z]")

JUDGED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lost_words long, n_lost_lines long"
)


def shouts(line: bytes) -> bool:
    """Whether the letters of a line are capitals. A letter without a capital of its own, as ß, says nothing."""
    if _SMALL.search(line):
        return False
    text = line.decode("utf-8", "replace")
    if any(c.islower() and c.upper() != c and len(c.upper()) == 1 for c in text):
        return False
    capitals = sum(map(str.isupper, text))
    return capitals >= SHOUT and capitals >= sum(c.isalpha() and not c.isupper() and not c.islower() for c in text)


def is_boilerplate(line: bytes, words: list[bytes]) -> bool:
    """Whether a line with a phrase is short, or made of phrases to a fifth."""
    phrases = _BOILERPLATE.findall(line.lower())
    if not phrases:
        return False
    return len(words) <= BOILERPLATE_WORDS or 100 * sum(len(x.split()) for x in phrases) >= BOILERPLATE_SHARE * len(words)


def line_fails(line: bytes, words: list[bytes]) -> bool:
    """Whether one line with words breaks a rule."""
    size = sum(map(len, words))
    marks = size - len(b"".join(words).translate(None, MARKS))
    if 10 * marks >= size:
        return True
    separators = line.count(b" | ")
    if separators >= MENU_SEPARATORS and len(words) - separators <= MENU_WORDS * (separators + 1):
        return True
    if len(words) >= SHOUT and shouts(line):
        return True
    run = 1
    for before, word in zip(words, words[1:], strict=False):
        run = run + 1 if word == before else 1
        if run == RUN:
            return True
    return is_boilerplate(line, words)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that occurs twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, len(words))
    pairs = np.unique(ids[:-1] * np.uint64(len(numbers)) + ids[1:], return_inverse=True)[1].astype(np.uint64)
    windows = pairs[:-1] * np.uint64(len(numbers)) + ids[2:]
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[place] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + len(again)] |= again
    return int(covered.sum())


def judge_text(text: bytes | None) -> tuple[tuple, bytes | None]:
    """The figures and verdict of one text, and the text without its failing lines."""
    if not text:
        return (0, 0, 0, 0, 0, True, False, 0, 0), text
    words = text.split()
    n_words = len(words)
    if not n_words:
        return (0, 0, 0, 0, 0, True, False, 0, 0), text
    stuck = b"".join(words)
    seen: set[bytes] = set()
    kept, duplicates, lost_words, lost_lines = [], 0, 0, 0
    for line in text.split(b"\n"):
        own = line.split()
        if own:
            if line in seen:
                duplicates += 1
            seen.add(line)
            if line_fails(line, own):
                lost_words += len(own)
                lost_lines += 1
                continue
        kept.append(line)
    repeated = repeated_words(words)
    base_failed = n_words < MIN_WORDS or 100 * repeated > MAX_REPEATED * n_words
    keep = not base_failed and 100 * lost_words <= MAX_LOST * n_words
    figures = (
        n_words, len(stuck.decode("utf-8", "replace")), len(text) - len(text.translate(None, SYMBOLS)),
        duplicates, repeated, base_failed, keep, lost_words, lost_lines,
    )
    return figures, b"\n".join(kept) if lost_lines else text


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
              "n_lost_words", "n_lost_lines"]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2
    for batch in batches:
        rows = [judge_text(text)[0] for text in column_of(batch, "text")]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            ["doc_id", *fields],
        )


def judge(docs: DataFrame) -> DataFrame:
    """A row of figures and verdict per row of ``docs`` (doc_id, text)."""
    return map_batches(docs, ["doc_id", F.col("text").cast("string").alias("text")], JUDGED, _judged)


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        results = [judge_text(text) for text in column_of(batch, "text")]
        keep = pa.array([figures[6] for figures, _ in results], pa.bool_())
        texts = pa.array([text for _, text in results], pa.binary()).cast(batch.schema.field(at).type)
        yield batch.set_column(at, batch.schema.field(at), texts).filter(keep)


def clean(docs: DataFrame) -> DataFrame:
    """The documents that are kept, without their failing lines; all columns of ``docs``.

    An integer column ``n_chars`` follows the new text.
    """
    return with_length(docs.mapInArrow(_cleaned, docs.schema))
