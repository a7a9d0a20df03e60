r"""Text cleaning as column expressions (``Column -> Column``).

Every removal leaves one space. Each cleaner looks for a cheap literal first, so
texts without the noise skip the regular expression.

Java and Python differ on what white space, word characters and line ends are.
``(?U)`` gives ``\s`` the Unicode meaning, to which SPACE adds the four separators
that only Python counts; ``(?md)`` makes ``^ $ .`` stop at ``\n`` only. Classes are
kept to a few members: each further range is one more test per character.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Cleaner = Callable[[Column], Column]

def _class_of(ranges: Sequence[tuple[int, int]]) -> str:
    """Members of a character class, in a notation that Java and RE2 share."""
    return "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" if low < high else rf"\x{{{low:x}}}"
                   for low, high in ranges)


# Members of a character class under (?U): what str.isspace() accepts.
SPACE = r"\s\x1c-\x1f"
SPACE_CHARACTERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
NOT_SPACE = f"[^{SPACE}]"
# Members of a character class: what \w accepts in Python.
WORD = r"\p{L}\p{N}_"
EDGE = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

# The names of mail and news headers.
HEADER_NAMES = [
    "From", "Subject", "Date", "Organization", "Lines", "Newsgroups", "Message-ID", "References",
    "Sender", "Reply-To", "NNTP-Posting-Host", "Distribution", "Path", "Xref", "In-Reply-To",
    "Followup-To", "Keywords", "Summary", "Expires", "Originator", r"Article-I\.D\.",
]

# The noise patterns.
TAG = "<[^>]+>"
URL = rf"(?U)http[s]?://{NOT_SPACE}+|www\.{NOT_SPACE}+"
EMAIL = rf"{EDGE}[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}{EDGE}"
SIGNATURE = r"(?msd)^-- ?$.*"
HEADER = rf"(?md)^(?:{'|'.join(HEADER_NAMES)}|X-[{WORD}-]+):.*$"
ATTRIBUTION = rf"(?mdU)^(?:In article{EDGE}.*|.*{EDGE}(?:writes|wrote):)[{SPACE}]*$"
QUOTED_LINE = rf"(?mdU)^[{SPACE}]*+(?:>|\||[A-Za-z]{{1,4}}>|:[{SPACE}]*>?).*$"
LONG_SPACE = f"(?U)[{SPACE}]{{2,}}"

# Characters that NFC and NFKC always keep and that never join the character
# before them: ASCII, most of Latin-1 and Latin Extended-A, Greek and Cyrillic
# basics, dashes and quotes, common ideographs. Only a text with some other
# character has to be normalised.
STABLE_RANGES = [
    (0x00, 0x7F), (0xA1, 0xA7), (0xA9, 0xA9), (0xAB, 0xAE), (0xB0, 0xB1), (0xB6, 0xB7),
    (0xBB, 0xBB), (0xBF, 0x131), (0x134, 0x13E), (0x141, 0x148), (0x14A, 0x17E),
    (0x391, 0x3A1), (0x3A3, 0x3CE), (0x400, 0x481), (0x2010, 0x2010), (0x2012, 0x2015),
    (0x2018, 0x2022), (0x20AC, 0x20AC), (0x4E00, 0x9FFF),
]
MAYBE_UNSTABLE = f"[^{_class_of(STABLE_RANGES)}]"
ASCII_RUN = r"[\x00-\x7f]+"


def _replace_if(text: Column, present: Column, pattern: str) -> Column:
    return F.when(present, F.regexp_replace(text, pattern, " ")).otherwise(text)


def strip_tags(text: Column) -> Column:
    """HTML tags, also across line ends.

    The pattern runs only up to the last ``>``: after it no tag can close, and an
    unclosed ``<`` there would be scanned to the end again and again.
    """
    tail = F.substring_index(text, ">", -1)
    head = F.left(text, F.length(text) - F.length(tail))
    return F.when(
        text.contains("<") & text.contains(">"),
        F.concat(F.regexp_replace(head, TAG, " "), tail),
    ).otherwise(text)


def strip_urls(text: Column) -> Column:
    return _replace_if(text, text.contains("://") | text.contains("www."), URL)


def strip_emails(text: Column) -> Column:
    return _replace_if(text, text.contains("@"), EMAIL)


def strip_artifacts(text: Column) -> Column:
    """URLs, then e-mail addresses."""
    return strip_emails(strip_urls(text))


def strip_signature(text: Column) -> Column:
    return _replace_if(text, text.contains("--"), SIGNATURE)


def strip_headers(text: Column) -> Column:
    return _replace_if(text, text.contains(":"), HEADER)


def strip_attribution(text: Column) -> Column:
    present = text.contains("In article") | text.contains("writes:") | text.contains("wrote:")
    return _replace_if(text, present, ATTRIBUTION)


def strip_quotes(text: Column) -> Column:
    return _replace_if(text, text.contains(">") | text.contains("|") | text.contains(":"), QUOTED_LINE)


def strip_edges(text: Column) -> Column:
    """What str.strip() does: SQL trim alone would only take U+0020."""
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def collapse_whitespace(text: Column) -> Column:
    """Runs of two or more white-space characters become a space; one is kept as it is."""
    return strip_edges(F.regexp_replace(text, LONG_SPACE, " "))


def _normalizer(form: str):
    @F.pandas_udf("string")
    def normalize(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize(form, t), na_action="ignore")

    # The result is a function of the text. The mark only keeps the optimizer from
    # pushing a later filter below it, which would run the whole chain twice and
    # multiply its expressions.
    return normalize.asNondeterministic()


def _normalized(text: Column, form: str) -> Column:
    # Spark has no normalisation. Only texts that could change go to Python, the
    # rest are sent as NULL: the test must sit inside the UDF's argument, since a
    # UDF under a CASE is still run for every row.
    # The long class is only tried on what is left after the ASCII characters.
    beyond = F.regexp_replace(text, ASCII_RUN, "")
    unstable = (F.octet_length(text) > F.length(text)) & beyond.rlike(MAYBE_UNSTABLE)
    risky = F.when(unstable, text)
    return F.coalesce(_normalizer(form)(risky), text)


def normalize_nfkc(text: Column) -> Column:
    return _normalized(text, "NFKC")


def normalize_nfc(text: Column) -> Column:
    return _normalized(text, "NFC")


def non_ascii_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x00-\x7F]"))


def word_count(text: Column) -> Column:
    """len(text.split()), NULL for NULL."""
    return F.regexp_count(text, F.lit(f"(?U){NOT_SPACE}+"))


def has_words(text: Column, n: int) -> Column:
    """``word_count(text) >= n``, false for NULL; reads only as far as the n-th word."""
    if n <= 0:
        return F.lit(True)
    rest = f"(?:[{SPACE}]++{NOT_SPACE}++){{{n - 1}}}+"
    return F.coalesce(text.rlike(rf"(?U)\A[{SPACE}]*+{NOT_SPACE}++{rest}"), F.lit(False))


# The steps of news-noise removal, in order.
NEWS_NOISE: list[Cleaner] = [strip_signature, strip_headers, strip_attribution, strip_quotes]

# Language tweaks. Both are absorbed by the steps around them (NFC by NFKC, edge
# stripping by the final collapse), so every language has the same plan.
LANGUAGE_TWEAKS: dict[str, list[Cleaner]] = {"en": [], "sv": [normalize_nfc], "fi": [strip_edges]}

# The full cleaning sequence.
SANITIZER: list[Cleaner] = [
    strip_tags, *NEWS_NOISE, strip_urls, strip_emails, normalize_nfkc, collapse_whitespace,
]


def apply_cleaners(df: DataFrame, cleaners: Sequence[Cleaner], text: str, out: str) -> DataFrame:
    """Run cleaners in order, each as its own narrow projection.

    A cleaner mentions its input several times, so nesting them in one expression
    would double it at every step; as columns each is computed once.
    """
    if dict(df.dtypes).get(text) != "string":
        raise TypeError(f"expected a string column {text!r}, got {dict(df.dtypes).get(text)}")
    df = df.withColumn(out, F.col(text))
    for cleaner in cleaners:
        df = df.withColumn(out, cleaner(F.col(out)))
    return df


def sanitize(df: DataFrame, text: str = "text", out: str = "clean_text", passes: int = 1) -> DataFrame:
    """Clean every document; no shuffle. Cleaning is not idempotent: ``passes=2``
    reproduces a job that cleans an already cleaned corpus again."""
    df = apply_cleaners(df, SANITIZER, text, out)
    for _ in range(passes - 1):
        df = apply_cleaners(df, SANITIZER, out, out)
    return df
