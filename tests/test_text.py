"""Cleaners: golden strings, and parity with Python on adversarial strings."""

from __future__ import annotations

import random
import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from runestone.functions import text as tx
from runestone.functions import tokens as tk
from runestone.operators import cleaning

RING = "\N{COMBINING RING ABOVE}"


def run(spark, cleaners, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    out = tx.apply_cleaners(df, cleaners, "text", "clean").orderBy("i")
    return [r.clean for r in out.collect()]


@pytest.mark.parametrize("cleaners, text, expected", [
    ([tx.strip_tags, tx.strip_edges], "<h2>Tide <hr>tables</h2>", "Tide  tables"),
    ([tx.strip_tags], "a < b and <unclosed", "a < b and <unclosed"),
    ([tx.strip_tags], "<>x<a\nb>y<", "<>x y<"),
    ([tx.strip_artifacts], "Letters go to desk@harbour.example, maps are at http://harbour.example/m?x=1 now.",
     "Letters go to  , maps are at   now."),
    ([tx.normalize_nfkc], f"Bla{RING} dorr", "Bl\N{LATIN SMALL LETTER A WITH RING ABOVE} dorr"),
    ([tx.normalize_nfc], f"a{RING} \N{LATIN SMALL LIGATURE FI}",
     "\N{LATIN SMALL LETTER A WITH RING ABOVE} \N{LATIN SMALL LIGATURE FI}"),
    ([tx.collapse_whitespace], "  wide   gaps in     between  ", "wide gaps in between"),
    ([tx.collapse_whitespace], "one\ttab\nkept  gone", "one\ttab\nkept gone"),
    ([tx.strip_tags, tx.strip_artifacts, tx.normalize_nfkc, tx.collapse_whitespace],
     f"<td> Boats  leave www.quay.example/a{RING}  at noon </td>", "Boats leave at noon"),
    ([tx.strip_signature], "body\n-- \nname\nphone", "body\n "),
    ([tx.strip_signature], "body\n--\nname", "body\n "),
    ([tx.strip_signature], "body\n--- not\n-- x", "body\n--- not\n-- x"),
    ([tx.strip_headers], "From: me\nX-Mailer: y\nbody From: kept", " \n \nbody From: kept"),
    ([tx.strip_attribution], "In article <1@x> someone says\n\nbody\nhe writes:\n\nend", " \nbody\n \nend"),
    ([tx.strip_quotes], "> a\n| b\nAB> c\nbody", " \n \n \nbody"),
    ([tx.strip_quotes], ":\nnext line\nbody", " \nbody"),
])
def test_golden(spark, cleaners, text, expected):
    assert run(spark, cleaners, text) == [expected]


def test_news_post(spark):
    post = (
        "From: someone@example.com\nSubject: Re: engines\nX-Reader: nn\n\nIn article <12@host> A writes:\n"
        "> quoted text\nThe engine is fine.\n-- \nSigned"
    )
    assert run(spark, tx.SANITIZER, post) == ["The engine is fine."]


def test_sanitize_keeps_nordic_letters(spark):
    text = "Organization: x\n<p>Se https://a.b/c h\N{LATIN SMALL LETTER A WITH DIAERESIS}r</p>\n> gammalt\nhej d\N{LATIN SMALL LETTER A WITH RING ABOVE}"
    df = spark.createDataFrame([(text, "sv"), ("Plain text here.", "xx")], "text string, language string")
    got = [r.clean_text for r in tx.sanitize(df).collect()]
    assert "Organization" not in got[0] and "https" not in got[0] and "gammalt" not in got[0]
    assert "h\N{LATIN SMALL LETTER A WITH DIAERESIS}r" in got[0] and got[0].endswith("d\N{LATIN SMALL LETTER A WITH RING ABOVE}")
    assert got[1] == "Plain text here."


def test_two_passes_reproduce_a_second_cleaning(spark):
    df = spark.createDataFrame([("<b></b>From: x",), ("\N{FULLWIDTH LATIN SMALL LETTER W}" * 3 + ".x.com hi",)], "text string")
    once = [r.clean_text for r in tx.sanitize(df).collect()]
    twice = [r.clean_text for r in tx.sanitize(df, passes=2).collect()]
    assert once == ["From: x", "www.x.com hi"] and twice == ["", "hi"]


def test_null_stays_null_and_types_are_checked(spark):
    df = spark.createDataFrame([(None, 1)], "text string, n int")
    assert tx.sanitize(df).first().clean_text is None
    with pytest.raises(TypeError):
        tx.apply_cleaners(df, [tx.strip_tags], "n", "clean")
    with pytest.raises(TypeError):
        tx.apply_cleaners(df, [tx.strip_tags], "absent", "clean")


def python_pattern(pattern: str) -> re.Pattern:
    """The same pattern in Python's own dialect, with Python's classes."""
    flags = re.match(r"\(\?(\w+)\)", pattern)
    pattern = pattern.replace(flags.group(0), "", 1) if flags else pattern
    python = 0
    for letter in flags.group(1) if flags else "":
        python |= {"m": re.MULTILINE, "s": re.DOTALL, "d": 0, "U": 0}[letter]
    pattern = pattern.replace(tx.EDGE, r"\b").replace(tx.NOT_SPACE, r"\S").replace(f"[{tx.SPACE}]", r"\s")
    pattern = pattern.replace(tx.WORD, r"\w").replace("++", "+").replace("*+", "*")
    return re.compile(pattern, python)


def nasty_strings(n: int = 1500) -> list[str]:
    pieces = [
        "\n", "\r", "\r\n", "\t", " ", "  ", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "\u200b", "<", ">", "<b>", "</b>", ":", "::",
        "|", "--", "-- ", "From:", "X-Foo: bar", "X-\xe5:", "Subject", "In article", "In articles", "writes:", "wrote:", "\xe5wrote:",
        "AB>", "ABCDE>", "http://", "https://x.y/z", "www.", "www.a\xa0b", "a@b.co", "\xe5@b.co", "a@b.c|d", "x.y@z.example.org\xe4",
        "@", ".", "word", "\xe4iti", "\u0430\u0431", "\ufb01", "a\u030a", "\uff57\uff57\uff57.", "12", "\u00b2", "_", "-", "\U0001f600", "\u0130",
    ]
    rng = random.Random(7)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("name", ["TAG", "URL", "EMAIL", "SIGNATURE", "HEADER", "ATTRIBUTION", "QUOTED_LINE", "LONG_SPACE"])
def test_pattern_parity(spark, name):
    cleaner = {
        "TAG": tx.strip_tags, "URL": tx.strip_urls, "EMAIL": tx.strip_emails, "SIGNATURE": tx.strip_signature,
        "HEADER": tx.strip_headers, "ATTRIBUTION": tx.strip_attribution, "QUOTED_LINE": tx.strip_quotes,
        "LONG_SPACE": lambda c: F.regexp_replace(c, tx.LONG_SPACE, " "),
    }[name]
    pattern, texts = python_pattern(getattr(tx, name)), nasty_strings()
    for text, got in zip(texts, run(spark, [cleaner], *texts)):
        assert got == pattern.sub(" ", text), repr(text)


def python_sanitize(text: str) -> str:
    for name in ("TAG", "SIGNATURE", "HEADER", "ATTRIBUTION", "QUOTED_LINE", "URL", "EMAIL"):
        text = python_pattern(getattr(tx, name)).sub(" ", text)
    text = unicodedata.normalize("NFKC", text)
    return python_pattern(tx.LONG_SPACE).sub(" ", text).strip()


def test_sanitize_parity(spark):
    texts = nasty_strings(3000)
    for text, got in zip(texts, run(spark, tx.SANITIZER, *texts)):
        assert got == python_sanitize(text), repr(text)


def test_space_is_what_python_calls_space(spark):
    points = [i for i in range(1, sys.maxunicode + 1) if not 0xD800 <= i <= 0xDFFF]
    df = spark.createDataFrame([(i, f"a{chr(i)}b") for i in points], "i int, t string").repartition(8)
    one_word = df.filter(tx.word_count(F.col("t")) == 1).select("i")
    words = {r.i for r in one_word.collect()}
    assert words == {i for i in points if not chr(i).isspace()}


def test_stable_characters_need_no_normalisation():
    stable = [chr(i) for low, high in tx.STABLE_RANGES for i in range(low, high + 1)]
    seconds = set()  # characters that can join the one before them
    for i in range(sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(i))
        if parts and not parts.startswith("<") and len(parts.split()) == 2:
            seconds.add(chr(int(parts.split()[1], 16)))
    for c in stable:
        assert unicodedata.normalize("NFKC", c) == c and unicodedata.normalize("NFC", c) == c
        assert unicodedata.combining(c) == 0 and c not in seconds


def test_counts(spark):
    df = spark.createDataFrame([("a b\xa0c",), ("",), (" \t",), (None,), ("\xe5\xe4 x",)], "t string")
    got = df.select(tx.word_count(F.col("t")).alias("w"), tx.non_ascii_count(F.col("t")).alias("n")).collect()
    assert [tuple(r) for r in got] == [(3, 1), (0, 0), (0, 0), (None, None), (2, 2)]


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_has_words(spark, n):
    texts = ["", " ", "a", " a ", "a b", "\ta\nb  c ", "a b c d", "x" * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i for r in df.filter(tx.has_words(F.col("t"), n)).collect()}
    assert got == {i for i, t in enumerate(texts) if len(t.split()) >= n}


def test_ghosts_and_clean_and_drop(spark):
    rows = [(1, "ok text", "en"), (2, " \n", "en"), (3, None, "sv"), (4, "<b> </b>", "fi"), (5, "> quoted only", "zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string, language string")
    assert {r.doc_id for r in cleaning.drop_ghosts(df).collect()} == {1, 4, 5}
    assert {r.doc_id for r in cleaning.clean_and_drop(df).collect()} == {1}
    assert {r.doc_id: r.text for r in cleaning.clean_corpus(df).collect()} == {1: "ok text", 2: "", 3: "", 4: "", 5: ""}


def test_cleaning_impact(spark):
    df = spark.createDataFrame([("a  \xe5", "en"), ("<b>x", "en"), ("y", "sv")], "text string, language string")
    got = {r.language: (r.documents, r.chars_removed, r.non_ascii_before) for r in cleaning.cleaning_impact(df).collect()}
    assert got == {"en": (2, 4, 1), "sv": (1, 0, 0)}


def test_word_tokens(spark):
    texts = ["Machine learning is great.", "Mjukvaruutveckling p\xe5 \xc5land.", "", None, "a_b 3,5!"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.k for r in df.select("i", tk.word_tokens(F.col("t")).alias("k")).orderBy("i").collect()]
    assert got == [
        ["Machine", "learning", "is", "great", "."], ["Mjukvaruutveckling", "p\xe5", "\xc5land", "."], [], None,
        ["a", "_", "b", "3", ",", "5", "!"],
    ]
    short = df.select("i", tk.truncate_tokens(tk.word_tokens(F.col("t")), 2).alias("k")).orderBy("i").first()
    assert short.k == ["Machine", "learning"]
