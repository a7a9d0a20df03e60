from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    long_line = " ".join(f"word{i % 997} tail" for i in range(20_000))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\r\n\x0b\x0c ", None, None, 7),
        (4, "one", "en", None, 3), (None, "text without an id", None, "b", 18), (None, None, None, None, None),
        (5, long_line, "en", "a", len(long_line)), (6, long_line, "en", "b", len(long_line)),
        (7, "same same same same same", "de", "a", 24), (7, "same same same same same", "de", "a", 24),
        (8, "Ärger über naïve Fälle \U0001f600 日本語 x\nÄrger über", "de", "b", 40),
        (9, "ends with white space \n\n\n", "fr", "c", 25), (7, "another text under an id that exists", "de", "a", 36),
        (10, "<|startoftext|> in a text <|endoftext|>", "en", "c", 39),
    ]
    return spark.createDataFrame([(*r, "x", 1, True, "k") for r in rows], DOCS + ", kept string, size int, _slice boolean, length string")


@pytest.fixture(scope="session")
def sturdy(spark, awkward):
    """The awkward rows, and as odd ones that the quality rules keep."""
    def prose(n, sentences=12):
        return "\n".join(f"Sentence {n * 1000 + i} tells of thing{n}x{i} and of place{n}y{i}." for i in range(sentences))

    rows = [
        (20, prose(1), None, None, None), (None, prose(2), "en", "a", 5), (None, prose(3), None, None, None), (21, prose(4), "de", "a", 1),
        (21, prose(4), "de", "a", 1), (21, prose(5), "fr", "b", 1), (22, prose(6) + "\n\n\x0b \n", "es", "b", 0), (23, prose(7, 9000), "en", "c", 0),
        (24, prose(8) + "\n\U0001f600 日本語 Ärger über naïve Fälle.", "de", "b", 0), (25, prose(9), "en", "", 0), (26, prose(9), "en", "", 0),
    ]
    return awkward.unionByName(spark.createDataFrame([(*r, "x", 1, True, "k") for r in rows], awkward.schema))


@pytest.fixture(scope="session")
def nothing(spark, awkward):
    return awkward.filter("false")


@pytest.fixture(scope="session")
def table(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
