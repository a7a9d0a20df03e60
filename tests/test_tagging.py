"""Entities, keywords and tags against plain Python counters."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions import arrays as ax
from runestone.functions.text import sanitize
from runestone.operators import tagging

MENTIONS = "array<struct<text:string,label:string,pos:int>>"


def python_entities(mentions):
    groups = {}
    for text, label, _ in mentions:
        groups.setdefault(text, []).append(label)
    entities = [(t, Counter(ls).most_common(1)[0][0], len(ls)) for t, ls in groups.items()]
    return sorted(entities, key=lambda e: -e[2])


def test_dedupe_matches_counters(spark):
    rng = random.Random(3)
    docs = [
        [(rng.choice("ABC"), rng.choice(["ORG", "GPE", "PERSON"]), i) for i in range(rng.randint(0, 9))] for _ in range(400)
    ]
    df = spark.createDataFrame(list(enumerate(docs)), f"i int, m {MENTIONS}")
    rows = df.select("i", tagging.dedupe_entities(F.col("m")).alias("e")).collect()
    for r in rows:
        assert [(e.text, e.label, e["count"]) for e in r.e] == python_entities(docs[r.i])
        assert all(e.tag == settings.ENTITY_TAGS.get(e.label, "misc") for e in r.e)


def test_word_frequencies_match_counters(spark):
    rng = random.Random(5)
    docs = [[rng.choice("abcdef") for _ in range(rng.randint(0, 30))] for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, w array<string>")
    f = ax.word_frequencies(F.col("w"), F.array(F.lit("b"), F.lit("zz")))
    for r in df.select("i", f.alias("f"), ax.most_common(f, 3).alias("top")).collect():
        kept = [w for w in docs[r.i] if w != "b"]
        counts = Counter(kept)
        assert {x.word: x.n for x in r.f} == counts
        assert all(docs[r.i][x["first"]] == x.word and docs[r.i].index(x.word) == x["first"] for x in r.f)
        assert r.top == [w for w, _ in counts.most_common(3)]


@pytest.mark.parametrize("label, tag", [
    ("PERSON", "person"), ("PRS", "person"), ("ORG", "organization"), ("GPE", "location"), ("LOC", "location"),
    ("TME", "date"), ("OBJ", "product"), ("NEW", "misc"),
])
def test_entity_tag(spark, label, tag):
    assert spark.range(1).select(tagging.entity_tag(F.lit(label)).alias("t")).first().t == tag
    assert len(settings.ENTITY_TAGS) == 26


TEXT = (
    "Acmebank and the bank Acmebank in Stockholm moved 12,5 % of savings on 2024-05-01 at 9:30 for € 300. "
    "Write to info@acmebank.com about savings and bank bank Savings fooBar Anna Maria Berg x2y"
)


@pytest.fixture(scope="module")
def tagged(spark):
    df = spark.createDataFrame([(1, TEXT, "en"), (2, " ", "en"), (3, None, "sv"), (4, "och bilen bilen 2", "sv")],
                               "doc_id long, text string, language string")
    gazetteer = spark.createDataFrame([("acmebank", "ORG"), ("stockholm", "GPE")], "name string, label string")
    return df, gazetteer


@pytest.mark.parametrize("max_rows", [500, -1])
def test_mentions(tagged, max_rows):
    df, gazetteer = tagged
    rows = {r.doc_id: r.mentions for r in tagging.entity_mentions(df, gazetteer, max_rows=max_rows).collect()}
    got = sorted((m.pos, m.text, m.label) for m in rows[1])
    assert [g[1:] for g in got] == [
        ("Acmebank", "ORG"), ("Acmebank", "ORG"), ("Stockholm", "GPE"), ("12,5 %", "PERCENT"), ("2024-05-01", "DATE"),
        ("9:30", "TIME"), ("€ 300", "MONEY"), ("info@acmebank.com", "EMAIL"), ("Anna Maria Berg", "MISC"),
    ]
    assert rows[2] == [] and rows[3] is None and [m.text for m in rows[4]] == ["2"]


@pytest.mark.parametrize("max_rows", [500, -1])
@pytest.mark.parametrize("names", [0, 501])
def test_one_label_per_name(spark, tagged, max_rows, names):
    """A name with two labels has the first in order, in a gazetteer of any size."""
    df, _ = tagged
    rows = [("Acmebank", "ORG"), ("acmebank", "GPE"), ("stockholm", None), (None, "ORG"), *[(f"name{i}", "ORG") for i in range(names)]]
    gazetteer = spark.createDataFrame(rows, "name string, label string")
    found = {r.doc_id: r.mentions for r in tagging.entity_mentions(df, gazetteer, max_rows=max_rows).collect()}
    assert [(m.text, m.label) for m in found[1][:3]] == [("Acmebank", "GPE"), ("Acmebank", "GPE"), ("12,5 %", "PERCENT")]
    assert [m.pos for m in found[1]] == sorted(m.pos for m in found[1])


def test_tag_documents(tagged):
    df, gazetteer = tagged
    rows = {r.doc_id: r for r in tagging.tag_documents(df, gazetteer).collect()}
    first = rows[1]
    assert (first.entities[0].text, first.entities[0].tag, first.entities[0]["count"]) == ("Acmebank", "organization", 2)
    assert first.keywords == ["bank", "savings", "moved", "write", "foobar"]
    assert first.entity_tags == sorted({e.tag for e in first.entities})
    assert first.tags == sorted({*first.entity_tags, *first.keywords})
    assert (rows[2].entities, rows[2].keywords, rows[2].tags) == ([], [], [])
    assert (rows[3].entities, rows[3].tags) == ([], [])
    assert rows[4].keywords == ["bilen"] and rows[4].language == "sv"
    with pytest.raises(ValueError):
        tagging.tag_documents(df, gazetteer, strict=True)


def test_tag_union(spark):
    row = spark.range(1).select(tagging.merge_tags(
        F.array(F.lit("location"), F.lit("organization")), F.array(F.lit("savings"), F.lit("bank"), F.lit("location"))
    ).alias("t")).first()
    assert row.t == ["bank", "location", "organization", "savings"]


def test_lexicon(spark):
    df = spark.createDataFrame([(1, "pankissa pankki nopeasti tuntematon", "fi")], "doc_id long, text string, language string")
    lexicon = spark.createDataFrame([
        ("fi", "pankissa", "pankki", "NOUN"), ("fi", "pankki", "pankki", "NOUN"), ("fi", "nopeasti", "nopeasti", "ADV"),
    ], "language string, form string, lemma string, pos string")
    assert tagging.tag_documents(df, lexicon=lexicon).first().keywords == ["pankki", "tuntematon"]


def test_counts(tagged):
    df, gazetteer = tagged
    rows = tagging.tag_documents(df, gazetteer)
    occurrences = {r.doc_id: [e.tag for e in r.entities] + r.keywords for r in rows.collect()}
    per_document = {(r.doc_id, r.tag): r.n for r in tagging.tag_counts_per_document(rows).collect()}
    assert per_document == {(d, t): n for d, tags in occurrences.items() for t, n in Counter(tags).items()}
    total = {r.tag: r.n for r in tagging.tag_counts(rows).collect()}
    assert total == sum((Counter(tags) for tags in occurrences.values()), Counter())


def test_annotator_failures_are_data(spark):
    def load():
        def annotator(text, language):
            if "boom" in text:
                raise RuntimeError("no model")
            return [(w, "ORG") for w in text.split() if w.istitle()]
        return annotator

    df = spark.createDataFrame([(1, "Acme and Acme Beta", "en"), (2, "boom", "en")], "doc_id long, text string, language string")
    found = tagging.annotate(df, load)
    rows = {r.doc_id: r for r in found.collect()}
    assert [m.text for m in rows[1].mentions] == ["Acme", "Acme", "Beta"] and rows[1].error is None
    assert rows[2].mentions == [] and rows[2].error == "RuntimeError: no model"
    joined = tagging.tag_documents(found)
    assert {r.doc_id: [(e.text, e["count"]) for e in r.entities] for r in joined.collect()} == {
        1: [("Acme", 2), ("Beta", 1)], 2: []}


def test_long_runs_do_not_overflow_the_stack(spark):
    texts = [" ".join(["Sich"] * 60_000), ".".join(["1"] * 60_000), "a." * 3_000 + "@", "x " * 60_000, "<" * 20_000]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, language string")
    rows = {r.doc_id: r for r in tagging.tag_documents(sanitize(df), text="clean_text").collect()}
    assert [(len(e.text), e.label) for e in rows[0].entities] == [(len(texts[0]), "MISC")]
    assert [(len(e.text), e.label) for e in rows[1].entities] == [(len(texts[1]), "CARDINAL")]
    assert rows[3].entities == [] and rows[4].keywords == []
