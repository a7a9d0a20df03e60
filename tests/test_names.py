"""Names in texts against a search for every name at every token border."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from runestone.operators.names import TOKEN, NameAutomaton, find_names, name_finder, occurring
from runestone.session import fresh_dir
from runestone.streaming import live


def brute(text, names):
    """Leftmost, then longest."""
    lowered = text.lower()
    borders = {m.start() for m in TOKEN.finditer(lowered)}, {m.end() for m in TOKEN.finditer(lowered)}
    found = [
        (m.start(), -(m.start() + len(n)), label) for n, label in names
        for m in re.finditer(f"(?={re.escape(n.lower())})", lowered) if m.start() in borders[0] and m.start() + len(n) in borders[1]
    ]
    out, free = [], 0
    for start, end, label in sorted(found):
        if start >= free:
            out.append((text[start:-end], label, start))
            free = -end
    return out


def test_overlaps_and_spellings():
    names = [("New York", "GPE"), ("york", "GPE"), ("New York City Hall", "FAC"), ("york city", "ORG"), ("new-york", "OLD"), ("Ärger", "X")]
    automaton = NameAutomaton(names)
    assert automaton.find("in NEW YORK City they say") == [("NEW YORK", "GPE", 3)]
    assert automaton.find("the New York city hall") == [("New York city hall", "FAC", 4)]
    assert automaton.find("old york city, new-york; newyork yorks") == [("york city", "ORG", 4), ("new-york", "OLD", 15)]
    assert automaton.find("new  york") == [("york", "GPE", 5)] and automaton.find("") == [] and automaton.find("İstanbul ÄRGER") == [("ÄRGER", "X", 9)]
    assert NameAutomaton([]).find("york") == [] and NameAutomaton([("--", "X"), ("", "Y")]).find("-- a") == []


@pytest.mark.parametrize("seed", range(6))
def test_equals_brute_force(seed):
    rng = random.Random(seed)
    words = ["a", "b", "ab", "é", "x1", "Aa"]
    spell = lambda n: rng.choice(" -").join(rng.choice(words) for _ in range(n))
    names = list({spell(rng.randint(1, 4)).lower(): rng.choice("PQ") for _ in range(25)}.items())
    automaton = NameAutomaton(names)
    for _ in range(200):
        text = "".join(rng.choice([*words, " ", " ", "-", ", "]) for _ in range(rng.randint(0, 40)))
        assert automaton.find(text) == brute(text, names)


GAZETTEER = [("united states", "GPE"), ("States", "LOC"), ("states", "GPE"), ("middle east", "LOC"), (None, "X"), ("nowhere land", "LOC"), ("x", None)]
TEXTS = [(1, "The United States and the states of the MIDDLE EAST"), (2, None), (3, ""), (4, "statesman, middle-east"), (1, "states")]


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.createDataFrame(TEXTS, "doc_id long, text string"), spark.createDataFrame(GAZETTEER, "name string, label string"))


def shown(df):
    return sorted((r.doc_id, r.text or "", None if r.names is None else [tuple(n) for n in r.names]) for r in df.collect())


WANT = sorted([
    (1, TEXTS[0][1], [("United States", "GPE", 4), ("states", "GPE", 26), ("MIDDLE EAST", "LOC", 40)]), (2, "", None), (3, "", []),
    (4, TEXTS[3][1], []), (1, "states", [("states", "GPE", 0)]),
], key=lambda r: (r[0], r[1]))


def test_table_and_plan(tables):
    docs, gazetteer = tables
    found = find_names(docs, gazetteer)
    assert sorted(shown(found), key=lambda r: (r[0], r[1])) == WANT
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_large_gazetteers(tables):
    docs, gazetteer = tables
    with pytest.raises(OverflowError):
        name_finder(gazetteer, max_rows=2)
    assert {r.name for r in occurring(docs, gazetteer).collect()} == {"united states", "states", "middle east"}
    assert sorted(shown(find_names(docs, gazetteer, max_rows=3)), key=lambda r: (r[0], r[1])) == WANT
    with pytest.raises(OverflowError):
        find_names(docs, gazetteer, max_rows=1)


def test_stream(spark, tables):
    source, out = fresh_dir(spark, "in"), fresh_dir(spark, "out")
    tables[0].write.parquet(source)
    arrived = spark.readStream.schema("doc_id long, text string").parquet(source)
    live.append_to(find_names(arrived, tables[1]).withColumn("n", F.size("names")), out, fresh_dir(spark, "progress")).awaitTermination()
    assert sorted(shown(spark.read.parquet(out)), key=lambda r: (r[0], r[1])) == WANT
