"""The pipeline's stages, one by one, and the registered queries."""

from __future__ import annotations

from collections import Counter

import brute
import pytest
from compare import connect, difference

import __spark_entry__ as contract
import corpus_pipeline
from runestone.llm import line_quality
from runestone.llm.oracles import ORACLES
from runestone.llm.queries import QUERIES
from runestone.session import settle


@pytest.fixture(scope="module")
def stages(spark, sf):
    out, docs = {}, spark.read.parquet(f"{sf}/documents.parquet")
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = settle(stage(spark, docs, sf))
    return out


def rows_of(docs, *columns):
    return [tuple(r) for r in docs.select(*columns).collect()]


def test_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(stages[n].columns == stages["documents"].columns for n in names[:-1])
    for n in names[:-1]:
        assert stages[n].filter("n_chars <> char_length(text)").isEmpty()


def test_quality(stages):
    want = Counter()
    for doc, text in rows_of(stages["documents"], "doc_id", "text"):
        figures, kept = line_quality.judge_text(text.encode())
        if figures[6]:
            want[doc, kept.decode()] += 1
    assert Counter(rows_of(stages["quality_rules"], "doc_id", "text")) == want


def test_lines(stages):
    want = Counter((doc, text) for doc, _, _, text in brute.line_dedup(rows_of(stages["quality_rules"], "doc_id", "text")))
    assert Counter(rows_of(stages["line_dedup"], "doc_id", "text")) == want


def test_near(stages):
    rows = rows_of(stages["line_dedup"], "doc_id", "text")
    kept = {doc for doc, _, _, keep in brute.near_dedup(rows, 5) if keep}
    assert Counter(rows_of(stages["near_dedup"], "doc_id", "text")) == Counter(r for r in rows if r[0] in kept)


def test_mix_and_packing(stages):
    rows = rows_of(stages["near_dedup"], "doc_id", "text", "source")
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(brute.words(text))
    taken = Counter()
    copies = Counter(rows_of(stages["source_mix"], "doc_id", "text", "source"))
    for (_, text, source), n in copies.items():
        assert n <= 3
        taken[source] += n * len(brute.words(text))
    longest = Counter()
    for _, text, source in rows:
        longest[source] = max(longest[source], len(brute.words(text)))
    for source, target in brute.targets(sizes).items():
        assert abs(taken[source] - target) <= longest[source] / 2 + 1e-6
    pieces = stages["packing"].collect()
    documents = Counter(r["doc_id"] for r in pieces if r["piece"] == 0)
    assert documents == Counter(r[0] for r in copies.elements())
    held = Counter()
    for r in pieces:
        held[r["sequence_id"]] += r["length"]
    assert max(held.values()) <= 4096 and len(held) == brute.best_fit([r["length"] for r in pieces], 4096)


@pytest.mark.parametrize("name", ["sturdy", "nothing"])
def test_edges(request, spark, name):
    docs = request.getfixturevalue(name)
    for stage, run in corpus_pipeline.STAGES:
        docs = settle(run(spark, docs, None))
        if stage != "packing":
            assert docs.columns == request.getfixturevalue(name).columns
        if name == "sturdy":  # the oddities reach every stage: no id, no source, one id with two texts, a very long text
            rows = docs.select("doc_id").distinct().collect()
            assert {r["doc_id"] for r in rows} >= {None, 20, 21, 22, 23, 24, 25}, stage
    assert docs.isEmpty() == (name == "nothing")


def test_registered():
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries) and set(ORACLES) <= set(oracles) and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf, name):
    con = connect(sf)
    assert difference(QUERIES[name](spark, sf), con, ORACLES[name]) is None
    con.close()
