"""Every registered query, and its equality with SQL where SQL can say it."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from runestone.registry import queries as registry

# The registry of this library; what is registered beside it has tests of its own.
QUERIES = {name: contract.queries()[name] for name in registry.QUERIES}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}
# Fits and timings without a fact that SQL could state beforehand; their operators are tested on fixtures.
WITHOUT_SQL = {
    "baseline_train", "baseline_predict", "baseline_proba", "training_history",
    "challenger_train", "select_model", "train_report", "cross_validate", "benchmark", "score_trained", "compress_classifier",
    "network_history", "network_predict",
}


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL and set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def duck(sf):
    con = connect(sf)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf, duck, name):
    assert difference(QUERIES[name](spark, sf), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["baseline_predict", "training_history", "score_trained", "compress_classifier", "benchmark"])
def test_runs(spark, sf, name):
    rows = QUERIES[name](spark, sf).collect()
    assert rows
    if name == "score_trained":
        assert len(rows) == 200 and {r["category"] for r in rows} <= {"low", "high"} and len({r["confidence"] for r in rows}) > 100
    if name == "compress_classifier":
        found = {(r["variant"], r["metric"]): r["value"] for r in rows}
        assert {v for v, _ in found} == {"original", "pruned", "fp16", "int8"} and found["int8", "size_reduction_pct"] == 75.0
        assert all(found[v, "docs_per_sec"] > 0 and found[v, "accuracy"] > 0.5 for v, _ in found)


def test_entry(spark, sf):
    df = contract.entry(spark)
    assert df.count() == 200 and "category" in df.columns
