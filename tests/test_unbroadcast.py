"""Every operator with a lookup gives the same result when nothing may be broadcast."""

from __future__ import annotations

from collections import Counter
from functools import partial

import pytest

from runestone.operators import compression, features, labels, language, sampling, scaling, tagging, training

MODULES = [compression, features, labels, language, sampling, scaling, tagging, training]


@pytest.mark.parametrize("name", [
    "encode_labels", "decode_labels", "stratified_sample", "stratified_split", "demo_sample", "eval_sample",
    "detect_language", "tfidf_weights", "prune_long", "union_splits", "build_corpus",
])
def test_salted_joins(spark, sf, monkeypatch, name):
    from runestone.registry.queries import QUERIES

    want = Counter(QUERIES[name](spark, sf).collect())
    salted = partial(scaling.join_dimension, max_rows=-1, heavy_rows=5)
    for module in MODULES:
        if hasattr(module, "join_dimension"):
            monkeypatch.setattr(module, "join_dimension", salted)
    df = QUERIES[name](spark, sf)
    assert Counter(df.collect()) == want


def test_heavy_keys_are_salted(spark, sf, monkeypatch):
    documents = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("source", "label_text")
    names = labels.label_map(documents)
    monkeypatch.setattr(labels, "join_dimension", partial(scaling.join_dimension, max_rows=-1, heavy_rows=5))
    plan = labels.encode_labels(documents, names, strict=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
