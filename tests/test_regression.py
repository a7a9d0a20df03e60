"""The distributed fit: its objective, its number of passes, and its models in any session."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runestone.operators import regression, training


@pytest.fixture(scope="module")
def rare_words(spark):
    """Words that nearly all occur once or twice, as in real texts."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        label = int(rng.random() < 0.3)
        own = [f"w{rng.randrange(4000)}" for _ in range(30)] + [f"{'ab'[label]}{int(rng.paretovariate(0.5)) % 300}" for _ in range(4)]
        rows.append((i, " ".join(own), label))
    return spark.createDataFrame(rows, "doc_id long, clean_text string, label int").repartition(3).cache()


def test_a_fit_ends_at_the_minimum_in_few_passes(rare_words):
    fitted = training.train_baseline(rare_words)
    assert len(fitted.losses) < 100 and all(b < a for a, b in zip(fitted.losses, fitted.losses[1:]))
    begun = training.train_baseline(rare_words, max_iter=1)
    assert len(begun.losses) == 2
    assert training.largest_gradient(fitted, rare_words) < 1e-4 < training.largest_gradient(begun, rare_words)


def test_a_model_scores_in_a_session_that_observed_rows(spark, rare_words):
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    assert len(training.score(training.train_baseline(rare_words).model, rare_words, ["doc_id"]).collect()) == 400


def test_gradient_against_differences():
    rng = np.random.default_rng(3)
    block = (np.array([0, 0, 2, 2, 2], "i4"), np.array([1, 3, 0, 1, 2], "i4"), rng.normal(size=5), np.array([2, 0, 1], "i4"), np.array([1.0, 0.5, 2.0]))
    weights = rng.normal(size=(3, 5))
    got = regression.loss_and_gradient(block, weights, 4)
    for i in range(weights.size):
        step = np.zeros(weights.size)
        step[i] = 1e-6
        up, down = (regression.loss_and_gradient(block, weights + s * step.reshape(3, 5), 4)[0] for s in (1, -1))
        assert got[1 + i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_dense_sparse_and_empty_rows_in_blocks(spark, monkeypatch):
    rows = [(0, 1.0, SparseVector(4, [1, 3], [2.0, 0.0])), (1, 2.0, DenseVector([0.0, 5.0, 0.0, 7.0])), (0, 1.0, SparseVector(4, [], [])), (1, 1.0, SparseVector(4, [0], [9.0]))]
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("weight", T.DoubleType()), T.StructField("features", VectorUDT())])
    df = spark.createDataFrame(rows, schema).coalesce(1)
    monkeypatch.setattr(regression, "BLOCK_ENTRIES", 3)
    batch = pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows]),
        pa.array([{"type": int(isinstance(v, DenseVector)), "size": 4, "indices": None if isinstance(v, DenseVector) else v.indices.tolist(), "values": v.values.tolist()} for *_, v in rows])],
        ["label", "weight", "features"])
    blocks = [regression._block(tuple(b.column(i)[0].as_py() for i in range(5))) for b in regression._packed(iter([batch]))]
    assert len(blocks) > 1
    found, at = [], 0
    for own, places, values, labels, weights in blocks:
        found += [(at + r, p, v) for r, p, v in zip(own.tolist(), places.tolist(), values.tolist())]
        at += len(labels)
    assert at == 4 and found == [(0, 1, 2.0), (1, 1, 5.0), (1, 3, 7.0), (3, 0, 9.0)]
    model, losses = regression.fit(df, "label", "weight", 1.0, 50, 1e-6)
    assert losses[-1] < losses[0] and model.numClasses == 2


def test_one_class_and_bad_labels(spark):
    rows = [(i, "some words", 1) for i in range(4)]
    schema = "doc_id long, clean_text string, label int"
    scored = training.score(training.train_baseline(spark.createDataFrame(rows, schema)).model, spark.createDataFrame(rows, schema), ["doc_id"])
    assert {r.pred for r in scored.collect()} == {1}
    with pytest.raises(ValueError):
        training.train_baseline(spark.createDataFrame([*rows, (9, "more words", -1)], schema))
    with pytest.raises(ValueError):
        training.train_baseline(spark.createDataFrame([*rows, (9, "more words", None)], schema))
