"""The network's gradients, its distributed epochs, checkpoints and restarts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from runestone.operators import network
from runestone.operators.network import Bags, Shape, loss_and_slopes, train_network
from runestone.session import fresh_dir, remove_dir

SMALL = {"shape": Shape(2, buckets=256, width=8, hidden=6), "epochs": 3, "shards": 3, "batch_rows": 8}


def batch(rng, shape, n):
    rows = [rng.integers(0, shape.buckets, rng.integers(0, 9)) for _ in range(n)]
    return Bags(rows), rng.integers(0, shape.classes, n), rng.uniform(0.5, 2, n)


def test_gradients_equal_differences():
    rng, shape = np.random.default_rng(1), Shape(3, buckets=20, width=4, hidden=5)
    flat = rng.normal(size=shape.size)
    bags, labels, weights = batch(rng, shape, 12)
    _, slopes = loss_and_slopes(shape, flat, bags, labels, weights)
    for i in range(shape.size):
        ends = []
        for step in (1e-6, -1e-6):
            moved = flat.copy()
            moved[i] += step
            ends.append(loss_and_slopes(shape, moved, bags, labels, weights)[0])
        assert abs((ends[0] - ends[1]) / 2e-6 - slopes[i]) < 1e-6


def test_bags_of_nothing():
    shape = Shape(2, buckets=4, width=3, hidden=2)
    flat = shape.begin(1)
    for rows in ([np.zeros(0, np.int64)], [np.zeros(0, np.int64), np.array([1, 1])]):
        loss, slopes = loss_and_slopes(shape, flat, Bags(rows), np.zeros(len(rows), int), np.ones(len(rows)))
        assert np.isfinite(loss) and np.isfinite(slopes).all()


@pytest.fixture(scope="module")
def split(spark):
    """Neither word tells the class alone: that both or none are there does."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(900):
        a, b = rng.integers(0, 2, 2)
        words = [f"w{rng.integers(0, 40)}" for _ in range(6)] + ["left"] * a + ["right"] * b
        rows.append((i, " ".join(rng.permutation(words)) if i != 17 else None, int(a == b) if i != 18 else None, "x"))
    df = spark.createDataFrame(rows, "doc_id long, clean_text string, label int, features string").repartition(5).cache()
    return df.filter("doc_id < 700"), df.filter("doc_id >= 700")


@pytest.fixture(scope="module")
def fitted(spark, split):
    path = fresh_dir(spark, "network")
    return path, train_network(*split, path, **SMALL)


def figures(spark, path, epoch, rows):
    """Accuracy and loss of stored weights, every document by itself."""
    net = network.load_network(spark, path, epoch)
    features = rows.filter("label IS NOT NULL").select("label", network.hashed_features(F.col("clean_text"), net.shape.buckets).alias("f")).collect()
    layers = net.shape.views(net.flat)
    chances = []
    for r in features:
        own = sorted(set(r.f or []))
        total = layers["embedding"][own].sum(axis=0) / np.sqrt(max(1, len(own)))
        scores = np.maximum(total @ layers["into_hidden"] + layers["hidden"], 0) @ layers["into_classes"] + layers["classes"]
        chances.append(np.exp(scores) / np.exp(scores).sum())
    chances, labels = np.array(chances), np.array([r.label for r in features])
    return (chances.argmax(axis=1) == labels).mean(), -np.log(chances[np.arange(len(labels)), labels]).mean()


def test_history_is_that_of_the_checkpoints(spark, split, fitted):
    path, fit = fitted
    history = fit.history.orderBy("epoch").collect()
    assert [r.epoch for r in history] == [0, 1, 2] and fit.best_epoch == min(history, key=lambda r: r.val_loss).epoch
    for r in history:
        for rows, accuracy, loss in ((split[0], r.accuracy, r.loss), (split[1], r.val_accuracy, r.val_loss)):
            want = figures(spark, path, r.epoch, rows)
            assert abs(want[0] - accuracy) < 2e-3 and abs(want[1] - loss) < 1e-4
    assert (fit.network.flat == network.read_weights(spark, path, fit.best_epoch)).all()


def test_restart_gives_the_same_end(spark, split, fitted):
    path, fit = fitted
    again = fresh_dir(spark, "network")
    train_network(*split, again, **{**SMALL, "epochs": 1})
    # A lost driver: the next epoch's weights were begun, its losses were not.
    spark.range(1).write.parquet(f"{again}/weights/epoch=1")
    resumed = train_network(split[0].repartition(2), split[1], again, **SMALL)
    assert sorted(map(tuple, resumed.history.collect())) == sorted(map(tuple, fit.history.collect()))
    for epoch in range(3):
        assert (network.read_weights(spark, again, epoch) == network.read_weights(spark, path, epoch)).all()
    before = resumed.history.count()
    assert train_network(*split, again, **SMALL).history.count() == before
    with pytest.raises(ValueError, match="holds a fit of"):
        train_network(*split, again, **{**SMALL, "rate": 0.5})
    assert remove_dir(spark, again)


def test_learns_what_no_linear_model_can():
    """Words 0 and 1: the class says whether both or none of them are there."""
    rng, shape = np.random.default_rng(3), Shape(2, buckets=30, width=8, hidden=16)
    steps = network.Steps(shape.begin(5), 0.02)

    def draw(n):
        both = rng.integers(0, 2, (n, 2))
        rows = [np.array([w for w in (0, 1) if b[w]] + rng.integers(2, 30, 3).tolist()) for b in both]
        return Bags(rows), (both[:, 0] == both[:, 1]).astype(int)

    for _ in range(600):
        bags, labels = draw(32)
        steps.take(loss_and_slopes(shape, steps.flat, bags, labels, np.ones(32))[1])
    bags, labels = draw(500)
    assert (network.forward(shape.views(steps.flat), bags)[2].argmax(axis=1) == labels).mean() > 0.95


def test_probabilities_in_the_row(spark, split, fitted):
    scored = fitted[1].network.probabilities(split[1])
    assert "Exchange" not in scored.select("doc_id", "probability")._jdf.queryExecution().executedPlan().toString().replace("ReusedExchange", "").split("InMemoryTableScan")[0]
    rows = scored.collect()
    assert len(rows) == 200 and all(abs(sum(r.probability) - 1) < 1e-6 for r in rows)


def test_faults(spark, split):
    with pytest.raises(ValueError, match="no rows"):
        train_network(split[0].filter("false"), split[1], fresh_dir(spark, "network"), **SMALL)
    with pytest.raises(ValueError, match="labels are"):
        train_network(split[0].withColumn("label", F.col("label") + 2), split[1], fresh_dir(spark, "network"), **SMALL)
    with pytest.raises(ValueError, match="bytes of weights"):
        train_network(*split, fresh_dir(spark, "network"), **{**SMALL, "shape": Shape(2, buckets=1 << 22)})
