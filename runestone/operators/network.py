"""A text classifier with an embedding bag and a hidden layer, trained in epochs across the cluster.

Words and pairs of neighbouring words are hashed to rows of an embedding table; a document is the sum
of its distinct rows over the root of their number, goes through one hidden layer and a softmax. The number of weights is
fixed by ``Shape`` and does not grow with the corpus, so they may be broadcast.

An epoch is one pass. The rows lie in shards, the same in every epoch; each shard starts from the
epoch's weights, takes mini-batch steps through its rows, and sends its weights on in blocks. The tasks
that get a block average it over the shards, weighted by rows, in the order of the shards, so
an epoch that is run again gives the same weights. They are written below the given folder: a
checkpoint for each epoch, and its losses. A fit that finds checkpoints goes on behind the last whole
one; the result is the checkpoint with the smallest validation loss.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions.tokens import word_tokens
from runestone.operators.features import class_weights
from runestone.session import remove_dir, settle

# Weights in one row of a checkpoint, and rows that are mixed before they are cut into batches.
BLOCK = 1 << 16
MIXED_ROWS = 4096
EPSILON = 1e-15
# Weights that a step changes at a time.
PART = 1 << 14
# Rows of a shard, at least, where their number is not given.
SHARD_ROWS = 1500

HISTORY = "epoch int, accuracy double, loss double, val_accuracy double, val_loss double"


@dataclass(frozen=True)
class Shape:
    """Sizes of the layers; everything that a checkpoint's meaning depends on."""

    classes: int
    buckets: int = 1 << 16
    width: int = 32
    hidden: int = 32

    def parts(self) -> dict[str, tuple[int, ...]]:
        return {
            "embedding": (self.buckets, self.width), "into_hidden": (self.width, self.hidden), "hidden": (self.hidden,),
            "into_classes": (self.hidden, self.classes), "classes": (self.classes,),
        }

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The layers as views of one array of weights."""
        out, at = {}, 0
        for name, shape in self.parts().items():
            size = int(np.prod(shape))
            out[name] = flat[at:at + size].reshape(shape)
            at += size
        return out

    @property
    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.parts().values())

    def begin(self, seed: int) -> np.ndarray:
        flat = np.zeros(self.size, np.float32)
        rng = np.random.default_rng(seed)
        for name, part in self.views(flat).items():
            if part.ndim == 2:
                part[:] = rng.normal(0, 0.1 if name == "embedding" else np.sqrt(2 / part.shape[0]), part.shape)
        return flat


def hashed_features(text: Column, buckets: int) -> Column:
    """Rows of the embedding table for the words of a text and its pairs of neighbouring words, each once."""
    words = word_tokens(F.lower(text))
    row = lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.when(b.isNotNull(), row(a, F.lit(" "), b)))
    return F.array_distinct(F.concat(F.transform(words, lambda w: row(w)), F.filter(pairs, lambda p: p.isNotNull())))


class Bags:
    """The embedding rows of several documents, one after the other."""

    def __init__(self, rows: list[np.ndarray]):
        self.lengths = np.array([len(r) for r in rows])
        self.flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.filled = np.flatnonzero(self.lengths)
        self.starts = (np.cumsum(self.lengths) - self.lengths)[self.filled]
        self.scale = 1 / np.sqrt(np.maximum(self.lengths, 1))[:, None]

    def sums(self, embedding: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.lengths), embedding.shape[1]), embedding.dtype)
        if len(self.filled):
            out[self.filled] = np.add.reduceat(embedding[self.flat], self.starts)
        return out * self.scale.astype(embedding.dtype)

    def spread(self, slopes: np.ndarray, into: np.ndarray) -> None:
        """Add the slope of each document to the rows it was summed from."""
        order = np.argsort(self.flat, kind="stable")
        if not len(order):
            return
        rows = self.flat[order]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        each = np.repeat(np.arange(len(self.lengths)), self.lengths)[order]
        into[rows[first]] += np.add.reduceat((slopes * self.scale.astype(slopes.dtype))[each], first)


def forward(layers: dict[str, np.ndarray], bags: Bags) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, hidden values and probabilities."""
    sums = bags.sums(layers["embedding"])
    hidden = np.maximum(sums @ layers["into_hidden"] + layers["hidden"], 0)
    scores = hidden @ layers["into_classes"] + layers["classes"]
    chances = np.exp(scores - scores.max(axis=1, keepdims=True))
    return sums, hidden, chances / chances.sum(axis=1, keepdims=True)


def loss_and_slopes(shape: Shape, flat: np.ndarray, bags: Bags, labels: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted mean log-loss of a batch and its derivative by every weight."""
    layers, slopes = shape.views(flat), np.zeros_like(flat)
    into = shape.views(slopes)
    sums, hidden, chances = forward(layers, bags)
    at = np.arange(len(labels))
    share = (weights / weights.sum()).astype(flat.dtype)
    loss = float(-(share * np.log(np.maximum(chances[at, labels], EPSILON))).sum())
    error = chances.copy()
    error[at, labels] -= 1
    error *= share[:, None]
    into["into_classes"][:] = hidden.T @ error
    into["classes"][:] = error.sum(axis=0)
    below = (error @ layers["into_classes"].T) * (hidden > 0)
    into["into_hidden"][:] = sums.T @ below
    into["hidden"][:] = below.sum(axis=0)
    bags.spread(below @ layers["into_hidden"].T, into["embedding"])
    return loss, slopes


class Steps:
    """Adam steps on a flat array of weights."""

    def __init__(self, flat: np.ndarray, rate: float):
        self.flat, self.rate, self.n = flat, rate, 0
        self.mean, self.square = np.zeros_like(flat), np.zeros_like(flat)

    def take(self, slopes: np.ndarray) -> None:
        self.n += 1
        rate = self.rate * np.sqrt(1 - 0.999 ** self.n) / (1 - 0.9 ** self.n)
        # A part at a time, which stays in the processor's cache between the operations.
        for at in range(0, len(self.flat), PART):
            flat, mean, square, slope = (a[at:at + PART] for a in (self.flat, self.mean, self.square, slopes))
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope * slope - square)
            flat -= (rate * mean / (np.sqrt(square) + 1e-7)).astype(flat.dtype)


def _documents(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    lists = batch.column(batch.schema.get_field_index("features"))
    values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    rows = [values[offsets[i]:offsets[i + 1]] for i in range(len(lists))]
    return rows, batch.column(batch.schema.get_field_index("label")).to_numpy(), batch.column(batch.schema.get_field_index("shard")).to_numpy()


@dataclass(frozen=True)
class Network:
    """The weights of a network, and where its labels stand."""

    shape: Shape
    flat: np.ndarray

    def probabilities(self, df: DataFrame, text: str = "clean_text", into: str = "probability") -> DataFrame:
        """Add ``array<double>`` in the row, in batches and on streams."""
        sent = df.sparkSession.sparkContext.broadcast(self.flat)
        shape = self.shape

        @F.pandas_udf("array<double>")
        def chances(features: pd.Series) -> pd.Series:
            out = []
            for at in range(0, len(features), MIXED_ROWS // 16):
                part = features.iloc[at:at + MIXED_ROWS // 16]
                rows = [np.zeros(0, np.int64) if f is None else np.asarray(f, np.int64) for f in part]
                out.extend(forward(shape.views(sent.value), Bags(rows))[2].astype("float64"))
            return pd.Series(out, index=features.index, dtype="object")

        return df.withColumn(into, chances(hashed_features(F.col(text), shape.buckets)))


@dataclass(frozen=True)
class TrainedNetwork:
    """The history of a fit, the epoch with the smallest validation loss, and its weights."""

    history: DataFrame
    best_epoch: int
    network: Network


def _trained(shape: Shape, sent, weights: dict[int, float], epoch: int, seed: int, batch_rows: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, seen, shard = Steps(sent.value.copy(), rate), 0, None
        rows: list[np.ndarray] = []
        labels: list[np.ndarray] = []

        def learn(n_mixed: int) -> None:
            own, ys = list(rows), np.concatenate(labels)
            order = np.random.default_rng([seed, epoch, int(shard), n_mixed]).permutation(len(own))
            ws = np.array([weights[int(y)] for y in ys])
            for at in range(0, len(order), batch_rows):
                part = order[at:at + batch_rows]
                steps.take(loss_and_slopes(shape, steps.flat, Bags([own[i] for i in part]), ys[part], ws[part])[1])
            rows.clear()
            labels.clear()

        for batch in batches:
            own, ys, shards = _documents(batch)
            for at in range(0, len(own), MIXED_ROWS):
                take = slice(at, at + MIXED_ROWS)
                shard = shards[0]
                rows += own[take]
                labels.append(ys[take])
                seen += len(own[take])
                if len(rows) >= MIXED_ROWS:
                    learn(seen)
        if rows:
            learn(seen)
        if not seen:
            return
        raw = [steps.flat[at:at + BLOCK].tobytes() for at in range(0, shape.size, BLOCK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(raw)), pa.int32()), pa.array([int(shard)] * len(raw), pa.int32()), pa.array([seen] * len(raw), pa.int64()), pa.array(raw, pa.binary())],
            ["block", "shard", "n", "values"],
        )

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of (block, shard, n, values): the mean of each block, one block in memory at a time."""
    block, total, n = None, None, 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([(total / n).astype("<f4").tobytes()], pa.binary())], ["block", "values"])

    for batch in batches:
        for i in range(batch.num_rows):
            mine, own, raw = batch.column(0)[i].as_py(), batch.column(2)[i].as_py(), batch.column(3)[i].as_buffer()
            if mine != block:
                if block is not None:
                    yield out()
                block, total, n = mine, 0.0, 0
            total = total + own * np.frombuffer(raw, "<f4").astype(np.float64)
            n += own
    if block is not None:
        yield out()


def _losses(shape: Shape, sent, validation: bool):
    """n, summed log-loss and right answers of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layers = shape.views(sent.value)
        n, loss, right, shard = 0, 0.0, 0, -1
        for batch in batches:
            rows, labels, shards = _documents(batch)
            for at in range(0, len(rows), MIXED_ROWS // 16):
                ys = labels[at:at + MIXED_ROWS // 16]
                chances = forward(layers, Bags(rows[at:at + MIXED_ROWS // 16]))[2].astype(np.float64)
                loss -= np.log(np.maximum(chances[np.arange(len(ys)), ys], EPSILON)).sum()
                right += int((chances.argmax(axis=1) == ys).sum())
                n, shard = n + len(ys), int(shards[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([validation]), pa.array([shard], pa.int32()), pa.array([n], pa.int64()), pa.array([float(loss)]), pa.array([right], pa.int64())],
            ["validation", "shard", "n", "loss", "correct"],
        )

    return run


def _sharded(df: DataFrame, label: str, text: str, key: str, buckets: int, shards: int) -> DataFrame:
    """Features of the rows, each shard a partition, in an order that depends on the rows alone."""
    features = df.filter(F.col(label).isNotNull()).select(
        F.col(label).cast("int").alias("label"), F.coalesce(hashed_features(F.col(text), buckets), F.array().cast("array<int>")).alias("features"),
        F.md5(F.concat_ws(":", F.lit("row"), F.col(key).cast("string"))).alias("place"),
    ).withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int"))
    return settle(features).repartitionById(shards, F.col("shard")).sortWithinPartitions("place", F.xxhash64("features")).persist(StorageLevel.MEMORY_AND_DISK)


def read_weights(spark: SparkSession, path: str, epoch: int) -> np.ndarray:
    """The weights of one checkpoint; their number is fixed by the shape."""
    blocks = spark.read.parquet(f"{path}/weights/epoch={epoch}").orderBy("block").collect()
    return np.concatenate([np.frombuffer(b["values"], "<f4") for b in blocks])


def load_network(spark: SparkSession, path: str, epoch: int) -> Network:
    saved = json.loads(spark.read.text(f"{path}/shape").first()[0])
    return Network(Shape(**saved["shape"]), read_weights(spark, path, epoch))


def _resumed(spark: SparkSession, path: str, plan: dict) -> list[tuple]:
    """The history of the whole epochs below ``path``; a folder of another plan raises."""
    try:
        saved = json.loads(spark.read.text(f"{path}/shape").first()[0])
    except AnalysisException:
        spark.createDataFrame([(json.dumps(plan),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/shape")
        return []
    if saved != plan:
        raise ValueError(f"{path} holds a fit of {saved}, not of {plan}")
    try:
        rows = spark.read.schema(HISTORY).parquet(f"{path}/history").orderBy("epoch").collect()
    except AnalysisException:
        return []
    whole = [tuple(r) for n, r in enumerate(rows) if r.epoch == n]
    return whole


def train_network(
    train: DataFrame,
    validation: DataFrame,
    path: str,
    label: str = "label",
    text: str = "clean_text",
    key: str = "doc_id",
    shape: Shape | None = None,
    epochs: int = 5,
    batch_rows: int = 16,
    rate: float = 0.01,
    shards: int | None = None,
    seed: int = settings.SEED,
    balanced: bool = True,
) -> TrainedNetwork:
    """Train for ``epochs`` epochs, with checkpoints below ``path``; the best one by validation loss is returned.

    Labels are 0, 1, 2 ...; rows without one are left out. The same call on a folder that holds some of
    the epochs runs the others only. Losses and accuracies are those of the weights at the end of an epoch.
    """
    spark, path = train.sparkSession, path.rstrip("/")
    counts = class_weights(train.filter(F.col(label).isNotNull()), label).collect()  # a row per class
    weights = {int(r[label]): r.weight for r in counts}
    if not weights:
        raise ValueError("no rows to learn from")
    if not balanced:
        weights = dict.fromkeys(weights, 1.0)
    shape = shape or Shape(max(weights) + 1)
    if min(weights) < 0 or max(weights) >= shape.classes:
        raise ValueError(f"labels are from 0 to {shape.classes - 1}")
    if 4 * shape.size > settings.BROADCAST_MAX_BYTES:
        raise ValueError(f"{4 * shape.size} bytes of weights, more than {settings.BROADCAST_MAX_BYTES}")
    # A shard with few rows takes few steps before the weights are averaged.
    shards = shards or max(1, min(spark.sparkContext.defaultParallelism, sum(r.n for r in counts) // SHARD_ROWS))
    plan = {"shape": asdict(shape), "shards": shards, "batch_rows": batch_rows, "rate": rate, "seed": seed, "balanced": balanced}
    history = _resumed(spark, path, plan)
    flat = read_weights(spark, path, len(history) - 1) if history else shape.begin(seed)
    if len(history) < epochs:
        tables = [_sharded(df, label, text, key, shape.buckets, shards) for df in (train, validation)]
        try:
            for epoch in range(len(history), epochs):
                history.append(_epoch(tables, shape, flat, weights, epoch, path, seed, batch_rows, rate))
                flat = read_weights(spark, path, epoch)
        finally:
            for table in tables:
                table.unpersist()
    history = history[:epochs]
    best = min(history, key=lambda r: (r[4], r[0]))[0]
    return TrainedNetwork(spark.createDataFrame(history, HISTORY), best, Network(shape, read_weights(spark, path, best)))


def _epoch(tables: list[DataFrame], shape: Shape, flat: np.ndarray, weights: dict, epoch: int, path: str, seed: int, batch_rows: int,
           rate: float) -> tuple:
    """One pass over the training rows; writes the checkpoint, then the losses that say it is whole."""
    spark = tables[0].sparkSession
    sent = spark.sparkContext.broadcast(flat)
    blocks = -(-shape.size // BLOCK)
    parts = tables[0].select("features", "label", "shard").mapInArrow(
        _trained(shape, sent, weights, epoch, seed, batch_rows, rate), "block int, shard int, n long, values binary")
    means = parts.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "shard").mapInArrow(_averaged, "block int, values binary")
    # A checkpoint that was only begun is replaced.
    remove_dir(spark, f"{path}/weights/epoch={epoch}")
    means.write.parquet(f"{path}/weights/epoch={epoch}")
    sent.unpersist()
    now = spark.sparkContext.broadcast(read_weights(spark, path, epoch))
    measured = [
        table.select("features", "label", "shard").mapInArrow(_losses(shape, now, part), "validation boolean, shard int, n long, loss double, correct long")
        for part, table in zip((False, True), tables, strict=True)
    ]
    # One row per shard; added in their order, so that the sums do not depend on the run.
    found = measured[0].unionByName(measured[1]).filter("n > 0").orderBy("validation", "shard").collect()
    figures = []
    for part in (False, True):
        own = [r for r in found if r.validation == part]
        n = sum(r.n for r in own)
        figures += [sum(r.correct for r in own) / n, sum(r.loss for r in own) / n] if n else [float("nan"), float("inf")]
    now.unpersist()
    row = (epoch, *figures)
    spark.createDataFrame([row], HISTORY).coalesce(1).write.mode("append").parquet(f"{path}/history")
    return row


def network_scorer(network: Network) -> Callable[[DataFrame], DataFrame]:
    """A scorer for ``score_batch``."""
    return lambda df: network.probabilities(df)
