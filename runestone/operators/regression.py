"""Multinomial logistic regression with an L2 penalty, fitted across the cluster.

Minimises mean weighted log-loss + penalty / 2 * |coefficients|^2, the objective of Spark's
``LogisticRegression`` without standardization. Spark takes its steps in features divided by their deviation,
where the penalty of a rare term is thousands of times that of a common one, and needs a pass over the rows for each
of a thousand steps. Here the steps are taken in the features themselves, which the penalty treats alike.

The rows are packed once into blocks of sparse rows, which stay on the executors: counts and places in as few bytes as they
need, what belongs to a feature (its idf) or to a row (its norm) only once. A step sends the weights out and adds the
blocks' losses and gradients task by task: as many numbers as there are weights, whatever the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entries of a block, and of the rows that are added to it at a time.
BLOCK_ENTRIES = 1 << 18
# Steps that the direction of the next one is made of, and over which the loss must improve.
MEMORY = 10
# Tasks of a step for each core: a task adds up what it reads, so more of them only send more sums.
TASKS_PER_CORE = 2
# Sums of up to this size in all go to the driver as they are; larger ones are added in a tree of tasks before.
DIRECT_BYTES = 64 << 20

# Entries of each row, their places and values; label, weight and factor of each row.
BLOCK = ["rows", "places", "values", "labels", "weights", "factors"]
BLOCK_SCHEMA = ", ".join(f"{name} binary" for name in BLOCK)

Block = tuple[np.ndarray, ...]


def cuts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Start and end of runs of rows with about ``most`` entries in all."""
    at = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // most)) + 1
    return ((int(start), int(end)) for start, end in zip([0, *at], [*at, len(sizes)]) if start < end)


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """The same numbers from 0, in as few bytes as the largest needs."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))


def raw_block(lengths: np.ndarray, places: np.ndarray, values: np.ndarray, labels: np.ndarray, weights: np.ndarray,
              factors: np.ndarray | None = None) -> list[bytes]:
    """A block as stored. ``values`` are counts, or any numbers as doubles."""
    values = _narrow(values) if values.dtype.kind in "iu" else values.astype("<f8")
    arrays = (lengths.astype("<u4"), _narrow(places), values, labels.astype("<i4"), weights.astype("<f8"),
              np.ones(len(lengths)) if factors is None else factors.astype("<f8"))
    return [a.tobytes() for a in arrays]


def batch_of(raw: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r], pa.binary()) for r in raw], BLOCK[:len(raw)])


def _sparse(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and value of the entries of an array of vectors, dense or sparse."""
    n = len(vectors)
    values, indices = vectors.field("values"), vectors.field("indices")
    flat = values.flatten().to_numpy(zero_copy_only=False)
    lengths = values.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(n, dtype=np.int32), lengths.astype(np.int64))
    places = np.arange(len(flat), dtype=np.int32) - np.repeat(np.cumsum(lengths) - lengths, lengths.astype(np.int64)).astype(np.int32)
    listed = vectors.field("type").to_numpy(zero_copy_only=False)[rows] == 0
    places[listed] = indices.flatten().to_numpy(zero_copy_only=False)
    kept = flat != 0
    return rows[kept], places[kept], flat[kept]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of (label, weight, features) rows."""
    for batch in batches:
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        sizes = column["features"].field("values").value_lengths().to_numpy(zero_copy_only=False)
        for start, end in cuts(sizes, BLOCK_ENTRIES):
            part = {name: c.slice(start, end - start) for name, c in column.items()}
            rows, places, values = _sparse(part["features"])
            labels, weights = (part[name].to_numpy(zero_copy_only=False) for name in ("label", "weight"))
            yield batch_of(raw_block(np.bincount(rows, minlength=end - start), places, values, labels, weights))


def _block(row) -> Block:
    """Row, place and value of each entry, in the order of the rows; label, weight and factor of each row."""
    lengths = np.frombuffer(row[0], "<u4")
    rows = np.repeat(np.arange(len(lengths)), lengths)
    wide = len(row[2]) // max(1, len(rows))
    places = np.frombuffer(row[1], f"<u{len(row[1]) // max(1, len(rows)) or 1}").astype(np.intp)
    values = np.frombuffer(row[2], "<f8" if wide == 8 else f"<u{wide or 1}")
    return rows, places, values, *(np.frombuffer(raw, t) for raw, t in zip(row[3:], ("<i4", "<f8", "<f8")))


def row_sums(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The sum of the values of each of ``n`` rows; ``rows`` does not fall."""
    starts = np.searchsorted(rows, np.arange(n + 1))
    filled = np.flatnonzero(np.diff(starts))
    out = np.zeros(n)
    if len(filled):
        out[filled] = np.add.reduceat(values, starts[filled])
    return out


def loss_and_gradient(block: Block, weights: np.ndarray, features: int) -> np.ndarray:
    """The sum of a block's weighted losses, and behind it the sums of their slopes by ``weights``: a line per
    class, of its coefficients and its intercept.

    Only differences between classes count, so the scores of the first one are 0, and its slopes those of the others, negated.
    """
    rows, places, values, labels, shares, *factors = block
    classes, n = len(weights), len(labels)
    factor = factors[0] if factors else 1.0
    scores = np.zeros((classes, n))
    for c in range(1, classes):
        own = weights[c] - weights[0]
        scores[c] = row_sums(rows, values * own.take(places), n) * factor + own[features]
    scores -= scores.max(axis=0)
    chances = np.exp(scores)
    total = chances.sum(axis=0)
    at = np.arange(n)
    out = np.zeros(1 + classes * (features + 1))
    out[0] = (shares * (np.log(total) - scores[labels, at])).sum()
    error = chances / total
    error[labels, at] -= 1
    error *= shares
    slopes = out[1:].reshape(classes, features + 1)
    for c in range(1, classes):
        slopes[c, :features] = np.bincount(places, values * (error[c] * factor)[rows], features)
        slopes[c, features] = error[c].sum()
    slopes[0] = -slopes[1:].sum(axis=0)
    return out


def minimize(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, max_iter: int,
             tol: float) -> tuple[np.ndarray, list[float]]:
    """L-BFGS with backtracking: the point, and the loss before and after each step.

    Ends when the last ``MEMORY`` steps together improved the loss by ``tol`` of its first value at most, when the gradient is within
    ``tol`` of the loss, or when no step along the gradient improves it.
    """
    loss, slope = evaluate(x)
    losses, steps = [loss], []
    while len(losses) <= max_iter and np.linalg.norm(slope) > max(tol * abs(loss), 1e-8):
        way, used = -slope, []
        for s, y, inner in reversed(steps):
            used.append(s @ way / inner)
            way = way - used[-1] * y
        if steps:
            s, y, inner = steps[-1]
            way = way * (inner / (y @ y))
        for (s, y, inner), a in zip(steps, reversed(used)):
            way = way + (a - y @ way / inner) * s
        fall = slope @ way
        if fall >= 0:
            way, steps, fall = -slope, [], -(slope @ slope)
        length = 1.0 if steps else 1.0 / np.linalg.norm(slope)
        while True:
            after, steeper = evaluate(x + length * way)
            if after <= loss + 1e-4 * length * fall:
                break
            length /= 2
            if length * np.abs(way).max() < 1e-12:
                break
        if not after < loss:
            if not steps:
                break
            steps = []
            continue
        s, y = length * way, steeper - slope
        if s @ y > 1e-12 * (y @ y):
            steps = [*steps, (s, y, s @ y)][-MEMORY:]
        x, loss, slope = x + s, after, steeper
        losses.append(loss)
        if len(losses) > MEMORY and losses[-1 - MEMORY] - loss <= tol * losses[0]:
            break
    return x, losses


def class_totals(df: DataFrame, label: str, weight: str) -> dict[int, tuple[float, int]]:
    """Weight and number of the rows of each class. Labels are 0, 1, 2 ..."""
    counts = df.groupBy(F.col(label).cast("double").alias("label")).agg(
        F.sum(weight).alias("total"), F.count(F.lit(1)).alias("n")).collect()  # a row per class
    if any(r.label is None or r.label < 0 or r.label != int(r.label) for r in counts):
        raise ValueError("labels are whole numbers from 0")
    if not counts:
        raise ValueError("no rows to learn from")
    return {int(r.label): (r.total, r.n) for r in counts}


def fit(df: DataFrame, label: str, weight: str, c: float, max_iter: int, tol: float,
        features: str = "features") -> tuple[LogisticRegressionModel, list[float]]:
    """The fitted model, and the objective before and after each step. Labels are 0, 1, 2 ...

    The penalty is 1 / (c * rows), so that it matches a total-loss objective where the weights add up to the rows.
    """
    given = df.select(F.col(label).cast("double").alias("label"), F.col(weight).alias("weight"), F.col(features).alias("features"))
    totals = class_totals(given, "label", "weight")
    size = len(given.select("features").first()[0])
    packed = given.withColumn("label", F.col("label").cast("int")).mapInArrow(_packed, BLOCK_SCHEMA)
    return fit_blocks(packed, totals, np.ones(size), c, max_iter, tol)


def fit_blocks(blocks: DataFrame, totals: dict[int, tuple[float, int]], scale: np.ndarray, c: float, max_iter: int,
               tol: float) -> tuple[LogisticRegressionModel, list[float]]:
    """``fit`` on rows that are packed already; a feature is its value times its ``scale`` and the factor of its row."""
    size, classes = len(scale), max(totals) + 1
    total, rows = sum(t for t, _ in totals.values()), sum(n for _, n in totals.values())
    penalty = 1.0 / (c * rows)
    begin = np.zeros((classes, size + 1))
    for own, (weight, _) in totals.items():
        begin[own, size] = np.log1p(weight)
    begin[:, size] -= begin[:, size].mean()
    if len(totals) == 1:  # one class has all the chances, as Spark's model of constant labels
        begin[:] = 0
        begin[classes - 1, size] = np.inf
        return _model(begin), []
    scales = np.append(scale, 1.0)
    blocks = blocks.select(*BLOCK).persist(StorageLevel.MEMORY_AND_DISK)

    def evaluate(flat: np.ndarray) -> tuple[float, np.ndarray]:
        weights = flat.reshape(classes, size + 1)
        found = summed(blocks, loss_and_gradient, weights * scales, size)
        slopes = found[1:].reshape(classes, size + 1) * scales / total
        slopes[:, :size] += penalty * weights[:, :size]
        return float(found[0] / total + penalty / 2 * (weights[:, :size] ** 2).sum()), slopes.ravel()

    try:
        # Packed by all tasks at once; every step is a job of few tasks.
        blocks.count()
        flat, losses = minimize(evaluate, begin.ravel(), max_iter, tol)
    finally:
        blocks.unpersist()
    weights = flat.reshape(classes, size + 1).copy()
    weights[:, size] -= weights[:, size].mean()
    return _model(weights), losses


def summed(blocks: DataFrame, work: Callable[..., np.ndarray], sent: np.ndarray | None, features: int) -> np.ndarray:
    """The sum of ``work(block, sent, features)`` over all blocks, added in the tasks first."""
    context = blocks.sparkSession.sparkContext
    shared = context.broadcast(sent)

    def added(parts: Iterator[tuple]) -> Iterator[np.ndarray]:
        sums = None
        for raw in parts:
            own = work(_block(raw), shared.value, features)
            sums = own if sums is None else np.add(sums, own, out=sums)
        if sums is not None:
            yield sums

    sums = blocks.coalesce(TASKS_PER_CORE * context.defaultParallelism).rdd.mapPartitions(added)
    size = 8 * (features + 1) * (1 if sent is None else len(sent))
    found = sums.reduce(np.add) if sums.getNumPartitions() * size <= DIRECT_BYTES else sums.treeReduce(np.add)
    shared.destroy()
    return found


def places_of(terms: pa.Array, known: pa.Array) -> np.ndarray:
    """The position of each term among the known ones, -1 for others."""
    return pc.index_in(terms.cast(known.type), known).fill_null(-1).to_numpy(zero_copy_only=False)


def normalized(blocks: DataFrame, scale: np.ndarray, terms: list[str] | None = None) -> DataFrame:
    """The blocks with the factors that make a row's values times ``scale`` a vector of length 1.

    Where ``terms`` are given, the places become positions in them, and other terms are left out.
    """
    shared = blocks.sparkSession.sparkContext.broadcast((scale, terms and pa.array(terms)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale, known = shared.value
        for batch in batches:
            for at in range(batch.num_rows):
                raw = [batch.column(name)[at].as_py() for name in BLOCK]
                rows, places, values, labels, weights, _ = _block(raw)
                if known is not None:
                    places = places_of(batch.column("terms")[at].values, known)[places]
                    kept = places >= 0
                    rows, places, values = rows[kept], places[kept], values[kept]
                norms = np.sqrt(row_sums(rows, (values * scale[places]) ** 2, len(labels)))
                factors = 1.0 / np.where(norms > 0, norms, 1.0)
                yield batch_of(raw_block(
                    np.bincount(rows, minlength=len(labels)), places, values, labels, weights, factors))

    needed = BLOCK if terms is None else ["terms", *BLOCK]
    return blocks.select(*needed).mapInArrow(run, BLOCK_SCHEMA)


def _model(weights: np.ndarray) -> LogisticRegressionModel:
    """A Spark ML model of these weights. It is without a training summary: that holds the session, and a
    session in which rows were observed cannot be sent to the executors with the model."""
    classes, size = len(weights), weights.shape[1] - 1
    context = SparkContext.getOrCreate()
    matrix = DenseMatrix(classes, size, weights[:, :size].ravel(order="F").tolist())
    return LogisticRegressionModel._create_from_java_class(
        "org.apache.spark.ml.classification.LogisticRegressionModel", f"LogisticRegression_{uuid.uuid4().hex[:12]}",
        _py2java(context, matrix), _py2java(context, Vectors.dense(weights[:, size].tolist())), classes, True)
