"""A quality classifier by co-training two views of a document.

One view sees only the text's content, the other only the page's metadata (source,
language, declared length). Each round both are fitted, calibrated, and score every
unlabelled document; the documents of which one view is most certain join the
other's training rows with its verdict, one for all of equal features, and never twice. At the end the calibrated views are
combined, and score all documents.

Features are computed in one pass and written as a table of some hundred numbers a
document, so that rounds do not read texts. Models are fitted in numpy over bounded
rows: at most ``MAX_LABELLED`` labelled rows, by a seeded digest, and per round at most
``SHARE`` of that many pseudo-labelled rows per view and verdict. Scores, and the
choice of the most certain documents, cover all documents.

Defined results: a null or empty text has its own features (all zero), null metadata
are values of their own. Labels that contradict each other for one doc_id, or are
null, are not learned from. With labels of one class only, or none, every score is the
share of that class, or 0.5. Repeated rows get equal scores. An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runestone.llm.common import column_of
from runestone.session import settle

MAX_LABELLED = 20_000
ROUNDS = 3
# A view is certain from this calibrated probability on, for either verdict.
CERTAIN = 0.97
SHARE = 0.05
CALIBRATION = 4  # every fourth labelled row calibrates and is not fitted on

MARKS = b"!?#*$%&|<>=_~^@\\/{}[]+\""
SHAPES = 32
SOURCES, LANGUAGES = 64, 16
TEXT_SIZE, META_SIZE = 16 + SHAPES, 4 + SOURCES + LANGUAGES

FEATURES = "doc_id long, digest long, content binary, meta binary"
SCORES = "doc_id long, score double, content_score double, meta_score double, keep boolean"

_SHAPE = bytes(
    97 if 97 <= c <= 122 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 128 if c >= 128 else c for c in range(256)
)


def content_features(text: bytes | None) -> np.ndarray:
    """Shares and logarithms of counts, and a histogram of word shapes; zeros for a text without words."""
    out = np.zeros(TEXT_SIZE, np.float32)
    words = (text or b"").split()
    if not words:
        return out
    n, stuck = len(words), b"".join(words)
    size = len(stuck)
    lines = [line for line in text.split(b"\n") if line.strip()]
    capitals = size - len(stuck.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    small = size - len(stuck.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    digits = size - len(stuck.translate(None, b"0123456789"))
    marks = size - len(stuck.translate(None, MARKS))
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out[:16] = (
        1, np.log1p(n) / 8, size / n / 10, capitals / size, small / size, digits / size, marks / size, len(set(words)) / n, same / n,
        np.log1p(len(lines)) / 5, len(set(lines)) / len(lines), sum(w[-1:] in b".!?" for w in words) / n,
        sum(w in (b"|", b"-") for w in words) / n, sum(line.rstrip()[-1:] in b".!?" for line in lines) / len(lines),
        min(1.0, max(map(len, words)) / 100), min(1.0, n / 50),
    )
    shapes = np.zeros(SHAPES, np.float32)
    for shape in text.translate(_SHAPE).split():
        shapes[zlib.crc32(shape[:1] + shape[-2:]) % SHAPES] += 1
    out[16:] = shapes / shapes.sum()
    return out


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(META_SIZE, np.float32)
    length = np.log1p(max(0, n_chars or 0)) / 10
    out[:4] = 1, n_chars is None, length, length * length
    out[4 + zlib.crc32(repr(source).encode()) % SOURCES] = 1
    out[4 + SOURCES + zlib.crc32(repr(lang).encode()) % LANGUAGES] = 1
    return out


def features(docs: DataFrame) -> DataFrame:
    """doc_id, a digest that orders documents, and the features of both views."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = [content_features(t).tobytes() for t in column_of(batch, "text")]
            named = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("source", "lang", "n_chars")), strict=True)
            meta = [meta_features(*x).tobytes() for x in named]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(content, pa.binary()), pa.array(meta, pa.binary())],
                ["doc_id", "digest", "content", "meta"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.lit("co"), "doc_id").alias("digest"), F.col("text").cast("string").alias("text"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"),
    ).mapInArrow(run, FEATURES)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton steps."""
    x, w = x.astype(np.float64), np.zeros(x.shape[1])
    ridge = decay * len(x) * np.eye(x.shape[1]) + 1e-9 * np.eye(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        gradient = x.T @ (p - y) + ridge @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class View:
    """One view's weights and the calibration of their sum."""

    def __init__(self, x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray):
        self.weights = fit_logistic(x, y)
        self.scale = fit_logistic(self._raw(held_x), held_y, decay=1e-4)

    def _raw(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.ones(len(x)), np.clip(x @ self.weights, -20, 20)], axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self._raw(x) @ self.scale


def _matrix(raw: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float32).reshape(-1, size)


def labelled_rows(table: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """The features of documents with one clear label, ``y``; about ``most`` of them at most, by digest."""
    clear = (
        labels.filter(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("y"), F.max("quality").alias("_other")).filter(F.col("y") == F.col("_other")).drop("_other")
    )
    total = clear.count()
    share = min(1.0, most / max(1, total))
    position = F.xxhash64(F.lit("co"), "doc_id")
    chosen = clear.filter((position / F.lit(2.0**64) + 0.5) < share) if share < 1 else clear
    return table.join(chosen, "doc_id").dropDuplicates(["doc_id"])


def surest(rows: list[tuple], n: int) -> list[tuple]:
    """The ``n`` least of (doubt, digest, content, meta), one for each pair of features."""
    seen, out = set(), []
    for row in sorted(rows):
        if len(out) == n:
            break
        if row[2:] not in seen:
            seen.add(row[2:])
            out.append(row)
    return out


def most_certain(table: DataFrame, views: tuple[View, View], n: int, taken: tuple[set, set] = (set(), set())) -> list:
    """Per view and verdict, the ``n`` unlabelled documents it is most certain of, among all.

    One document stands for all of equal features. ``taken`` holds, per view, the features
    (content, meta) it has taught before; they are left out before the ranking.
    Every task keeps its ``n`` of each, so that few rows meet.
    """
    shared = table.sparkSession.sparkContext.broadcast(taken)  # at most 2 n a round and view

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list[tuple]] = {}
        for batch in batches:
            raw = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("digest", "content", "meta")]
            if not raw[0]:
                continue
            sides = (_matrix(raw[1], TEXT_SIZE), _matrix(raw[2], META_SIZE))
            for side in (0, 1):
                chance = _sigmoid(views[side].logits(sides[side]))
                for verdict in (0, 1):
                    sure = chance if verdict else 1 - chance
                    rows = [(-float(sure[i]), raw[0][i], raw[1][i], raw[2][i]) for i in np.flatnonzero(sure >= CERTAIN)
                            if (raw[1][i], raw[2][i]) not in shared.value[side]]
                    best[side, verdict] = surest(best.get((side, verdict), []) + rows, n)
        out = [(side, verdict, *row) for (side, verdict), rows in best.items() for row in rows]
        if out:
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["side", "verdict", "doubt", "digest", "content", "meta"]
            )

    found = settle(table.mapInArrow(run, "side int, verdict int, doubt double, digest long, content binary, meta binary"))
    found = found.groupBy("side", "verdict", "content", "meta").agg(F.min(F.struct("doubt", "digest")).alias("_first")).select(
        "side", "verdict", "_first.doubt", "_first.digest", "content", "meta")
    return [
        row for side in (0, 1) for verdict in (0, 1)
        for row in found.filter((F.col("side") == side) & (F.col("verdict") == verdict)).orderBy("doubt", "digest", "content", "meta").limit(n).collect()
    ]


class CoTrained:
    """Two calibrated views and their combination; or one score for all."""

    def __init__(self, prior: float, views: tuple[View, View] | None = None, combine: np.ndarray | None = None):
        self.prior, self.views, self.combine = prior, views, combine

    def scores(self, content: list[bytes], meta: list[bytes]) -> np.ndarray:
        """(combined, content, meta) per document."""
        if self.views is None:
            return np.full((len(content), 3), self.prior)
        sides = [v.logits(_matrix(raw, size)) for v, raw, size in zip(self.views, (content, meta), (TEXT_SIZE, META_SIZE), strict=True)]
        both = np.stack([np.ones(len(content)), *sides], axis=1) @ self.combine
        return np.stack([_sigmoid(both), *map(_sigmoid, sides)], axis=1)


def co_train(table: DataFrame, labels: DataFrame, rounds: int = ROUNDS, max_labelled: int = MAX_LABELLED) -> CoTrained:
    """Fit on a features table."""
    marked = settle(labelled_rows(table, labels, max_labelled))
    rows = sorted(marked.collect(), key=lambda r: (r["digest"], r["doc_id"]))
    y = np.array([r["y"] for r in rows], np.float64)
    if not len(y) or y.min() == y.max() or min(y.sum(), len(y) - y.sum()) < 2 * CALIBRATION:
        return CoTrained(float(y.mean()) if len(y) else 0.5)
    # Alternate within each class, so that both parts hold both.
    held = np.zeros(len(y), bool)
    for value in (0, 1):
        held[np.flatnonzero(y == value)[::CALIBRATION]] = True
    x = [_matrix([r[c] for r in rows], size) for c, size in (("content", TEXT_SIZE), ("meta", META_SIZE))]
    unlabelled = table.join(marked.select("doc_id"), "doc_id", "left_anti")
    extra: list[list] = [[], []]

    def fitted() -> tuple[View, View]:
        views = []
        for side, (name, size) in enumerate((("content", TEXT_SIZE), ("meta", META_SIZE))):
            more = _matrix([r[name] for r in extra[side]], size)
            verdicts = np.array([r["verdict"] for r in extra[side]], np.float64)
            views.append(View(np.concatenate([x[side][~held], more]), np.concatenate([y[~held], verdicts]), x[side][held], y[held]))
        return views[0], views[1]

    views, taken = fitted(), (set(), set())
    for _ in range(rounds):
        new = most_certain(unlabelled, views, max(1, int(SHARE * len(y))), taken)
        if not new:
            break
        for row in new:  # what one view is certain of teaches the other
            taken[row["side"]].add((bytes(row["content"]), bytes(row["meta"])))
            extra[1 - row["side"]].append(row)
        views = fitted()
    sides = [v.logits(part[held]) for v, part in zip(views, x, strict=True)]
    return CoTrained(float(y.mean()), views, fit_logistic(np.stack([np.ones(int(held.sum())), *sides], axis=1), y[held], decay=1e-4))


def score(table: DataFrame, model: CoTrained) -> DataFrame:
    """doc_id, the combined score, each view's score, and whether the combined one is at least 0.5."""
    shared = table.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.scores(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("content", "meta")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(found[:, i]) for i in range(3)), pa.array(found[:, 0] >= 0.5)],
                ["doc_id", "score", "content_score", "meta_score", "keep"],
            )

    return table.select("doc_id", "content", "meta").mapInArrow(run, SCORES)


def classify(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Scores of all documents by a model that is co-trained on the labelled ones."""
    table = settle(features(docs))
    return score(table, co_train(table, labels, rounds, max_labelled))
