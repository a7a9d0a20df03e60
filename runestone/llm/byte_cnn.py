"""Language identification with a convolutional network over bytes.

Filters of several widths slide over the bytes of a window; the largest answer of each filter
is kept, and a softmax layer on top names the language. Training is plain numpy on
the driver, over a bounded sample. Prediction cuts every text into windows of one
length, all of it, runs them in batches and averages the windows' probabilities by their bytes.

A filter is a table of one weight per offset and byte value, so its answer is a sum of table
look-ups; for prediction two neighbouring offsets share one table of byte pairs.

Defined results: a null text, or one without a letter, is ``und`` with score 0. A null
language is never learned from. Without any labelled row every text is ``und``.
Repeated rows get equal answers. An empty table gives an empty table. Only doc_id,
text and (for learning) lang are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runestone.llm.common import column_of, map_batches

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
# At most this many documents are learned from, the same number of each language, and windows of each.
TRAIN_ROWS = 4000
TRAIN_WINDOWS = 4
EPOCHS = 8
BATCH = 64
RATE = 0.01
# Windows that are predicted at a time.
CHUNK = 512

_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, never learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(_ASCII_LETTER.search(text) or (not text.isascii() and _LETTER.search(text.decode("utf-8", "replace"))))


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a text, one after the other, the last one filled up with zeros."""
    count = -(-len(text) // WINDOW)
    return np.frombuffer(text.lower().ljust(count * WINDOW, b"\0"), np.uint8).reshape(count, WINDOW)


class ByteCNN:
    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.top = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.top_bias = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, self.bias, self.top, self.top_bias]

    def _pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        pooled, where = [], []
        for width, table in zip(WIDTHS, self.tables, strict=True):
            answers = sum(table[k][windows[:, k:WINDOW - width + 1 + k]] for k in range(width))
            at = answers.argmax(axis=1)
            where.append(at)
            pooled.append(np.take_along_axis(answers, at[:, None], axis=1)[:, 0])
        return np.concatenate(pooled, axis=1) + self.bias, where

    @staticmethod
    def _softmax(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy, and its gradient for each parameter."""
        n = len(windows)
        pooled, where = self._pooled(windows)
        active = np.maximum(pooled, 0)
        chances = self._softmax(active @ self.top + self.top_bias)
        loss = float(-np.log(chances[np.arange(n), labels] + 1e-9).mean())
        back = chances.copy()
        back[np.arange(n), labels] -= 1
        back /= n
        below = (back @ self.top.T) * (pooled > 0)
        out = []
        lines, filters = np.arange(n)[:, None], np.arange(FILTERS)[None]
        for i, width in enumerate(WIDTHS):
            own = below[:, i * FILTERS:(i + 1) * FILTERS]
            grad = np.zeros((width, 256 * FILTERS), np.float32)
            for k in range(width):
                # Only the bytes under a filter's largest answer learn.
                cells = windows[lines, where[i] + k].astype(np.int64) * FILTERS + filters
                grad[k] = np.bincount(cells.ravel(), own.ravel(), 256 * FILTERS)
            out.append(grad.reshape(width, 256, FILTERS))
        return loss, [*out, below.sum(axis=0), active.T @ back, back.sum(axis=0)]

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        losses, step = [], 0
        for _ in range(epochs):
            order, total = rng.permutation(len(windows)), 0.0
            for at in range(0, len(order), BATCH):
                chosen = order[at:at + BATCH]
                loss, grads = self.gradients(windows[chosen], labels[chosen])
                total += loss * len(chosen)
                step += 1
                rate = RATE * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                for p, g, m, v in zip(self.parameters(), grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
            losses.append(total / len(order))
        return losses

    def pair_tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """Per width, (offset, table by byte pair) and a last single offset where the width is odd."""
        out = []
        for width, table in zip(WIDTHS, self.tables, strict=True):
            own = [(k, (table[k][:, None] + table[k + 1][None]).reshape(65536, FILTERS)) for k in range(0, width - 1, 2)]
            out.append(own + ([(width - 1, table[-1])] if width % 2 else []))
        return out

    def predict(self, windows: np.ndarray, tables: list[list[tuple[int, np.ndarray]]]) -> np.ndarray:
        """Probabilities per window."""
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), CHUNK):
            part = windows[at:at + CHUNK]
            pairs = part[:, :-1].astype(np.uint16) << 8 | part[:, 1:]
            pooled = []
            for width, own in zip(WIDTHS, tables, strict=True):
                count = WINDOW - width + 1
                answers = None
                for offset, table in own:
                    cells = (pairs if len(table) > 256 else part)[:, offset:offset + count]
                    found = table.take(cells, axis=0)
                    answers = found if answers is None else np.add(answers, found, out=answers)
                pooled.append(answers.max(axis=1))
            active = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
            out[at:at + CHUNK] = self._softmax(active @ self.top + self.top_bias)
        return out


def training_windows(docs: DataFrame, rows: int = TRAIN_ROWS) -> list:
    """(lang, window) of a bounded, seeded sample of the labelled documents that are not held out.

    Languages get equal shares; a language with fewer documents gives all it has. One
    pass counts, another filters by a digest, so no language is gathered in one task.
    """
    labelled = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect()}
    if not sizes:
        return []
    share = max(1, rows // len(sizes))
    digest = F.conv(F.substring(F.md5(F.concat(F.lit("lang:"), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("long")
    wanted = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, 1.2 * share / n) * (1 << 32)))])
    chosen = labelled.filter(digest < F.element_at(wanted, F.col("lang"))).select("doc_id", "lang", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs, parts = [], [], []
            for doc, lang, text in zip(column_of(batch, "doc_id"), batch.column(1).to_pylist(), column_of(batch, "text"), strict=True):
                if has_letter(text):
                    every = windows_of(text)
                    picked = np.unique(np.linspace(0, len(every) - 1, TRAIN_WINDOWS).astype(int))
                    ids.append(doc)
                    langs.append(lang)
                    parts.append(every[picked].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(parts, pa.binary())], ["doc", "lang", "windows"])

    found: dict[str, list] = {}
    sample = chosen.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").mapInArrow(run, "doc long, lang string, windows binary")
    for row in sorted(sample.collect(), key=lambda r: (r["lang"], r["doc"], r["windows"])):
        found.setdefault(row["lang"], []).append(bytes(row["windows"]))
    return [(lang, parts[i]) for lang, parts in found.items() for i in np.random.default_rng(3).permutation(len(parts))[:share]]


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> ByteCNN | None:
    """A network fitted on the labelled documents that are not held out; None without any."""
    sample = training_windows(docs, rows)
    if not sample:
        return None
    languages = sorted({lang for lang, _ in sample})
    parts = [np.frombuffer(raw, np.uint8).reshape(-1, WINDOW) for _, raw in sample]
    labels = np.repeat([languages.index(lang) for lang, _ in sample], [len(p) for p in parts])
    model = ByteCNN(languages)
    model.fit(np.concatenate(parts), labels)
    return model


def identify(docs: DataFrame, model: ByteCNN | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some ten thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.pair_tables() if net else []
        for batch in batches:
            texts = column_of(batch, "text")
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            waiting, size = [], 0
            for i, text in enumerate(texts):
                if net and has_letter(text):
                    waiting.append((i, text))
                    size += len(text)
                if waiting and (size > 1 << 20 or i == len(texts) - 1):
                    _name(net, tables, waiting, names, scores)
                    waiting, size = [], 0
            if waiting:
                _name(net, tables, waiting, names, scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    columns = [F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")]
    return map_batches(docs, columns, "doc_id long, held_out boolean, lang_pred string, score double", run)


def _name(net: ByteCNN, tables: list, waiting: list[tuple[int, bytes]], names: list[str], scores: list[float]) -> None:
    windows = [windows_of(text) for _, text in waiting]
    chances = net.predict(np.concatenate(windows), tables).astype(np.float64)
    weights = np.concatenate([np.r_[np.full(len(w) - 1, WINDOW), len(t) - WINDOW * (len(w) - 1)] for w, (_, t) in zip(windows, waiting, strict=True)])
    ends = np.cumsum([len(w) for w in windows])
    sums = np.add.reduceat(chances * weights[:, None], np.r_[0, ends[:-1]], axis=0)
    for (i, text), line in zip(waiting, sums, strict=True):
        best = int(line.argmax())
        names[i], scores[i] = net.languages[best], min(1.0, float(line[best]) / len(text))
