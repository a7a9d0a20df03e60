"""Substring dedup: token windows that occur anywhere else are cut out.

Every window of ``WINDOW`` words gets a rolling polynomial hash (Rabin-Karp). Spark
counts the hashes; the windows of a document that are repeated merge into maximal
intervals, and their words go.

How the counting is shuffled: a task hashes a block of documents at a time. What
repeats inside the block is known at once, so a window leaves a block once at most,
however hot it is. The block's hashes are dealt into ranges; a row holds all hashes
of one block and range, 7 bytes each, with the gaps of their places (about one
byte each), instead of one row of 40 bytes per window. Each range fits in the
memory of a task, as the number of ranges follows the size of the corpus; it finds
the hashes that came from two or more blocks, and answers each block with one row of
places. The answers to a block meet, and become a row per document.

Two windows count as equal when 56 bits of one hash and the range, taken from
another hash, agree: with N windows in ranges of R, about N * R / 2^57 pairs are
equal by chance: one in 3,000 corpora of 100 million windows, a few hundred windows in 10^13.

Defined results: a null or empty text has no words. Texts of fewer than ``WINDOW``
words lose nothing. Repeated rows are repeated windows, so both lose them. Rows are
told apart by doc_id and text, so rows equal in both lose the same. A null doc_id
is an id of its own. An empty table gives an empty table. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runestone.llm.common import column_of, id_or_lowest, map_batches, text_key

WINDOW = 35
# Windows in a block of documents, and windows that one range holds on average.
BLOCK_WORDS = 1_000_000
RANGE_WINDOWS = 2_000_000
# Bytes of a word with the white space after it, from below: for the number of ranges only.
WORD_BYTES = 6
# Words whose hash a task remembers, in each of two generations.
REMEMBERED = 100_000
# Bytes of text, or of answers, in a batch that leaves a task.
SENT_BYTES = 4 << 20

# Fixed odd multipliers of the two rolling hashes.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))

# The documents of a block are told in one of its rows.
DEALT = "range int, block long, hashes binary, gaps binary, docs binary"
ANSWERS = "block long, gaps binary, docs binary"
FOUND = "doc long, row long, places binary"
INTERVALS = "doc long, row long, starts array<int>, ends array<int>"


class WordHashes:
    """64-bit hashes of words; frequent words are hashed once per task, and forgotten with it."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        # Asked word by word: a difference of sets would walk through all known words.
        for word in [w for w in set(words) if w not in self.known]:
            number = self.older.get(word)
            self.known[word] = xxhash.xxh3_64_intdigest(word) if number is None else number
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(numbers: np.ndarray, window: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash modulo 2^64 of every ``window`` consecutive numbers.

    Hashes of 1, 2, 4 ... numbers are put together, so it takes as many steps as the window has bits.
    """
    count = len(numbers) - window + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total, done = np.zeros(count, np.uint64), 0
    part, size, power = numbers, 1, base
    while size <= window:
        if window & size:
            # The next ``size`` numbers after those done, appended: total * base^size + part.
            total = total * power + part[done:done + count]
            done += size
        if 2 * size <= window:
            part = part[:-size] * power + part[size:]
        size, power = 2 * size, np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
    return _mixed(total)


def _starts(places: np.ndarray) -> bytes:
    """Increasing places as gaps, the bytes of equal weight side by side: the upper ones are nearly all 0."""
    gaps = np.diff(places, prepend=0).astype("<u4")
    return gaps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _places(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


class _Block:
    """Documents whose windows are hashed together."""

    def __init__(self, window: int, ranges: int):
        self.window, self.ranges = window, ranges
        self.hashes = WordHashes()
        self.clear()

    def clear(self) -> None:
        self.docs: list[int] = []
        self.rows: list[int] = []
        self.lengths: list[int] = []
        self.numbers: list[np.ndarray] = []
        self.words = 0

    def add(self, doc: int, row: int, text: bytes | None) -> None:
        words = (text or b"").split()
        if len(words) >= self.window:
            self.docs.append(doc)
            self.rows.append(row)
            self.lengths.append(len(words))
            self.numbers.append(self.hashes.of(words))
            self.words += len(words)

    def dealt(self) -> Iterator[tuple]:
        numbers = np.concatenate(self.numbers)
        lengths = np.array(self.lengths)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        # Windows that do not reach into the next document.
        inside = np.ones(len(numbers), bool)
        for k in range(1, self.window):
            inside[starts[1:] - k] = False
        at = np.flatnonzero(inside)
        first, second = (window_hashes(numbers, self.window, base)[at] for base in BASES)
        order = np.argsort(first, kind="stable")
        hashes = first[order]
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (second[order][1:] != second[order][:-1])])
        alone = new & np.concatenate([new[1:], [True]])
        again = np.sort(at[order[~alone]])
        ids = np.array([self.docs, self.rows], "<i8")
        # Named by its documents, so a task that is run again gives a block the same name.
        block = np.frombuffer(xxhash.xxh3_64_digest(ids.tobytes()), "<i8")[0].item()
        docs = np.concatenate([ids, starts[None, :-1].astype("<i8")]).tobytes()
        # What is known here already only passes through a range, with the documents.
        yield block % self.ranges, block, None, _starts(again), docs
        # One window of each hash goes on, in the order of the documents.
        chosen = np.sort(order[new])
        target = ((first[chosen] >> np.uint64(32)) * np.uint64(self.ranges) >> np.uint64(32)).astype(np.int64)
        by_range = np.argsort(target, kind="stable")
        edges = np.searchsorted(target[by_range], np.arange(self.ranges + 1))
        keys = second[chosen].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]
        for n in np.flatnonzero(np.diff(edges)).tolist():
            own = by_range[edges[n]:edges[n + 1]]
            yield n, block, np.ascontiguousarray(keys[own]).tobytes(), _starts(at[chosen[own]]), None


def _deal(window: int, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(window, ranges)
        for batch in batches:
            for doc, row, text in zip(column_of(batch, "doc"), column_of(batch, "row"), column_of(batch, "text"), strict=True):
                block.add(doc, row, text)
                if block.words >= BLOCK_WORDS:
                    yield _dealt_batch(block.dealt())
                    block.clear()
        if block.words:
            yield _dealt_batch(block.dealt())

    return run


def _dealt_batch(rows: Iterator[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = [x.split()[0] for x in DEALT.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.binary(), pa.binary()], strict=True)], ["block", "gaps", "docs"]
    )


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range: hashes that came from more than one block, as one row of places for each block."""
    keys, gaps_of, blocks = [], [], []
    for batch in batches:
        block_ids, hashes_of = batch.column(1), batch.column(2)
        for n in range(batch.num_rows):
            # The values of one row at a time: the batch itself is not turned into Python values.
            block, gaps = block_ids[n].as_py(), batch.column(3)[n].as_py()
            if not hashes_of[n].is_valid:
                yield _answers([(block, gaps, batch.column(4)[n].as_py())])
                continue
            seven = np.frombuffer(hashes_of[n].as_buffer(), np.uint8).reshape(-1, 7)
            eight = np.zeros((len(seven), 8), np.uint8)
            eight[:, :7] = seven
            keys.append(eight.view("<u8").ravel())
            gaps_of.append(gaps)
            blocks.append(block)
    if not keys:
        return
    ends = np.cumsum([len(k) for k in keys])
    merged = np.concatenate(keys)
    keys.clear()
    order = np.argsort(merged, kind="stable")
    merged = merged[order]
    same = merged[1:] == merged[:-1]
    del merged
    again = np.sort(order[np.concatenate([[False], same]) | np.concatenate([same, [False]])])
    del order, same
    edges = np.searchsorted(again, np.concatenate([[0], ends]))
    out, size = [], 0
    for n, block in enumerate(blocks):
        own = again[edges[n]:edges[n + 1]] - (ends[n - 1] if n else 0)
        if len(own):
            out.append((block, _starts(_places(gaps_of[n])[own]), None))
            size += len(out[-1][1])
        if size > SENT_BYTES:
            yield _answers(out)
            out, size = [], 0
    if out:
        yield _answers(out)


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The answers to one block, as a row for each document with places."""
    for batch in batches:
        for answers in batch.column(1).to_pylist():
            # Of repeated blocks any one will do: their documents are the same.
            table = np.frombuffer(next(a["docs"] for a in answers if a["docs"] is not None), "<i8").reshape(3, -1)
            at = np.unique(np.concatenate([_places(a["gaps"]) for a in answers]))
            owner = np.searchsorted(table[2], at, "right") - 1
            cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][:len(at)]).tolist()
            ends = [*cut[1:], len(at)][:len(cut)]
            held = [table[:, owner[s]] for s in cut]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(d[0]) for d in held], pa.int64()), pa.array([int(d[1]) for d in held], pa.int64()),
                 pa.array([(at[s:e] - d[2]).astype("<u4").tobytes() for d, s, e in zip(held, cut, ends, strict=True)], pa.binary())],
                ["doc", "row", "places"],
            )


def merged(places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals [start, end) that windows at these places cover or touch."""
    places = np.unique(places.astype(np.int64))
    cut = np.flatnonzero(np.diff(places) > window) + 1
    starts = places[np.concatenate([[0], cut])]
    ends = places[np.concatenate([cut - 1, [len(places) - 1]])] + window
    return starts, ends


def removal_intervals(docs: DataFrame, window: int = WINDOW, range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """Per document (and text) that loses words: word intervals [starts, ends) to remove."""
    text = F.col("text").cast("string")
    keyed = [id_or_lowest(F.col("doc_id")).alias("doc"), F.coalesce(text_key(text), F.lit(0)).alias("row"), text.alias("text")]
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ranges = max(1, -(-size // (WORD_BYTES * range_windows)))
    dealt = map_batches(docs, keyed, DEALT, _deal(window, ranges))
    answers = dealt.repartitionById(ranges, "range").mapInArrow(_find, ANSWERS)
    met = answers.groupBy("block").agg(F.collect_list(F.struct("gaps", "docs")).alias("answers"))
    found = met.mapInArrow(_by_document, FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [merged(np.frombuffer(b"".join(parts), "<u4"), window) for parts in batch.column(2).to_pylist()]
            lists = [pa.array([s[i] for s in spans], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["doc", "row", "starts", "ends"])

    return found.groupBy("doc", "row").agg(F.collect_list("places").alias("places")).mapInArrow(run, INTERVALS)


def remove_intervals(docs: DataFrame, intervals: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by one space."""
    text = F.col("text").cast("string")
    keyed = docs.select(
        "doc_id", text.alias("text"), id_or_lowest(F.col("doc_id")).alias("doc"), F.coalesce(text_key(text), F.lit(0)).alias("row")
    )
    joined = keyed.join(intervals.hint("shuffle_hash"), ["doc", "row"], "left").select("doc_id", "text", "starts", "ends")

    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, sent, n_words, n_removed, texts = 0, 0, [], [], []
            for n in range(batch.num_rows):
                words = (batch.column(1)[n].as_py() or "").encode().split()
                kept, starts = words, batch.column(2)[n].as_py()
                if starts:
                    kept, before = [], 0
                    for start, end in zip(starts, batch.column(3)[n].as_py(), strict=True):
                        kept += words[before:start]
                        before = end
                    kept += words[before:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept))
                sent += len(texts[-1])
                if sent > SENT_BYTES or n == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, len(texts)), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                        ["doc_id", "n_words", "n_removed", "text"],
                    )
                    first, sent, n_words, n_removed, texts = n + 1, 0, [], [], []

    return joined.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, text string")
