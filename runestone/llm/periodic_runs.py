"""Periodic run detection by online dyadic square catching.

A *square* is a stretch of words that stands twice in a row; squares of one period
that overlap form a *run*, the longest stretch in which words that far apart are
equal. ``SquareCatcher`` finds the squares of a growing sequence:

* When a block of B words (B a power of two, its start a multiple of B) is complete,
  a catcher stands over it. It watches the periods 2B - 1 ... 4B - 2, so each period
  has one size of block, and the first half of any square of such a period holds a
  whole block of that size.
* Each appended word completes one stretch of every power-of-two length. Two catchers
  of that length watch the distance at which it ends; the stretch is compared with
  their blocks (by a number of 64 bits first, by its words if that agrees).
* A caught block is compared on to the left, and to the right as words arrive. A
  square is reported once as many words agree as its period has, and each further word
  that agrees makes its run longer. Stretches inside a known run whose period
  divides theirs are repetitions of that run, and are not looked at again.

Words may be appended one by one or thousands at a time: a call does the steps of its
words side by side. A word costs a step per length; numbers of stretches are kept only as
far back as a catcher can be. Many documents can be one sequence, with a number between
them that occurs nowhere else.

Defined results: a null or empty text, or one of white space, has no words and no runs.
A null doc_id has no digest, so its text is left as it is. Rows are judged one by one, so
repeated rows give repeated results. Texts of any length are read whole. An empty table gives
an empty table. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runestone.llm.common import column_of, map_batches

# A run is kept from this many words and this many periods on.
LEAST_WORDS = 6
LEAST_PERIODS = 4
# Words of short documents that are one sequence, and words appended at a time.
SEQUENCE_WORDS = 1 << 15
APPENDED = 1 << 16

RUNS = (
    "n_words long, n_runs long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"
)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits, so that numbers of stretches follow no linear rule."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class _Growing:
    """Numbers appended at the end; those before ``first`` may be forgotten."""

    def __init__(self, kind: type):
        self.first, self.end = 0, 0
        self.held = np.zeros(64, kind)

    def append(self, values: np.ndarray) -> None:
        used, more = self.end - self.first, len(values)
        if used + more > len(self.held):
            grown = np.zeros(max(2 * len(self.held), used + more), self.held.dtype)
            grown[:used] = self.held[:used]
            self.held = grown
        self.held[used:used + more] = values
        self.end += more

    def span(self, start: int, end: int) -> np.ndarray:
        return self.held[start - self.first:end - self.first]

    def forget(self, before: int) -> None:
        """Room is given back when it is more than what stays."""
        if before - self.first > self.end - before + 1024:
            self.held = self.span(before, self.end).copy()
            self.first = before


class SquareCatcher:
    """The maximal runs of a growing sequence of numbers: periods up to ``max_period``, each ``least_periods`` times at least."""

    def __init__(self, max_period: int, least_periods: int = 2):
        if least_periods < 2:
            raise ValueError("a run repeats its period once at least")
        self.max_period, self.least_periods = max_period, least_periods
        self.words = _Growing(np.int64)
        self.stretches: list[_Growing] = []
        # By (start, period): the end, for runs and for agreeing stretches not yet a square.
        self.found: dict[tuple[int, int], int] = {}
        self.open: set[tuple[int, int]] = set()
        # By period: the last stretch that was compared.
        self.last: dict[int, tuple[int, int]] = {}

    def append(self, numbers: np.ndarray) -> None:
        if not len(numbers):
            return
        self.words.append(np.asarray(numbers, np.int64))
        for key in list(self.open):
            start, period = key
            end = self._agree_right(self.found[key] - period, self.found[key])
            self._put(start, period, end)
        level, size = 0, 1
        while 2 * size - 1 <= self.max_period and self.words.end >= size:
            if level == len(self.stretches):
                self.stretches.append(_Growing(np.uint64))
            fresh = self._number(level, size)
            if self.words.end >= 3 * size - 1:
                self._catch(level, size, fresh)
            level, size = level + 1, 2 * size
        for n, kept in enumerate(self.stretches):  # catchers reach back this far, and the next length needs the last ones
            kept.forget(max(kept.first, kept.end - (5 << n)))

    def _number(self, level: int, size: int) -> int:
        """Numbers of the stretches of ``size`` words that are complete now; returns the first new start."""
        mine, done = self.stretches[level], self.words.end - size + 1
        start = mine.end
        if level == 0:
            mine.append(_mixed(self.words.span(start, done).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
        else:
            below, half = self.stretches[level - 1], size // 2
            left, right = below.span(start, done), below.span(start + half, done + half)
            mine.append(_mixed(left * np.uint64(0xD6E8FEB86659FD93) + right))
        return start

    def _catch(self, level: int, size: int, fresh: int) -> None:
        """The new stretches against the blocks of the two catchers that watch their distance."""
        kept = self.stretches[level]
        fresh = max(fresh, 2 * size - 1)
        if fresh >= kept.end:
            return
        starts = np.arange(fresh, kept.end)
        blocks = (starts - (2 * size - 1)) // size * size
        own = kept.span(fresh, kept.end)
        hits = []
        for block in (blocks, blocks - size):
            # Before the first block the index is of another stretch; its distance is checked below.
            same = np.flatnonzero(kept.held[np.maximum(block - kept.first, 0)] == own)
            if len(same):
                at, to = block[same], starts[same]
                hits.append(np.stack([to - at, at])[:, (at >= 0) & (to - at <= self.max_period)])
        if not hits:
            return
        periods, at = np.concatenate(hits, axis=1)
        unknown = ~self._repeats(periods, at, size)
        periods, at = periods[unknown], at[unknown]
        if not len(at):
            return
        order = np.lexsort((at, periods))
        periods, at = periods[order], at[order]
        # Neighbouring blocks at one distance agree as one stretch.
        chained = np.r_[False, (np.diff(periods) == 0) & (np.diff(at) == size)]
        firsts = np.flatnonzero(~chained)
        afters = np.r_[firsts[1:], len(at)]
        # So many whole blocks lie in a run, without its last period; fewer are enough only where the next is still to come.
        whole = max(1, ((self.least_periods - 1) * (2 * size - 1) - (size - 1)) // size)
        worth = (afters - firsts >= whole) | (at[afters - 1] + periods[firsts] + 2 * size > self.words.end)
        for first, after in zip(firsts[worth].tolist(), afters[worth].tolist(), strict=True):
            period, last = int(periods[first]), int(at[after - 1])
            n = first
            while n < after:
                reached = self._compare(period, int(at[n]), size)
                if reached >= last + size + period:
                    break
                # Numbers that agreed by chance: go on behind the words that do.
                n += 1
                while n < after and at[n] + size + period <= reached:
                    n += 1

    def _repeats(self, periods: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """True where a known run holds the stretch and its period divides this one's."""
        known = self._smallest(2)
        if not known or not len(at):
            return np.zeros(len(at), bool)
        starts, ends, own = np.array(known, np.int64).T
        # The run that reaches furthest, of those that start up to here.
        widest = np.maximum.accumulate(ends)
        owner = np.maximum.accumulate(np.where(ends > np.r_[-1, widest[:-1]], np.arange(len(ends)), 0))
        before = np.searchsorted(starts, at, "right") - 1
        mine = owner[np.maximum(before, 0)]
        return (before >= 0) & (ends[mine] >= at + periods + size) & (periods % own[mine] == 0)

    def _compare(self, period: int, at: int, size: int) -> int:
        """Compare a caught block; returns where its agreement ends."""
        start, end = self.last.get(period, (0, 0))
        if start <= at and at + period + size <= end:
            return end
        words = self.words
        if not np.array_equal(words.span(at, at + size), words.span(at + period, at + period + size)):
            return at + period
        left = self._agree_left(at, at + period)
        self._put(left, period, self._agree_right(at + size, at + period + size))
        return self.last[period][1]

    def _put(self, start: int, period: int, end: int) -> None:
        self.last[period] = (start, end)
        key = (start, period)
        if end == self.words.end:  # the next word may agree too
            self.open.add(key)
            self.found[key] = end
            return
        self.open.discard(key)
        if end - start >= 2 * period:
            self.found[key] = end
        else:
            self.found.pop(key, None)

    def _agree_right(self, left: int, right: int) -> int:
        """End of the agreement of the words from ``left`` and from ``right`` on."""
        step = 8
        while right < self.words.end:
            step = min(2 * step, self.words.end - right)
            differ = np.flatnonzero(self.words.span(left, left + step) != self.words.span(right, right + step))
            if len(differ):
                return right + int(differ[0])
            left, right = left + step, right + step
        return right

    def _agree_left(self, left: int, right: int) -> int:
        """First of the words before ``left`` that agree with those before ``right``."""
        step = 8
        while left > 0:
            step = min(2 * step, left)
            differ = np.flatnonzero(self.words.span(left - step, left) != self.words.span(right - step, right))
            if len(differ):
                return left - step + int(differ[-1]) + 1
            left, right = left - step, right - step
        return left

    def _smallest(self, times: int) -> list[tuple[int, int, int]]:
        """(start, end, smallest period) of the runs that hold a period so many times, in this order."""
        smallest: dict[tuple[int, int], int] = {}
        for (start, period), end in self.found.items():
            if end - start >= times * period:
                smallest[start, end] = min(period, smallest.get((start, end), period))
        return sorted((start, end, period) for (start, end), period in smallest.items())

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, smallest period) of every run so far, in this order."""
        return [(start, end - start, period) for start, end, period in self._smallest(self.least_periods)]


def runs_of(sequences: list[list[bytes]], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> Iterator[list[tuple[int, int, int]]]:
    """Per sequence of words: (start, length, period) of its runs of at least so many words and periods."""
    def caught(group: list[list[bytes]]) -> Iterator[list[tuple[int, int, int]]]:
        ids: defaultdict[bytes, int] = defaultdict(count().__next__)
        numbers, starts = [], []
        for n, words in enumerate(group):
            starts.append(len(numbers))
            numbers += map(ids.__getitem__, words)
            numbers.append(-1 - n)  # occurs nowhere else, so no run reaches over it
        catcher = SquareCatcher(max(map(len, group)) // least_periods, least_periods)
        every = np.array(numbers, np.int64)
        for at in range(0, len(every), APPENDED):
            catcher.append(every[at:at + APPENDED])
        found: list[list[tuple[int, int, int]]] = [[] for _ in group]
        long_enough = [r for r in catcher.runs() if r[1] >= least_words]
        owners = np.searchsorted(starts, [r[0] for r in long_enough], "right") - 1
        for owner, (start, length, period) in zip(owners.tolist(), long_enough, strict=True):
            found[owner].append((start - starts[owner], length, period))
        yield from found

    group, size = [], 0
    for words in sequences:
        if len(words) >= SEQUENCE_WORDS and group:
            yield from caught(group)
            group, size = [], 0
        group.append(words)
        size += len(words)
        if size >= SEQUENCE_WORDS:
            yield from caught(group)
            group, size = [], 0
    if group:
        yield from caught(group)


def collapsed(words: list[bytes], runs: Iterable[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats after its first period."""
    runs = list(runs)
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def strongest(runs: Iterable[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run that repeats its period most often; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def repeating(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """In a tenth of the documents, told by the id's digest, the words from one on repeat with a period."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * -(-(n - a) // p))[:n - a]


def _batches(batches: Iterator[pa.RecordBatch], edited: bool) -> Iterator[tuple[pa.Array, list[list[bytes]], list[list[tuple[int, int, int]]]]]:
    for batch in batches:
        sequences = [(t or b"").split() for t in column_of(batch, "text")]
        if edited:
            sequences = [repeating(w, d) for w, d in zip(sequences, batch.column(0).to_pylist(), strict=True)]
        yield batch.column(0), sequences, list(runs_of(sequences))


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_runs, starts, lengths and periods of the runs, and the text without their repetitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sequences, found in _batches(batches, edited=False):
            lists = [pa.array([[r[i] for r in runs] for runs in found], pa.list_(pa.int64())) for i in range(3)]
            texts = pa.array([b" ".join(collapsed(w, r)) for w, r in zip(sequences, found, strict=True)], pa.binary()).cast(pa.string())
            counts = [pa.array(list(map(len, x)), pa.int64()) for x in (sequences, found)]
            yield pa.RecordBatch.from_arrays([ids, *counts, *lists, texts], ["doc_id", "n_words", "n_runs", "starts", "lengths", "periods", "collapsed"])

    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")], f"doc_id long, {RUNS}", run)


DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def digest_runs(docs: DataFrame) -> DataFrame:
    """Runs of the texts, of which a tenth are made to repeat, as counts, the strongest run and digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sequences, found in _batches(batches, edited=True):
            rows = []
            for words, runs in zip(sequences, found, strict=True):
                best = strongest(runs)
                lines = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(runs, key=lambda r: (r[0], r[2])))
                rows.append((
                    len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                    hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
                ))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([ids, *columns], [x.split()[0] for x in DIGEST.split(", ")])

    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")], DIGEST, run)
