"""Best-fit packing of token sequences, large items first.

Documents are tokenized, cut only where they exceed the capacity, and packed into
sequences. Pieces above a third of the capacity share a sequence with at most one
other such piece: the largest is matched with the largest that fits, again and
again. Smaller pieces, by falling length, go where they leave the smallest gap.

Only lengths matter for the plan, and there are at most ``capacity`` of them. So
the plan is made on the counts per length, where "the next 10,000 pieces of length
300 go three each into those 3,334 sequences" is one step; neither the number of
counts nor that of steps grows with the corpus. Each piece then finds its step by
its rank among the pieces of its length. Ranks are counted in slices, so that a
length shared by a third of all pieces is ranked by many tasks.

Defined results: a null text counts as empty, and an empty one still has its end
token. Repeated rows are packed one by one. A null doc_id stays null. An empty
table gives an empty table. Texts of any length are cut, never shortened. Columns
named otherwise are ignored by ``tokenize``; ``pack`` keeps them.
"""

from __future__ import annotations

import bisect
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runestone.llm.common import free_name, map_batches
from runestone.session import settle

CAPACITY = 4096
END_ID = 1
# Words, and pieces of words, whose ids a Python worker remembers, in each of two generations.
REMEMBERED = 100_000
# Bytes of text that are tokenized at a time, and words in one call of the tokenizer.
CHUNK = 1 << 20
WORDS_PER_CALL = 64
# Pieces, and bytes of pieces with their ids, that one task ranks.
SLICE_ROWS = 100_000
SLICE_BYTES = 32 << 20

PIECES = "doc_id long, piece int, start long, length long, ids binary"


# The parts of a tokenizer file for which words can be cut here: fixed values, compared as they stand.
KNOWN_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
KNOWN_SPLIT = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# The same split for texts of these characters: they are in normal form, and their lower-case forms are letters of the class too.
PLAIN = re.compile("[\\t-\\r -~À-ÖØ-öø-įı-ſ]*")
PIECE = re.compile("[a-zß-öø-įı-ſ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s0-9a-zß-öø-įı-ſ]+")


WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it can be printed, else the next from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printed]
    return {b: chr(256 + n) for n, b in enumerate(rest)}


class Remembered:
    """What was asked for lately: two generations of at most ``size`` keys and those of one call."""

    def __init__(self, size: int = REMEMBERED):
        self.size = size
        self.known: dict = {}
        self.older: dict = {}

    def missing(self, keys: set) -> list:
        """The keys that are not known; the others are found in ``known`` afterwards."""
        if len(self.known) > self.size:
            self.known, self.older = {}, self.known
        out = []
        for key in keys:
            if key in self.known:
                continue
            if key in self.older:
                self.known[key] = self.older[key]
            else:
                out.append(key)
        return out


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    For tokenizers that drop white space, where no token reaches over it. Where the file splits texts
    into runs of letters, digits and marks, texts in Latin script are cut into these pieces, and only new
    pieces go to the model. All other texts, and those of other tokenizers, go through the
    whole tokenizer word by word, a word only if it is new.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        special = [(i, t.content) for i, t in added.items() if t.special]
        # A special token between words tells where the ids of the next one start.
        self.mark_id, self.mark = min(special) if special else (None, None)
        self.added = [t.content for t in added.values()]
        parts = json.loads(self.tokenizer.to_str())
        self.splits = parts["normalizer"] == KNOWN_NORMALIZER and parts["pre_tokenizer"] == KNOWN_SPLIT
        self.letters = byte_letters()
        self.words, self.pieces = Remembered(), Remembered()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in encoded]

    def learn_pieces(self, pieces: set[str]) -> None:
        new = self.pieces.missing(pieces)
        known, tokenize = self.pieces.known, self.tokenizer.model.tokenize
        for piece in new:
            letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            known[piece] = array("I", [t.id for t in tokenize(letters)]).tobytes()

    def learn(self, words: set[str]) -> None:
        plain, alone = [], []
        for word in self.words.missing(words):
            (alone if self.mark is None or any(x in word for x in self.added) else plain).append(word)
        known = self.words.known
        for word, ids in zip(alone, self._ids(alone), strict=True):
            known[word] = ids.tobytes()
        calls = [plain[i:i + WORDS_PER_CALL] for i in range(0, len(plain), WORDS_PER_CALL)]
        for call, ids in zip(calls, self._ids([self.mark.join(c) for c in calls] if calls else []), strict=True):
            ends = [*np.flatnonzero(ids == self.mark_id).tolist(), len(ids)]
            start, raw = 0, ids.tobytes()
            for word, end in zip(call, ends, strict=True):
                known[word] = raw[4 * start:4 * end]
                start = end + 1

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, a chunk of texts at a time."""
        chunk, size = [], 0
        for text in texts:
            if self.splits and PLAIN.fullmatch(text) and not any(x in text for x in self.added):
                chunk.append((True, PIECE.findall(text.lower())))
            else:
                chunk.append((False, WORD.findall(text)))
            size += len(text)
            if size >= CHUNK:
                yield from self._encoded(chunk)
                chunk, size = [], 0
        if chunk:
            yield from self._encoded(chunk)

    def _encoded(self, chunk: list[tuple[bool, list[str]]]) -> Iterator[bytes]:
        self.learn_pieces(set().union(*(parts for plain, parts in chunk if plain)))
        self.learn(set().union(*(parts for plain, parts in chunk if not plain)))
        for plain, parts in chunk:
            yield b"".join(map((self.pieces if plain else self.words).known.__getitem__, parts))


_ENCODERS: dict[str, WordEncoder] = {}


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids (little-endian uint32).

    ``path`` names a tokenizer file that every executor can read.
    """
    if capacity < 1:
        raise ValueError("the capacity is at least 1")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = WordEncoder(path)
        encoder = _ENCODERS[path]
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            out: list[tuple] = []
            size = 0
            for key, ids in zip(keys, encoder.encode(texts[n].as_py() or "" for n in range(len(texts))), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    out.append((key, piece, at // 4, len(part) // 4, part))
                    size += len(part)
                if size > 4 * CHUNK:
                    yield _pieces(out)
                    out, size = [], 0
            if out:
                yield _pieces(out)

    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")], PIECES, run)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids"]
    )


class Plan:
    """Steps of a packing: (length, first rank, pieces, pieces per sequence, first sequence, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.steps: list[tuple[int, int, int, int, int, int]] = []
        self.used = dict.fromkeys(counts, 0)
        # Sequences by gap: runs (first sequence, how many); and the gaps that occur, in order.
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.sizes: list[int] = []
        self._match({n: c for n, c in counts.items() if 3 * n > capacity})
        for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
            self._fit(length, counts[length])

    def _place(self, length: int, pieces: int, per: int, first: int, offset: int) -> None:
        self.steps.append((length, self.used[length], pieces, per, first, offset))
        self.used[length] += pieces

    def _open(self, sequences: int) -> int:
        self.sequences += sequences
        return self.sequences - sequences

    def _leave(self, gap: int, first: int, sequences: int) -> None:
        if gap:
            if gap not in self.gaps:
                self.gaps[gap] = []
                bisect.insort(self.sizes, gap)
            self.gaps[gap].append((first, sequences))

    def _match(self, left: dict[int, int]) -> None:
        lengths = sorted(left)
        while lengths:
            largest = lengths[-1]
            if not left[largest]:
                lengths.pop()
                continue
            # The largest that fits beside it: of its own length only if two are left.
            at = bisect.bisect_right(lengths, self.capacity - largest) - 1
            while at >= 0 and left[lengths[at]] < (2 if lengths[at] == largest else 1):
                at -= 1
            if at < 0:
                n = left[largest]
                first = self._open(n)
                self._place(largest, n, 1, first, 0)
                self._leave(self.capacity - largest, first, n)
                left[largest] = 0
                continue
            other = lengths[at]
            n = left[largest] // 2 if other == largest else min(left[largest], left[other])
            first = self._open(n)
            if other == largest:
                self._place(largest, 2 * n, 2, first, 0)
                left[largest] -= 2 * n
            else:
                self._place(largest, n, 1, first, 0)
                self._place(other, n, 1, first, largest)
                left[largest] -= n
                left[other] -= n
                if not left[other]:
                    lengths.pop(at)
            self._leave(self.capacity - largest - other, first, n)

    def _fit(self, length: int, n: int) -> None:
        while n:
            at = bisect.bisect_left(self.sizes, length)
            if at == len(self.sizes):
                gap, per = self.capacity, self.capacity // length
                first, sequences = self._open(-(-n // per)), -(-n // per)
            else:
                gap = self.sizes[at]
                per = gap // length
                first, sequences = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap]
                    self.sizes.pop(at)
            full = min(sequences, n // per)
            if full:
                self._place(length, full * per, per, first, self.capacity - gap)
                self._leave(gap - per * length, first, full)
                n -= full * per
                first, sequences = first + full, sequences - full
            if n and sequences and n < per:
                self._place(length, n, n, first, self.capacity - gap)
                self._leave(gap - n * length, first, 1)
                first, sequences, n = first + 1, sequences - 1, 0
            if sequences:
                self._leave(gap, first, sequences)

    def table(self) -> tuple[np.ndarray, ...]:
        """Steps sorted by (length, first rank), as arrays."""
        steps = np.array(sorted(self.steps), np.int64).reshape(-1, 6)
        return tuple(steps[:, i].copy() for i in range(6))


def _places(lengths: np.ndarray, ranks: np.ndarray, table: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by length and rank."""
    step_length, first_rank, _, per, sequence, offset = table
    # Ranks restart with each length: a step's key is the rank within all pieces, by length.
    low = np.searchsorted(step_length, lengths, "left")
    high = np.searchsorted(step_length, lengths, "right")
    while True:  # all binary searches at once
        open_ = high - low > 1
        if not open_.any():
            break
        middle = (low + high) // 2
        right = open_ & (first_rank[np.minimum(middle, len(first_rank) - 1)] <= ranks)
        low = np.where(right, middle, low)
        high = np.where(open_ & ~right, middle, high)
    inside = ranks - first_rank[low]
    return sequence[low] + inside // per[low], offset[low] + inside % per[low] * lengths


def pack(pieces: DataFrame, capacity: int = CAPACITY, slice_rows: int = SLICE_ROWS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``pieces`` (with a column ``length``) and the sequence and offset of each.

    A length outside 1..capacity raises ``ValueError``. Columns ``sequence_id`` and
    ``offset`` of the input are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    columns = pieces.columns
    salt, rank, place, earlier = (free_name(pieces, x) for x in ("_salt", "_rank", "_slice", "_earlier"))
    # Written once: the salt is then a column as any other, and no text is tokenized twice.
    pieces = settle(pieces.withColumn(salt, F.rand(7)))
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError("lengths are from 1 to the capacity")
    plan = pieces.sparkSession.sparkContext.broadcast(Plan(counts, capacity).table())
    # Long pieces bring their ids along, so fewer of them make a slice. At most ``capacity`` lengths have more than one.
    row_bytes = lambda n: 64 + (4 * n if "ids" in columns else 0)
    slices = {n: max(-(-c // slice_rows), -(-c * row_bytes(n) // slice_bytes)) for n, c in counts.items()}
    many = [(n, s) for n, s in slices.items() if s > 1]
    width = free_name(pieces, "_slices")
    sliced = pieces
    if many:
        named = pieces.sparkSession.createDataFrame(many, f"length {dict(pieces.dtypes)['length']}, {width} long")
        sliced = sliced.join(F.broadcast(named), "length", "left")
    share = F.coalesce(width, F.lit(1)) if many else F.lit(1)
    sliced = sliced.withColumn(place, F.floor(F.col(salt) * share).cast("int"))
    group = [F.col("length"), F.col(place)]
    before = Window.partitionBy("length").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(*group).agg(F.count(F.lit(1)).alias(rank))
        .select("length", place, F.coalesce(F.sum(rank).over(before), F.lit(0)).alias(earlier))
    )
    inside = Window.partitionBy(*group).orderBy(salt)
    ranked = (
        sliced.join(starts, ["length", place])
        .withColumn(rank, F.col(earlier) + F.row_number().over(inside) - 1)
        .select(*columns, rank)
    )

    # Only two numbers of a piece go to Python; its ids stay where they are.
    @F.pandas_udf("sequence_id long, offset long")
    def place_of(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = _places(lengths.to_numpy("int64"), ranks.to_numpy("int64"), plan.value)
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    found = free_name(pieces, "_found")
    placed = ranked.withColumn(found, place_of.asNondeterministic()(F.col("length").cast("long"), F.col(rank).cast("long")))
    return placed.select(*columns, F.col(found)["sequence_id"].alias("sequence_id"), F.col(found)["offset"].alias("offset"))


def assemble(packed: DataFrame) -> DataFrame:
    """The ids of every sequence: at most ``capacity`` of them come together."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda ids, part: F.concat(ids, part["ids"])).alias("ids")
    )


