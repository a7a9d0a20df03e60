"""Document fingerprints from prefix polynomial hashes.

``PrefixHashes`` holds, for a text of code points c0 c1 ..., the sums of c_i * B^i
modulo a prime for every prefix, for two primes. Any two spans can be compared in
constant time, also between texts, and the longest common extension from two
places is found by binary search.

A fingerprint is what a bounded string can keep of the array: the hashes of the
prefixes and of the suffixes whose lengths lie on a geometric grid, and for spans
of some code points the least hashes in bins (so text that moved is
still seen). The likeness of two fingerprints is the larger of two estimates: the
common prefix and suffix, each found by binary search on the grid, against the
longer text, and the share of equal bins.

``with_next`` brings each document together with the one after it in descending
doc_id. Documents are range-partitioned once, by bounds computed from the ids; the
largest document of a range is also sent to the range above it, where it follows
the last one. Each range is streamed in order with one row in hand.

Defined results: null is the empty text, and an empty text has a fingerprint. Equal
texts have equal fingerprints, likeness 1. A null doc_id is below all others; rows
of one doc_id follow in the order of their text keys. A single document follows
itself. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from runestone.llm.common import column_of, id_or_lowest, text_key
from runestone.session import settle

# Fixed values of the hashes: primes below 2^31 and bases.
PRIMES = (2147483629, 2147483587)
BASES = (911382323, 972663749)
# Grid lengths per doubling, length of hashed spans, bins.
STEPS = 8
SPAN = 24
BINS = 64
# Code points that are hashed at a time.
BLOCK = 1 << 20
# So many products of a code point and a power add up within 64 bits.
SHORT = 1 << 11
# Bytes of text per range.
RANGE_BYTES = 64 << 20

FINGERPRINTED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


class Powers:
    """B^i modulo a prime, as far as was asked for."""

    def __init__(self, base: int, prime: int):
        self.base, self.prime, self.known = base, np.uint64(prime), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            factor = np.uint64(pow(self.base, len(self.known), int(self.prime)))
            self.known = np.concatenate([self.known, self.known * factor % self.prime])
        return self.known[:n]


_POWERS = tuple(Powers(b, p) for b, p in zip(BASES, PRIMES, strict=True))
_INVERSES = tuple(Powers(pow(b, -1, p), p) for b, p in zip(BASES, PRIMES, strict=True))


def code_points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), "<u4")


def block_prefixes(points: np.ndarray, which: int) -> np.ndarray:
    """Prefix hashes of one block: entry n is the hash of the first n code points."""
    prime = _POWERS[which].prime
    terms = (points.astype(np.uint64) + np.uint64(1)) * _POWERS[which].upto(len(points))
    if len(points) > SHORT:
        terms %= prime
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64) % prime])


class PrefixHashes:
    """Prefix arrays of a whole text: span equality and longest common extensions."""

    def __init__(self, text: str):
        self.points = code_points(text.encode())
        self.sums = [block_prefixes(self.points, k) for k in (0, 1)]

    def __len__(self) -> int:
        return len(self.points)

    def span(self, start: int, length: int) -> tuple[int, ...]:
        """The span's hash times B^start, for both primes."""
        return tuple((int(s[start + length]) - int(s[start])) % p for s, p in zip(self.sums, PRIMES, strict=True))

    def equal(self, start: int, other: PrefixHashes, other_start: int, length: int) -> bool:
        if start + length > len(self) or other_start + length > len(other):
            return False
        mine, theirs = self.span(start, length), other.span(other_start, length)
        shift = other_start - start
        for k, (base, prime) in enumerate(zip(BASES, PRIMES, strict=True)):
            low = (mine[k] * pow(base, max(shift, 0), prime), theirs[k] * pow(base, max(-shift, 0), prime))
            if low[0] % prime != low[1] % prime:
                return False
        return True

    def common_extension(self, start: int, other: PrefixHashes, other_start: int) -> int:
        """The largest length at which the spans from the two places are equal."""
        low, high = 0, min(len(self) - start, len(other) - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(start, other, other_start, middle):
                low = middle
            else:
                high = middle - 1
        return low


# Lengths, ``STEPS`` to a doubling, beyond the length of any text.
_GRID = np.unique(np.floor(2.0 ** (np.arange(40 * STEPS + 1) / STEPS)).astype(np.int64))


def grid(n: int) -> np.ndarray:
    """Lengths 1..n, ``STEPS`` to a doubling."""
    return _GRID[:np.searchsorted(_GRID, n, "right")]


def inverse_powers(exponents: np.ndarray, which: int) -> np.ndarray:
    """B^-e modulo a prime; from a table while the exponents lie within a block."""
    if len(exponents) and exponents.max() >= BLOCK:
        return np.array([pow(BASES[which], -e, PRIMES[which]) for e in exponents.tolist()], np.uint64)
    return _INVERSES[which].upto(int(exponents.max(initial=0)) + 1)[exponents]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Fingerprint:
    """Length, and 32-bit hashes of prefixes, of suffixes, and of the bins (0: none)."""

    def __init__(self, n: int, prefixes: np.ndarray, suffixes: np.ndarray, bins: np.ndarray):
        self.n, self.prefixes, self.suffixes, self.bins = n, prefixes, suffixes, bins

    @classmethod
    def of(cls, points: np.ndarray) -> Fingerprint:
        n = len(points)
        lengths = grid(n)
        wanted = np.unique(np.concatenate([[0, n], lengths, n - lengths]))
        sums = [np.zeros(len(wanted), np.uint64) for _ in (0, 1)]
        least = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
        # Blocks overlap by a span, so that memory is bounded and no span is lost.
        carry, shift = [0, 0], [1, 1]
        for at in range(0, max(n, 1), BLOCK):
            block = points[at:at + BLOCK + SPAN - 1]
            own = min(BLOCK, n - at)
            inside = slice(*np.searchsorted(wanted, [at, at + own + (at + own == n)]))
            spans = None
            for k in (0, 1):
                local, prime = block_prefixes(block, k), PRIMES[k]
                sums[k][inside] = (local[wanted[inside] - at] * np.uint64(shift[k]) + np.uint64(carry[k])) % np.uint64(prime)
                carry[k] = (int(local[own]) * shift[k] + carry[k]) % prime
                shift[k] = shift[k] * pow(BASES[k], own, prime) % prime
                if len(block) >= SPAN and k == 0:
                    # All brought to the power BLOCK - 1, so equal spans have equal hashes anywhere.
                    count = len(block) - SPAN + 1
                    gaps = local[SPAN:] + np.uint64(prime) - local[:-SPAN]
                    spans = _mix(gaps * _POWERS[k].upto(BLOCK)[::-1][:count] % np.uint64(prime))
            if spans is not None:
                which = (spans >> np.uint64(58)).astype(np.int64)
                np.minimum.at(least, which, spans)
        combined = _mix(sums[0] * np.uint64(1 << 31) + sums[1])
        place = np.searchsorted(wanted, lengths)
        # A suffix's hash is that of the span from its start, brought to the power 0.
        whole = np.searchsorted(wanted, n)
        starts = np.searchsorted(wanted, n - lengths)
        suffix = np.zeros(len(lengths), np.uint64)
        for k in (0, 1):
            prime = np.uint64(PRIMES[k])
            gaps = (sums[k][whole] + prime - sums[k][starts]) % prime
            suffix = (suffix << np.uint64(31)) + gaps * inverse_powers(n - lengths, k) % prime
        low = np.uint64(0xFFFFFFFF)
        bins = np.where(least == np.iinfo(np.uint64).max, np.uint64(0), (least & low) | np.uint64(1))
        return cls(n, (combined[place] & low).astype("<u4"), (_mix(suffix) & low).astype("<u4"), bins.astype("<u4"))

    def text(self) -> str:
        return ".".join([str(self.n), *(x.tobytes().hex() for x in (self.prefixes, self.suffixes, self.bins))])

    @classmethod
    def read(cls, text: str) -> Fingerprint:
        n, *parts = text.split(".")
        return cls(int(n), *(np.frombuffer(bytes.fromhex(x), "<u4") for x in parts))

    def likeness(self, other: Fingerprint) -> float:
        if self.n == other.n and all(
            np.array_equal(x, y) for x, y in ((self.prefixes, other.prefixes), (self.suffixes, other.suffixes), (self.bins, other.bins))
        ):
            return 1.0
        lengths = grid(min(self.n, other.n))
        ends = sum(_common(lengths, x, y) for x, y in ((self.prefixes, other.prefixes), (self.suffixes, other.suffixes)))
        longer = max(self.n, other.n)
        held = (self.bins != 0) | (other.bins != 0)
        shared = float(((self.bins == other.bins) & held).sum() / held.sum()) if held.any() else 0.0
        return max(min(ends / longer, 1.0) if longer else 0.0, shared)


def _common(lengths: np.ndarray, x: np.ndarray, y: np.ndarray) -> int:
    """The largest grid length with equal hashes, by binary search: longer ones differ too."""
    low, high = 0, min(len(lengths), len(x), len(y))
    while low < high:
        middle = (low + high + 1) // 2
        if x[middle - 1] == y[middle - 1]:
            low = middle
        else:
            high = middle - 1
    return int(lengths[low - 1]) if low else 0


def likeness(x: str, y: str) -> float:
    """Likeness of two fingerprints, from 0 to 1."""
    return Fingerprint.read(x).likeness(Fingerprint.read(y))


def edited(points: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last half (rounded down) replaced by as many first code points of the next text, or all it has."""
    half = len(points) // 2
    return np.concatenate([points[:len(points) - half], following[:half]])


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows of (range, ghost, doc, row, text), one partition per range, in descending order of doc.

    A ghost is the document that follows a range's last one.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(id_or_lowest(F.col("doc_id")).alias("doc"), text.alias("text"), F.col("doc_id").isNull().alias("null_id"))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = max(1, -(-size // range_bytes), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = keyed.agg(F.percentile_approx("doc", [i / wanted for i in range(1, wanted)] or [0.5], 100 * wanted)).first()[0] or []
    # As many as ranges; the ranges follow the input's size.
    bounds = np.unique(np.array(cuts if wanted > 1 else [], np.int64))

    @F.pandas_udf(LongType())
    def range_of(doc):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(np.searchsorted(bounds, doc.to_numpy(), "left"))

    ids = settle(keyed.select("doc").distinct().withColumn("range", range_of("doc")).groupBy("range").agg(F.max("doc").alias("largest")))
    tops = sorted((r["range"], r["largest"]) for r in ids.collect())  # one row per range
    # The largest document of each range follows the last one of the range above; above the highest comes the lowest.
    above = {largest: tops[(i + 1) % len(tops)][0] for i, (_, largest) in enumerate(tops)}
    spark = docs.sparkSession
    ghosts = spark.createDataFrame([(d, r) for d, r in above.items()], "doc long, range long")
    ranged = keyed.withColumn("range", range_of("doc")).withColumn("ghost", F.lit(0))
    copies = keyed.join(F.broadcast(ghosts), "doc").withColumn("ghost", F.lit(1))
    columns = ["range", "ghost", "doc", "null_id", "text"]
    both = ranged.select(*columns).unionByName(copies.select(*columns)).withColumn("row", text_key(F.col("text")))
    order = ["ghost", F.col("doc").desc(), "row"]
    return both.repartitionById(len(bounds) + 1, F.col("range").cast("int")).sortWithinPartitions(*order)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple | None = None
    out: list[tuple] = []
    for batch in batches:
        for ghost, doc, null_id, text in zip(*(column_of(batch, c) for c in ("ghost", "doc", "null_id", "text")), strict=True):
            points = code_points(text)
            own = Fingerprint.of(points)
            if held is not None:
                out.append(_row(held, points, own))
            held = None if ghost else (None if null_id else doc, points, own)
            if ghost:
                break
        if len(out) >= 1000:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _row(held: tuple, following: np.ndarray, its: Fingerprint) -> tuple:
    doc, points, own = held
    changed = edited(points, following)
    print_ = Fingerprint.of(changed)
    digest = hashlib.sha256(changed.astype("<u4").tobytes().decode("utf-32-le").encode()).hexdigest()
    return doc, len(points), digest, own.text(), print_.text(), own.likeness(print_), own.likeness(its)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in FINGERPRINTED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness to it and to the next one."""
    return with_next(docs).select("ghost", "doc", "null_id", "text").mapInArrow(_fingerprints, FINGERPRINTED)
