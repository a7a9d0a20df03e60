"""Buckets of hashed words and character 3-grams, as Spark ML's ``HashingTF`` has them, for many strings at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEED = 42
# Characters as triples of numbers: up to this many triples are looked up in a table of all of them.
TABLE = 1 << 22


def _mixed(k: np.ndarray) -> np.ndarray:
    k = k * np.uint32(0xCC9E2D51)
    return ((k << np.uint32(15)) | (k >> np.uint32(17))) * np.uint32(0x1B873593)


def murmur3(strings: pa.Array) -> np.ndarray:
    """The 32-bit Murmur3 hash of the UTF-8 bytes of each string, signed."""
    strings = strings.cast(pa.string())
    n = len(strings)
    if not n:
        return np.zeros(0, np.int32)
    _, ends, data = strings.buffers()
    ends = np.frombuffer(ends, np.int32)[strings.offset:strings.offset + n + 1].astype(np.int64)
    # Three bytes more, so that the last word can be read whole.
    data = np.concatenate([np.frombuffer(data, np.uint8)[:ends[-1]] if data else np.zeros(0, np.uint8), np.zeros(3, np.uint8)])
    starts, lengths = ends[:-1], np.diff(ends)
    hashes = np.full(n, SEED, np.uint32)

    def word(at: np.ndarray) -> np.ndarray:
        return sum(data[at + i].astype(np.uint32) << np.uint32(8 * i) for i in range(4))

    active, at = np.flatnonzero(lengths >= 4), 0
    while len(active):
        h = hashes[active] ^ _mixed(word(starts[active] + 4 * at))
        hashes[active] = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64)
        at += 1
        active = active[lengths[active] >= 4 * at + 4]
    rest = lengths % 4
    tail = word(np.minimum(starts + lengths - rest, len(data) - 4 if len(data) > 3 else 0)) if len(data) > 3 else np.zeros(n, np.uint32)
    tail = np.where(rest > 0, tail & ((np.uint32(1) << (8 * rest).astype(np.uint32)) - np.uint32(1)), np.uint32(0))
    hashes ^= _mixed(tail)
    hashes ^= lengths.astype(np.uint32)
    hashes = (hashes ^ (hashes >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    hashes = (hashes ^ (hashes >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (hashes ^ (hashes >> np.uint32(16))).view(np.int32)


def buckets(strings: pa.Array, size: int) -> np.ndarray:
    """The place of each string in a hashed vector of ``size``."""
    return murmur3(strings).astype(np.int64) % size


def gram_buckets(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of every 3-gram of the texts' characters, and how many of them each text has.

    A gram is hashed as ``NGram`` writes it, with blanks between its characters. Each different one is hashed once.
    """
    lengths = np.array([len(t or "") for t in texts], np.int64)
    codes = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le"), "<u4")
    grams = np.maximum(lengths - 2, 0)
    if not grams.sum():
        return np.zeros(0, np.int64), grams
    # Where a gram begins: everywhere but at the last two characters of a text.
    begins = np.ones(len(codes), bool)
    ends = np.cumsum(lengths)
    begins[ends[lengths > 0] - 1] = False
    begins[ends[lengths > 1] - 2] = False
    begins = np.flatnonzero(begins)
    alphabet = np.flatnonzero(np.bincount(codes))
    number = np.zeros(int(alphabet[-1]) + 1, np.int64)
    number[alphabet] = np.arange(len(alphabet))
    chars, n = number[codes], len(alphabet)
    triples = (chars[begins] * n + chars[begins + 1]) * n + chars[begins + 2]
    if n ** 3 <= TABLE:
        place = np.zeros(n ** 3, np.int32)
        place[triples] = 1
        found = np.flatnonzero(place)
        at = triples
    else:
        found, at = np.unique(triples, return_inverse=True)
        place = np.empty(len(found), np.int32)
    spelled = np.full((len(found), 5), ord(" "), "<u4")
    for i, digit in enumerate((found // (n * n), found // n % n, found % n)):
        spelled[:, 2 * i] = alphabet[digit]
    written = spelled.tobytes().decode("utf-32-le")
    hashed = buckets(pa.array([written[i:i + 5] for i in range(0, len(written), 5)], pa.string()), size)
    if at is triples:
        place[found] = hashed
    else:
        place[:] = hashed
    return place[at], grams
