"""Near-duplicate documents by one-permutation MinHash.

1. Every text becomes the set of its word shingles, hashed once each. The hash's
   upper part gives a bin, and the least lower part in a bin is its value. An empty
   bin borrows from the first full bin in a random order of its own (optimal
   densification), the same order for every document.
2. Equal sets are one class; only classes go on. Classes are numbered in the order of their
   smallest doc_id, which two of them share where a doc_id has several texts.
3. Bands of bins are bucket keys. A bucket of n classes gives a star of n - 1
   candidate edges, not all pairs.
4. Candidates are confirmed on the full sets, and components found. A star can
   miss a link between two classes that are both unlike its centre, so buckets
   that still hold more than one component get more stars, around other
   centres; what is left after that is compared across components of a bucket,
   each class of the smaller components with the others. So every pair of a bucket
   is either in one component or has been compared, with no cap on anything.

What is compared are sizes and bit maps of the sets first, inside the join, which cannot
reject a pair that is alike; only the rest meet with their full sets. The last step is the
only one whose comparisons can grow with the square of a group: by the classes that no
star could place, times their buckets.

With 32 bands of 5 bins a pair at a similarity of 0.8 shares no bucket with a
probability of 0.0000031, at 0.85 of 0.00000001.

Defined results: a text without words, or null, has an empty set and is linked with
nothing. Fewer words than a shingle are one shingle. A row without doc_id is
linked with nothing and kept, its component null. Repeated rows are of one class;
rows that share a doc_id but not a text are judged by their own texts. An empty table gives an
empty table. Columns other than doc_id and text are ignored, and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runestone.llm.common import column_of, free_name, map_batches, text_key
from runestone.llm.graph import components
from runestone.llm.substring import WordHashes, window_hashes
from runestone.operators.scaling import join_dimension
from runestone.session import settle

SHINGLE = 5
SIMILARITY = 80  # percent
BANDS = 32
BAND_BINS = 5
STARS = 2
# Longs in the bit map of a set.
MAP_LONGS = 64

_BASE = np.uint64(0x9FB21C651E98DF25)
_HASHES = WordHashes()

SKETCHES = "doc long, row long, n long, d1 long, d2 long, bands array<long>, bits array<long>"


def shingle_set(text: bytes | None, size: int, hashes: WordHashes = _HASHES) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    # A sequence shorter than a shingle must not look like a shingle of another length.
    return np.unique(window_hashes(hashes.of(words), min(size, len(words)), _BASE) + np.uint64(min(size, len(words))))


def bit_map(hashes: np.ndarray) -> np.ndarray:
    """A bit for each hash, as ``MAP_LONGS`` longs."""
    bits = np.zeros(64 * MAP_LONGS, bool)
    bits[hashes & np.uint64(64 * MAP_LONGS - 1)] = True
    return np.packbits(bits, bitorder="little").view(np.int64)


def may_be_alike(similarity: int, x: str, y: str) -> Column:
    """Necessary for sets with sizes ``n_x``, ``n_y`` and maps ``bits_x``, ``bits_y`` to be alike enough.

    Sizes bound the similarity, and so do the bits that differ: an element of only one set
    changes at most one bit, and sets of a similarity s differ in at most
    (1 - s) / (1 + s) of their elements together.
    """
    n_x, n_y, bits_x, bits_y = (F.col(f"{c}_{s}") for c in ("n", "bits") for s in (x, y))
    differ = F.bit_count(F.get(bits_x, F.lit(0)).bitwiseXOR(F.get(bits_y, F.lit(0))))
    for i in range(1, MAP_LONGS):
        differ = differ + F.bit_count(F.get(bits_x, F.lit(i)).bitwiseXOR(F.get(bits_y, F.lit(i))))
    return (100 * F.least(n_x, n_y) >= similarity * F.greatest(n_x, n_y)) & (
        (100 + similarity) * differ <= (100 - similarity) * (n_x + n_y))


class Sketcher:
    """Band keys of shingle sets; the same for every document and worker."""

    def __init__(self, bands: int, bins: int):
        rng = np.random.default_rng(20240229)
        self.bands, self.bins, self.size = bands, bins, bands * bins
        self.orders = np.argsort(rng.random((self.size, self.size)), axis=1)
        self.factors = rng.integers(0, 1 << 63, (bands, bins), np.uint64) * np.uint64(2) + np.uint64(1)
        self.salts = rng.integers(0, 1 << 63, bands, np.uint64)

    def bin_values(self, hashes: np.ndarray) -> np.ndarray:
        # The set is sorted, so the hashes of a bin are neighbours.
        at = ((hashes >> np.uint64(32)) * np.uint64(self.size) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        values, full = np.zeros(self.size, np.uint64), np.zeros(self.size, bool)
        values[at[first]] = np.minimum.reduceat(hashes & np.uint64(0xFFFFFFFF), first)
        full[at[first]] = True
        empty = np.flatnonzero(~full)
        if len(empty):
            orders = self.orders[empty]
            values[empty] = values[orders[np.arange(len(empty)), full[orders].argmax(axis=1)]]
        return values

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        values = self.bin_values(hashes).reshape(self.bands, self.bins)
        mixed = ((values + np.uint64(1)) * self.factors).sum(axis=1, dtype=np.uint64) + self.salts
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def sketches(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, bins: int = BAND_BINS) -> DataFrame:
    """Per row: set size, 128-bit digest of the set, band keys (none for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The words' hashes are forgotten with the task: the next stage's worker is the same process.
        sketcher, known = Sketcher(bands, bins), WordHashes()
        for batch in batches:
            sizes, digests, keys, ends, maps = [], [], [], [0], []
            for text in column_of(batch, "text"):
                hashes = shingle_set(text, shingle, known)
                sizes.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                if len(hashes):
                    keys.append(sketcher.keys(hashes))
                ends.append(ends[-1] + bands * bool(len(hashes)))
                maps.append(bit_map(hashes))
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(maps) + 1) * MAP_LONGS, pa.int32()), pa.array(np.concatenate(maps)))],
                ["doc", "row", "n", "d1", "d2", "bands", "bits"],
            )

    text = F.col("text").cast("string")
    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc"), F.coalesce(text_key(text), F.lit(0)).alias("row"), text.alias("text")], SKETCHES, run)


def _sets(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, set) of the rows that ``nodes`` (node, doc, row) names; the texts stay where they are while the names are few enough to be broadcast."""
    text = F.col("text").cast("string")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce(text_key(text), F.lit(0)).alias("row"), text.alias("text"))
    wanted = join_dimension(keyed, nodes, ["doc", "row"], "inner", salt_by="row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(text, shingle, known).tobytes() for text in column_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("node")), pa.array(sets, pa.binary())], ["node", "set"])

    return wanted.select("node", "text").mapInArrow(run, "node long, set binary")


def _confirm(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    left, right = (
        classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in ("a", "b")
    )
    first = pairs.join(left, "a").withColumnRenamed("b", "_b")
    possible = settle(first.join(right, (F.col("_b") == F.col("b")) & may_be_alike(similarity, "a", "b")).select("a", "b"))
    named = possible.select(F.col("a").alias("node")).union(possible.select(F.col("b").alias("node"))).distinct()
    sets = settle(_sets(docs, named.join(classes.select("node", "doc", "row"), "node"), shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                alike.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(alike, pa.bool_()))

    with_sets = possible.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a"
    )
    return settle(with_sets.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long"))


def _pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, bands: int = BANDS, bins: int = BAND_BINS, stars: int = STARS
) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_shingles, component_id and kept (one of each component)."""
    every = settle(sketches(docs, shingle, bands, bins))
    linkable = every.filter("n > 0 AND doc IS NOT NULL")
    first = settle(linkable.groupBy("d1", "d2").agg(F.min("doc").alias("first")))
    named = settle(first.orderBy("first", "d1", "d2").withColumn("node", F.monotonically_increasing_id()))
    # One row stands for a class: the first of the smallest doc_id.
    classes = settle(
        linkable.join(named, ["d1", "d2"]).filter("doc = first")
        .groupBy("node").agg(F.min(F.struct("row", "doc", "n", "bands", "bits")).alias("_one"))
        .select("node", "_one.doc", "_one.row", "_one.n", "_one.bands", "_one.bits")
    )
    keys = classes.select(F.explode("bands").alias("band"), "node")
    shared = keys.groupBy("band").agg(F.count(F.lit(1)).alias("_n"), F.min("node").alias("center")).filter("_n > 1")
    members = settle(keys.join(shared.select("band", "center"), "band"))
    tested = settle(members.filter("node <> center").select(*_pair(F.col("node"), F.col("center"))).distinct())
    links = _confirm(tested, docs, classes, shingle, similarity)
    labels = components(links)
    for star in range(stars + 1):
        mixed = _mixed(members, labels)
        if mixed.isEmpty():
            break
        more = _another_star(mixed, star) if star < stars else _across(mixed, classes, similarity)
        fresh = settle(more.select(*_pair(F.col("node"), F.col("center"))).distinct().join(tested, ["a", "b"], "left_anti"))
        found = _confirm(fresh, docs, classes, shingle, similarity)
        tested = tested.unionByName(fresh)
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(links)
    # The smallest number of a component is that of its smallest doc_id.
    lowest = labels.join(named.select(F.col("node").alias("component"), F.col("first").alias("_lowest")), "component").select("node", "_lowest")
    of_class = named.join(lowest, "node", "left").select("d1", "d2", F.coalesce("_lowest", "first").alias("component"))
    joined = every.join(of_class, ["d1", "d2"], "left").withColumn("component", F.when(F.col("n") > 0, F.col("component")))
    component = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    return joined.select(
        F.col("doc").alias("doc_id"), F.col("row").alias("text_key"), F.col("n").alias("n_shingles"),
        component.alias("component_id"), F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"),
    )


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their components, of the buckets that hold more than one component."""
    labelled = members.select("band", "node").join(labels, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("component")
    )
    mixed = labelled.groupBy("band").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).filter("_low < _high")
    return settle(labelled.join(mixed.select("band"), "band"))


def _another_star(mixed: DataFrame, star: int) -> DataFrame:
    """(node, center): a centre for each bucket, picked by a hash, with the classes of other components.

    Buckets of one family pick different centres, so a class meets as many of them as it shares buckets.
    """
    draw = F.xxhash64("node", "band", F.lit(star))
    chosen = mixed.groupBy("band").agg(F.min(draw).alias("_draw"))
    centers = mixed.withColumn("_draw", draw).join(chosen, ["band", "_draw"]).select(
        "band", F.col("node").alias("center"), F.col("component").alias("_of")
    )
    return mixed.join(centers, "band").filter("component <> _of").select("node", "center")


def _across(mixed: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    """(node, center): the largest component of a bucket is compared with, the classes of the others compare.

    Only pairs that may be alike by their sizes and bit maps come out of the join.
    """
    sizes = mixed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.groupBy("band").agg(F.max_by("component", F.struct("_n", "component")).alias("_most"))
    keyed = mixed.join(classes.select("node", F.col("n").alias("n_x"), F.col("bits").alias("bits_x")), "node").join(largest, "band")
    keyed = settle(keyed)
    few = keyed.filter("component <> _most").select(
        F.col("band").alias("_band"), F.col("node").alias("center"), F.col("component").alias("_of"),
        F.col("n_x").alias("n_y"), F.col("bits_x").alias("bits_y"),
    )
    across = (F.col("band") == F.col("_band")) & (F.col("component") != F.col("_of")) & may_be_alike(similarity, "x", "y")
    return keyed.join(few, across).select("node", "center")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each component, all columns.

    Of rows equal in doc_id and text one stays, rows without doc_id excepted.
    """
    doc, row, n = (free_name(docs, x) for x in ("_doc", "_row", "_n"))
    judged = settle(near_duplicates(docs, shingle, similarity))
    gone = judged.filter("NOT kept").select(F.col("doc_id").alias(doc), F.col("text_key").alias(row)).distinct()
    text = F.coalesce(text_key(F.col("text").cast("string")), F.lit(0))
    keyed = docs.withColumns({doc: F.col("doc_id").cast("long"), row: text})
    left = join_dimension(keyed, gone, [doc, row], "left_anti", salt_by=row)
    again = settle(
        judged.filter("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(doc), F.col("text_key").alias(row))
        .agg(F.count(F.lit(1)).alias(n)).filter(F.col(n) > 1).drop(n)
    )
    if again.isEmpty():
        return left.select(*docs.columns)
    once = join_dimension(left, again, [doc, row], "left_anti", salt_by=row, settled=True)
    twice = join_dimension(left, again, [doc, row], "left_semi", salt_by=row, settled=True).dropDuplicates([doc, row])
    return once.unionByName(twice).select(*docs.columns)
