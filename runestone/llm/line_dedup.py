"""Line dedup over a corpus: hashes range-partitioned, sorted by document and position, streamed.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys of
some length that are in several documents stay only in the largest doc_id that
holds them. What leaves the sort are bitmaps of the lines to keep, not texts.

1. Every text gives one row per key: a 128-bit hash, the document, the positions.
2. The rows are range-partitioned by (hash, document downwards) and sorted. A key
   in a third of all documents spreads over many ranges, as documents split it.
3. Each range is streamed: the first document of a hash keeps its lines. Memory
   holds the rows of a hash only until its document count decides. Only the first
   and last hash of a range can go on elsewhere; their rows wait for a table of
   counts that has at most two rows per range.
4. Dropped positions meet per document and become a compressed bitmap.

Defined results: a null or empty text is one empty line. A null doc_id is below all
others, and rows with a null doc_id count as one document. Rows that share a
doc_id count as one document; all of them keep or lose the line. An empty table gives an
empty table. ``apply_bitmaps`` keeps columns of any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runestone.llm.common import column_of, free_name, id_or_lowest, map_batches, text_key, with_length
from runestone.session import settle

MIN_CHARS = 40
MIN_DOCS = 5
# Rows in one batch that leaves a task.
ROWS = 50_000

KEYS = "h1 long, h2 long, doc long, row long, positions binary"
STREAMED = "kind int, h1 long, h2 long, doc long, row long, positions binary, docs long, last_doc long"
BITMAPS = "doc long, row long, keep binary"
DROP, WAIT, COUNT = 0, 1, 2


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, None for one that is too short."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per document and key that is long enough, with the line numbers (uint32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, owners, places = [], [], []
            ids, rows = column_of(batch, "doc"), column_of(batch, "row")
            for at, text in enumerate(column_of(batch, "text")):
                found: dict[bytes, list[int]] = {}
                for n, line in enumerate((text or b"").split(b"\n")):
                    key = line_key(line, min_chars)
                    if key is not None:
                        found.setdefault(xxhash.xxh3_128_digest(key), []).append(n)
                hashes += found
                owners += [at] * len(found)
                places += [np.array(x, "<u4").tobytes() for x in found.values()]
                if len(hashes) >= ROWS:
                    yield _keys(hashes, owners, places, ids, rows)
                    hashes, owners, places = [], [], []
            if hashes:
                yield _keys(hashes, owners, places, ids, rows)

    text = F.col("text").cast("string")
    return map_batches(
        docs, [id_or_lowest(F.col("doc_id")).alias("doc"), F.coalesce(text_key(text), F.lit(0)).alias("row"), text.alias("text")],
        KEYS, run,
    )


def _keys(hashes: list[bytes], owners: list[int], places: list[bytes], ids: list[int], rows: list[int]) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
    at = np.array(owners)
    return pa.RecordBatch.from_arrays(
        [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(np.array(ids, np.int64)[at]),
         pa.array(np.array(rows, np.int64)[at]), pa.array(places, pa.binary())],
        ["h1", "h2", "doc", "row", "positions"],
    )


class _Run:
    """Rows of one hash, as they come in from a sorted range."""

    def __init__(self, key: tuple[int, int], first_of_range: bool, min_docs: int):
        self.key, self.first_of_range, self.min_docs = key, first_of_range, min_docs
        self.docs, self.keeper, self.last = 0, None, None
        self.held: list[tuple[int, int, bytes]] = []

    def add(self, docs: list[int], rows: list[int], places: list[bytes], out: _Out) -> None:
        for doc, row, place in zip(docs, rows, places, strict=True):
            if not self.docs or doc != self.last:
                self.docs += 1
                self.last = doc
            if self.keeper is None:
                self.keeper = doc
            if self.first_of_range:
                out.add(WAIT, self.key, doc, row, place)
            elif doc != self.keeper:
                self.held.append((doc, row, place))
        if self.docs >= self.min_docs:
            self._release(DROP, out)

    def _release(self, kind: int, out: _Out) -> None:
        for doc, row, place in self.held:
            out.add(kind, self.key, doc, row, place)
        self.held = []

    def close(self, last_of_range: bool, out: _Out) -> None:
        if last_of_range or self.first_of_range:
            self._release(WAIT, out)
            out.count(self.key, self.docs, self.keeper, self.last)


class _Out:
    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(self, kind: int, key: tuple[int, int], doc: int, row: int, place: bytes) -> None:
        self.rows.append((kind, *key, doc, row, place, None, None))

    def count(self, key: tuple[int, int], docs: int, first: int, last: int) -> None:
        self.rows.append((COUNT, *key, first, None, None, docs, last))

    def batch(self) -> pa.RecordBatch:
        names = [x.split()[0] for x in STREAMED.split(", ")]
        kinds = [pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.int64(), pa.int64()]
        columns = list(zip(*self.rows, strict=True))
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _streamed(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current = _Out(), None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h1, h2, docs, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            places = batch.column(4)
            starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            ends = np.r_[starts[1:], n]
            # A hash with one row in the middle of a batch is in one document: nothing to do.
            matter = ends - starts > 1
            matter[[0, -1]] = True
            for s, e in zip(starts[matter].tolist(), ends[matter].tolist(), strict=True):
                key = (int(h1[s]), int(h2[s]))
                if current is None or current.key != key:
                    if current is not None:
                        current.close(False, out)
                    current = _Run(key, current is None, min_docs)
                current.add(docs[s:e].tolist(), rows[s:e].tolist(), places.slice(s, e - s).to_pylist(), out)
            if len(out.rows) >= ROWS:
                yield out.batch()
        if current is not None:
            current.close(True, out)
        if out.rows:
            yield out.batch()

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for parts in batch.column(2).to_pylist():
            gone = np.frombuffer(b"".join(parts), "<u4")
            keep = np.ones((int(gone.max()) // 8 + 1) * 8, bool)
            keep[gone] = False
            maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.binary())], ["doc", "row", "keep"])


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Compressed keep bitmaps of the documents that lose lines, by document and text key.

    Bit n tells whether line n stays; lines after the last bit stay.
    """
    # Written first, since finding the ranges reads the rows once more than sorting them.
    keys = settle(line_keys(docs, min_chars))
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("row")]
    streamed = settle(keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_streamed(min_docs), STREAMED))
    # At most two rows per range: a hash's parts, each going on where the last one ended.
    part = Window.partitionBy("h1", "h2").orderBy(F.col("doc").desc(), F.col("last_doc").desc())
    counts = (
        streamed.filter(F.col("kind") == COUNT).select("h1", "h2", "doc", "docs", "last_doc")
        .withColumn("_again", F.coalesce((F.lag("last_doc").over(part) == F.col("doc")).cast("long"), F.lit(0)))
        .groupBy("h1", "h2").agg(F.sum(F.col("docs") - F.col("_again")).alias("docs"), F.max("doc").alias("keeper"))
        .filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper")
    )
    waiting = streamed.filter(F.col("kind") == WAIT).select("h1", "h2", "doc", "row", "positions")
    decided = waiting.join(F.broadcast(counts), ["h1", "h2"]).filter(F.col("doc") != F.col("keeper"))
    dropped = streamed.filter(F.col("kind") == DROP).select("doc", "row", "positions").unionByName(
        decided.select("doc", "row", "positions")
    )
    return dropped.groupBy("doc", "row").agg(F.collect_list("positions").alias("positions")).mapInArrow(_bitmaps, BITMAPS)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the text of the kept lines, and columns for their number before and those dropped.

    Columns of these two names are replaced. Bitmaps move to the texts in one shuffle on the document.
    """
    docs = docs.drop(n_lines, n_dropped)
    columns = docs.columns
    doc, row, keep = (free_name(docs, x) for x in ("_doc", "_row", "_keep"))
    text = F.col("text").cast("string")
    keyed = docs.withColumns({doc: id_or_lowest(F.col("doc_id")), row: F.coalesce(text_key(text), F.lit(0))})
    named = bitmaps.select(F.col("doc").alias(doc), F.col("row").alias(row), F.col("keep").alias(keep)).dropDuplicates([doc, row])
    joined = keyed.join(named.hint("shuffle_hash"), [doc, row], "left").select(*columns, keep)
    schema = joined.select(*columns).schema.add(n_lines, "long").add(n_dropped, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts, lines, dropped = [], [], []
            for text, bits in zip(column_of(batch, "text"), batch.column(len(columns)).to_pylist(), strict=True):
                n, gone = (text or b"").count(b"\n") + 1, 0
                if bits is not None:
                    own = (text or b"").split(b"\n")
                    stay = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), bitorder="little")[:n].tolist()
                    stay += [1] * (n - len(stay))
                    kept = [line for line, s in zip(own, stay, strict=True) if s]
                    gone, text = n - len(kept), b"\n".join(kept)
                texts.append(text)
                lines.append(n)
                dropped.append(gone)
            out = [batch.column(i) for i in range(len(columns))]
            out[at] = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*out, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=[f.name for f in schema.fields])

    return joined.mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the lines that stay and all their columns; ``n_chars`` follows the text."""
    counts = [free_name(docs, x) for x in ("n_lines", "n_dropped")]
    return with_length(apply_bitmaps(docs, line_bitmaps(docs, min_chars, min_docs), *counts).select(*docs.columns))
