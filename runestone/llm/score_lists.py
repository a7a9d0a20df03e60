"""Exact top-k search by aggregation of sorted lists without random access (NRA).

A vector's score for a query is the sum over dimensions of weight x component, so each
dimension of a block of vectors is a list sorted by component, and a query reads it from the
top where its weight is positive, from the bottom where it is negative. All lists of a block
are read together, in rounds of growing depth. After a round

* the *lower bound* of a vector is what was read of it, and the least value of each list in
  which it was not met;
* the *upper bound* is what was read of it, and the last value read of the others.

The k-th largest lower bound, over all blocks a task has seen, is a limit that the result
reaches. A query stops when so few vectors have an upper bound of at least this limit that
they can be resolved: nobody else can qualify, ties included. Only then are the survivors' scores
computed from their components. What was read is kept as two dense tables (from the
top, from the bottom), so the bounds of a thousand queries are two matrix products a round.

Queries come in blocks of a fixed number of bytes, which are broadcast one after the other; each
block meets all vectors in one pass. A task sends on at most k vectors a query, and the k best
of these are the result. Where dimensions are independent, as in random vectors, lists are read to
about nine tenths before bounds close; clustered or skewed dimensions close much earlier.

Components are whole numbers: floor(scale * x), x as double. Sums below 2^24 are added as 4-byte
floats, below 2^53 as 8-byte floats, both exact; larger ones as Python integers (scores beyond a
long are set to its ends).

Defined results: vectors that are null, empty, or hold a null, NaN or infinite component take no part.
A vector meets the queries of its own length only. Rows with the query's id are its own rows. A row without an id is no
query; as a candidate it comes after the others of its score. Equal query rows are one query,
and query rows of one id with different vectors are queries of their own. Candidates that are repeated each take
a place. Fewer candidates than k give fewer rows. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runestone.llm.common import map_batches
from runestone.session import settle

K = 5
SCALE = 256
# Vectors whose lists are sorted and read together, and queries whose bounds are computed together.
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
# Components of the queries of one broadcast block.
BLOCK_COMPONENTS = 2_000_000
# Shares of the lists that are read after each round.
DEPTHS = (0.5, 0.75, 0.875, 0.9375, 1.0)
# A query with at most this many times k survivors is resolved.
SURVIVORS = 4

# Orders rows without an id behind all others.
NO_ID = (1 << 63) - 1
LONG = (-(1 << 63), (1 << 63) - 1)

FOUND = "query int, score long, vec_id long"


def whole_components(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, rows x dimensions of floor(scale * x)) of a batch of (id, list), by the lists' length."""
    ids, lists = batch.column(0), batch.column(1)
    keys = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
    lengths = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        table = values[offsets[rows][:, None] + np.arange(length)]
        finite = np.isfinite(table).all(axis=1)
        if finite.any():
            with np.errstate(over="ignore"):
                yield keys[rows[finite]], np.floor(np.clip(scale * table[finite], -1.7e308, 1.7e308))


def exact_kind(queries: np.ndarray, largest: np.ndarray) -> type:
    """The cheapest numbers in which these queries' scores are exact, given the largest components."""
    most = float((np.abs(queries) @ largest).max(initial=0))
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def _kind(values: np.ndarray, kind: type) -> np.ndarray:
    if kind is object:
        return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)
    return values.astype(kind)


class Lists:
    """The sorted lists of a block of vectors, read from both ends to a growing depth."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        rows, self.dims = vectors.shape
        self.read = 0
        dims = np.arange(self.dims)
        self.low, self.high = vectors[self.order[0], dims], vectors[self.order[-1], dims]
        # What is known of each component, at least and at most: for readers from the top, then from the bottom.
        self.least_top, self.most_top = np.tile(self.low, (rows, 1)), np.tile(self.high, (rows, 1))
        self.least_bottom, self.most_bottom = self.least_top.copy(), self.most_top.copy()

    def advance(self, depth: int) -> None:
        """Read all lists, from both ends, down to ``depth`` entries."""
        dims = np.arange(self.dims)
        rows = len(self.vectors)
        for part, least, most in (
            (self.order[rows - depth:rows - self.read], self.least_top, self.most_top),
            (self.order[self.read:depth], self.least_bottom, self.most_bottom),
        ):
            met = self.vectors[part, dims]
            least[part, dims], most[part, dims] = met, met
        # Whoever was not met is no better than the last one that was.
        last_top, last_bottom = self.vectors[self.order[rows - depth], dims], self.vectors[self.order[depth - 1], dims]
        np.minimum(self.most_top, np.maximum(last_top, self.least_top), out=self.most_top)
        np.maximum(self.least_bottom, np.minimum(last_bottom, self.most_bottom), out=self.least_bottom)
        self.read = depth

    def bounds(self, positive: np.ndarray, negative: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds, queries x vectors, of weights split by sign."""
        lower = positive @ self.least_top.T + negative @ self.most_bottom.T
        upper = positive @ self.most_top.T + negative @ self.least_bottom.T
        return lower, upper


class Best:
    """The k best vectors so far of each of many queries, and the limit that the result reaches."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.scores = np.full((len(ids), k), None, object)
        self.vec_ids = np.zeros((len(ids), k), np.int64)
        self.limits = np.full(len(ids), -np.inf)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """One block of vectors against all queries."""
        kind = exact_kind(self.queries, np.abs(vectors).max(axis=0))
        lists = Lists(_kind(vectors, kind))
        rows = len(vectors)
        open_ = np.arange(len(self.ids))
        for share in DEPTHS:
            lists.advance(max(1, int(rows * share)))
            left = []
            for at in range(0, len(open_), QUERY_ROWS):
                left.append(self._round(lists, ids, open_[at:at + QUERY_ROWS], kind, share == 1.0))
            open_ = np.concatenate(left)
            if not len(open_):
                return

    def _round(self, lists: Lists, ids: np.ndarray, asked: np.ndarray, kind: type, last: bool) -> np.ndarray:
        """Bounds at this depth; resolves the queries that stop and returns the others."""
        weights = _kind(self.queries[asked], kind)
        lower, upper = lists.bounds(np.maximum(weights, 0), np.minimum(weights, 0))
        own_query, own_row = np.nonzero(self.ids[asked][:, None] == ids[None, :])
        if kind is object:
            lower, upper = lower.astype(np.float64), upper.astype(np.float64)
            slack = np.abs(upper).max() * 1e-9  # rounding only; the scores themselves stay integers
            lower, upper = lower - slack, upper + slack
        lower[own_query, own_row] = upper[own_query, own_row] = -np.inf
        if lower.shape[1] >= self.k:
            kth = np.partition(lower, -self.k, axis=1)[:, -self.k]
            self.limits[asked] = np.maximum(self.limits[asked], kth)
        alive = (upper >= self.limits[asked][:, None]) & (upper > -np.inf)
        stops = np.full(len(asked), True) if last else alive.sum(axis=1) <= SURVIVORS * self.k
        who, row = np.nonzero(alive & stops[:, None])
        if last and kind is not object:  # every list is read: the bounds are the scores
            scores = upper[who, row].astype(np.int64)
        elif kind is object:
            scores = np.array([int(np.dot(weights[q], lists.vectors[r])) for q, r in zip(who, row, strict=True)], object)
        else:
            scores = np.einsum("ij,ij->i", weights[who].astype(np.float64), lists.vectors[row].astype(np.float64)).astype(np.int64)
        cut = np.searchsorted(who, np.arange(len(asked) + 1))
        for n in np.flatnonzero(np.diff(cut)).tolist():
            self._put(int(asked[n]), scores[cut[n]:cut[n + 1]], ids[row[cut[n]:cut[n + 1]]])
        return asked[~stops]

    def _put(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(ids) > self.k and scores.dtype != object:  # ties by the thousand
            first = np.lexsort((ids, -scores))[:self.k]
            scores, ids = scores[first], ids[first]
        held = [(-s, v) for s, v in zip(self.scores[query], self.vec_ids[query].tolist(), strict=True) if s is not None]
        best = sorted(held + [(-int(s), v) for s, v in zip(scores, ids.tolist(), strict=True)])[:self.k]
        for n, (score, vec_id) in enumerate(best):
            self.scores[query, n], self.vec_ids[query, n] = -score, vec_id
        if len(best) == self.k:
            self.limits[query] = max(self.limits[query], np.nextafter(float(-best[-1][0]), -np.inf) if abs(best[-1][0]) > 1 << 53 else -best[-1][0])

    def rows(self, first: int) -> pa.RecordBatch:
        query, n = np.nonzero(self.scores != None)  # noqa: E711  compared entry by entry
        scores = [min(max(s, LONG[0]), LONG[1]) for s in self.scores[query, n]]
        vec_ids = self.vec_ids[query, n]
        return pa.RecordBatch.from_arrays(
            [pa.array((query + first).astype(np.int32)), pa.array(scores, pa.int64()), pa.array(vec_ids, mask=vec_ids == NO_ID)],
            ["query", "score", "vec_id"],
        )


def _search(queries: list[tuple[int, np.ndarray, np.ndarray]], k: int, scale: float):
    """``queries``: (number of the first, ids, components) for each length of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {table.shape[1]: (first, Best(ids, table, k)) for first, ids, table in queries.value}
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for ids, vectors in whole_components(batch, scale):
                if vectors.shape[1] not in best:
                    continue
                own = held.setdefault(vectors.shape[1], [])
                own.append((ids, vectors))
                if sum(len(i) for i, _ in own) >= BLOCK_ROWS:
                    _meet(best[vectors.shape[1]][1], held.pop(vectors.shape[1]))
        for length, own in held.items():
            _meet(best[length][1], own)
        for first, found in best.values():
            yield found.rows(first)

    return run


def _meet(best: Best, own: list[tuple[np.ndarray, np.ndarray]]) -> None:
    ids, vectors = np.concatenate([i for i, _ in own]), np.concatenate([v for _, v in own])
    for at in range(0, len(ids), BLOCK_ROWS):
        best.meet(ids[at:at + BLOCK_ROWS], vectors[at:at + BLOCK_ROWS])


def top_k(
    vectors: DataFrame, is_query: Column, id_column: str = "vec_id", vector_column: str = "embedding",
    k: int = K, scale: float = SCALE, block_components: int = BLOCK_COMPONENTS,
) -> DataFrame:
    """The k highest scores of every row for which ``is_query`` holds, against all rows.

    Returns query_id, rank (from 1), vec_id and score; ties go to the smaller id.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("components"), is_query.alias("asks")
    )
    asking = settle(rows.filter(F.col("asks") & F.col("id").isNotNull() & (F.size("components") > 0)).select("id", "components").distinct())
    size = asking.agg(F.sum(F.size("components"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_components))
    spark = vectors.sparkSession
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    result = None
    for n in range(n_blocks):
        # The queries of a block are told by digest, so a block is about as large as the bound; its rows are counted above.
        block = asking.filter(F.pmod(F.xxhash64("id", "components"), F.lit(n_blocks)) == n).toArrow()
        tables: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in block.to_batches():
            for ids, table in whole_components(batch, scale):
                tables.setdefault(table.shape[1], []).append((ids, table))
        sent, numbers, first = [], [], 0
        for parts in tables.values():
            ids, table = np.concatenate([i for i, _ in parts]), np.concatenate([t for _, t in parts])
            sent.append((first, ids, table))
            numbers += ids.tolist()
            first += len(ids)
        found = map_batches(rows, ["id", "components"], FOUND, _search(spark.sparkContext.broadcast(sent), k, scale))
        best = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        names = spark.createDataFrame(pa.table({"query": pa.array(range(len(numbers)), pa.int32()), "query_id": pa.array(numbers, pa.int64())}))
        best = best.join(F.broadcast(names), "query").select("query_id", "rank", "vec_id", "score")
        if n_blocks > 1:
            best = settle(best)  # one pass after the other, so that one block of queries is held at a time
        result = best if result is None else result.unionByName(best)
    return result
