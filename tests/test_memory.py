"""Batches of tasks: a few rows at a time as Python objects, a few counters instead of rows."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from runestone.functions.arrow import SLICE_ROWS, in_slices
from runestone.operators import features, network, subwords, tagging
from runestone.session import fresh_dir
from runestone.streaming import sessions


def test_slices():
    seen = []
    got = in_slices(lambda a: seen.append(len(a)) or a, pa.array(range(600)))
    assert got.to_pylist() == list(range(600)) and max(seen) == SLICE_ROWS
    assert in_slices(lambda a: a, pa.array([], pa.int64())).to_pylist() == []


def test_lists_with_nulls_over_several_slices(spark):
    n = 3 * SLICE_ROWS + 5
    rows = [(i, None if i % 7 == 0 else [] if i % 5 == 0 else [f"Ab{i % 11}", "berlin", "zz"]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, t array<string>").coalesce(1)
    pieces = spark.createDataFrame([("A",), ("##b",), ("berl",), ("##in",), *((f"##{d}",) for d in range(10))], "piece string")
    names = spark.createDataFrame([("berlin", "GPE")], "name string, label string")
    got = {r.id: (r.s, r.l) for r in df.select("id", subwords.subword_encoder(pieces)("t").alias("s"), tagging.name_lookup(names)("t").alias("l")).collect()}
    for i, t in rows:
        split = None if t is None else [p for w in t for p in (["berl", "##in"] if w == "berlin" else ["[UNK]"] if w == "zz" else ["A", "##b", *(f"##{d}" for d in w[2:])])]
        assert got[i] == (split, None if t is None else [{"berlin": "GPE"}.get(w) for w in t])


def test_weights_over_several_slices(spark):
    n = 2 * SLICE_ROWS + 3
    df = spark.createDataFrame([(i, None if i % 9 == 0 else f"a a b w{i % 4}") for i in range(n)], "doc_id long, text string").coalesce(1)
    vocabulary = spark.createDataFrame([("a", 1.5), ("b", 2.0)], "term string, idf double")
    got = {(r.doc_id, r.term): r.weight for r in features.tfidf_weights(df, vocabulary).collect()}
    norm = np.sqrt(9 + 4)
    assert got == pytest.approx({(i, t): x / norm for i in range(n) if i % 9 for t, x in (("a", 3.0), ("b", 2.0))})


def test_a_split_is_summarized_before_the_shuffle():
    batches = [pa.RecordBatch.from_arrays([pa.array([3] * 1000, pa.int32()), pa.array([f"t{(i * i) % 97}" if i % 3 else "hot" for i in range(1000)])], ["part", "tag"]) for _ in range(5)]
    true = Counter(t for b in batches for t in b.column(1).to_pylist())
    out = list(sessions._summarized(10)(iter(batches)))
    rows = [tuple(r.values()) for b in out for r in b.to_pylist()]
    (_, _, total, short), counts = rows[0], rows[1:]
    assert len(counts) <= 10 and total == 5000 and short <= total / 11
    assert all(n <= true[t] <= n + short for _, t, n, _ in counts) and "hot" in {t for _, t, _, _ in counts}
    assert list(sessions._summarized(10)(iter([]))) == []


def test_rows_are_not_shuffled_to_the_summaries(spark):
    source = fresh_dir(spark, "in")
    spark.createDataFrame([("x",)], "tag string").write.parquet(source)
    stream = sessions.frequent_tags(spark.readStream.schema("tag string").parquet(source), size=5)
    plan = stream._jdf.queryExecution().logical().toString()
    assert plan.index("FlatMapGroupsInPandasWithState") < plan.index("MapInArrow")


def test_steps_in_parts_are_whole_steps():
    rng = np.random.default_rng(1)
    begin = rng.normal(size=3 * network.PART + 7).astype(np.float32)
    steps, flat = network.Steps(begin.copy(), 0.01), begin.copy()
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    for n in range(1, 4):
        slopes = rng.normal(size=len(flat)).astype(np.float32)
        steps.take(slopes)
        mean += 0.1 * (slopes - mean)
        square += 0.001 * (slopes * slopes - square)
        rate = 0.01 * np.sqrt(1 - 0.999 ** n) / (1 - 0.9 ** n)
        flat -= (rate * mean / (np.sqrt(square) + 1e-7)).astype(np.float32)
    assert np.array_equal(steps.flat, flat)
