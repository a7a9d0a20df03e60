"""Packing and mixing against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from runestone.llm import curriculum, packing
from runestone.llm.queries import tokenizer_path


def ids_of(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids, 1]


def gapless(placed, capacity):
    """placed: (sequence, offset, length) -> the sequences, checked."""
    held = defaultdict(list)
    for sequence, offset, length in placed:
        held[sequence].append((offset, length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return held


@pytest.mark.parametrize("name", ["table", "awkward", "nothing"])
def test_pieces(request, name):
    docs = request.getfixturevalue(name)
    pieces = packing.pack(packing.tokenize(docs, tokenizer_path(), 64), 64, slice_bytes=2000).collect()
    want = Counter()
    for doc, text in docs.select("doc_id", "text").collect():
        ids = ids_of(text)
        for n, at in enumerate(range(0, len(ids), 64)):
            part = ids[at:at + 64]
            want[doc, n, at, len(part), np.array(part, "<u4").tobytes()] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in pieces) == want
    sequences = gapless([(r["sequence_id"], r["offset"], r["length"]) for r in pieces], 64)
    assert len(sequences) == brute.best_fit([r["length"] for r in pieces], 64)


def test_assembled(spark, table):
    packed = packing.pack(packing.tokenize(table.limit(40), tokenizer_path(), 256), 256)
    packed = spark.createDataFrame(packed.collect(), packed.schema)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.assemble(packed).collect()}
    for r in packed.collect():
        assert whole[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])] == bytes(r["ids"])


def test_words_that_hold_the_mark():
    encoder = packing.WordEncoder(tokenizer_path())
    texts = ["a<|startoftext|>b c", "<|startoftext|>", "x <|startoftext| y", "it's 42% Ünï-cödé \U0001f600 　 日本 語", "", "á b"]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [ids_of(t)[:-1] for t in texts]
    for kept in (encoder.words, encoder.pieces):
        kept.known, kept.older = {}, kept.known  # the older generation gives the same
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == got


def test_pieces_of_words(table):
    """Texts cut into pieces here have the ids that the whole tokenizer gives them."""
    encoder = packing.WordEncoder(tokenizer_path())
    assert encoder.splits
    rng = random.Random(4)
    letters = "abcXYZéÉñŸÿ'’sSdmtlrv0189 .,!?|<>—ΣİıſŁßàǘ ½²ªµ×÷日ŉ\t\x1c\x7f\x00"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice("abÉñ'sS09 .,!\n") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += [r["text"] for r in table.select("text").collect()]
    for size in (100_000, 50):  # forgetting changes nothing
        encoder.words, encoder.pieces = packing.Remembered(size), packing.Remembered(size)
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [ids_of(t)[:-1] for t in texts]


@pytest.mark.parametrize("seed", range(30))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100])
    shape = rng.choice([lambda: rng.randint(1, capacity), lambda: min(capacity, 1 + int(rng.expovariate(6 / capacity))), lambda: capacity // 3 + rng.randint(0, 2), lambda: 1])
    lengths = [shape() for _ in range(rng.choice([1, 7, 400]))]
    counts = Counter(lengths)
    plan = packing.Plan(dict(counts), capacity)
    every = np.array([n for n in counts for _ in range(counts[n])], np.int64)
    ranks = np.array([r for n in counts for r in range(counts[n])], np.int64)
    sequence, offset = packing._places(every, ranks, plan.table())
    held = gapless(zip(sequence.tolist(), offset.tolist(), every.tolist(), strict=True), capacity)
    assert len(held) == plan.sequences == brute.best_fit(lengths, capacity)


def test_plan_does_not_grow_with_the_corpus():
    rng = random.Random(1)
    counts = {n: rng.randint(0, 50) + 1 for n in range(1, 4097)}
    small, large = (packing.Plan({n: c * k for n, c in counts.items()}, 4096) for k in (1, 10**9))
    assert len(large.steps) < 8 * 4096 and len(large.steps) < 2 * len(small.steps) + 4096
    filled = sum(n * c for n, c in counts.items()) * 10**9 / 4096
    # Full but for the pieces over half of the capacity that have no partner.
    assert large.sequences < 1.01 * filled


def test_hot_length_is_ranked_in_slices(spark):
    items = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50 + 1).cast("long").alias("length"))
    placed = packing.pack(items, 64, slice_rows=100).collect()
    assert len(placed) == 3000
    assert len(gapless([(r["sequence_id"], r["offset"], r["length"]) for r in placed], 64)) == brute.best_fit([r["length"] for r in placed], 64)


def test_lengths_are_checked(spark):
    for n in (0, 65, None):
        with pytest.raises(ValueError, match="lengths"):
            packing.pack(spark.createDataFrame([(1, n)], "doc_id long, length long"), 64)


def test_query_digests(spark, sf):
    from runestone.llm.queries import QUERIES

    rows = QUERIES["op2_best_fit_packing"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in rows[::17]:
        part = ids_of(texts[r["doc_id"]])[r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    gapless([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 4096)


@pytest.mark.parametrize("name", ["table", "awkward", "nothing"])
@pytest.mark.parametrize("slice_rows", [1, 100_000])
def test_mix(request, name, slice_rows):
    docs = request.getfixturevalue(name)
    got = curriculum.mix(docs, slice_rows=slice_rows).collect()
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r["source"]] += len(brute.words(r["text"]))
    assert len(got) == docs.count()
    if not sizes:
        return
    want = brute.targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        size = len(brute.words(r["text"]))
        assert r["mix_size"] == size and r["mix_source_size"] == sizes[r["source"]]
        assert r["mix_target"] == pytest.approx(float(want[r["source"]]))
        assert r["mix_taken"] in (0, size, 2 * size, 3 * size) and r["mix_taken"] == size * len(r["mix_times"])
        assert list(r["mix_times"]) == sorted(r["mix_times"]) and all(0 <= t <= 1 for t in r["mix_times"])
        taken[r["source"]] += r["mix_taken"]
        largest[r["source"]] = max(largest[r["source"]], size)
    for source, target in want.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6
    assert Counter(map(str, got)) == Counter(map(str, curriculum.mix(docs.repartition(5), slice_rows=slice_rows).collect()))


def test_schedule_is_followed(spark):
    """Up to any time, the share of a source's taken words is the integral of its schedule."""
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit("a b c d").alias("text")
    )
    mixed = curriculum.mix(docs)
    rows = curriculum.training_order(mixed, 7).select("source", "mix_time").collect()
    assert [r["mix_time"] for r in rows] == sorted(r["mix_time"] for r in rows)
    for n, phases in enumerate(curriculum.PHASES):
        times = np.array([r["mix_time"] for r in rows if r["source"] == f"s{n}"])
        for step in range(1, 5):
            assert (times <= step / 4).mean() == pytest.approx(sum(phases[:step]) / sum(phases), abs=0.01)


def test_targets_stop_and_are_shared_again(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(2, "a"), (900, "b"), (3, "c"), (50, "d"), (800, None), (700, None)])]
    got = {r["source"]: r["mix_target"] for r in curriculum.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    want = brute.targets({"a": 2, "b": 900, "c": 3, "d": 50, None: 1500})
    assert got == {s: pytest.approx(float(t)) for s, t in want.items()}
    assert got["a"] == 6 and sum(got.values()) == pytest.approx(2455)


def test_only_built_in_operations(table):
    plan = curriculum.training_order(curriculum.mix(table))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow", "CartesianProduct"))
