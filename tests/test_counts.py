"""Words and 3-grams counted a block at a time, against the stages of the models that are served."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from runestone.functions import hashing
from runestone.functions.tokens import character_kinds, split_words, word_tokens
from runestone.operators import counts, regression, training

ALPHABET = "abIJ1é ßñ中文🙂𝔘́\n\t.,!-\x1c\x85 　_'İ"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(300)]
    return [*made, "", " ", "a", "ab", "abc", "🙂🙂🙂", "w" * 5000, "a", made[0]]


@pytest.fixture(scope="module")
def rows(spark, texts):
    return spark.createDataFrame([(i % 7, t, i % 2) for i, t in enumerate(texts)], "doc_id long, clean_text string, label int").coalesce(2)


def test_words_are_those_of_the_jvm(spark, texts):
    given = [*texts, None, "a"]
    df = spark.createDataFrame(list(enumerate(given)), "i int, t string").select("i", F.lower("t").alias("l"))
    want = df.withColumn("w", word_tokens(F.col("l"))).orderBy("i").collect()
    found, lengths = split_words(pa.array([r.l for r in want], pa.string()), character_kinds(spark))
    found, ends = found.to_pylist(), np.cumsum(lengths)
    assert [found[e - n:e] for e, n in zip(ends, lengths)] == [r.w or [] for r in want]


@pytest.mark.parametrize("table", [1 << 22, 10])
def test_hashed_counts_are_those_of_the_stages(spark, rows, monkeypatch, table):
    monkeypatch.setattr(hashing, "TABLE", table)
    fitted = training.train_challenger(rows, word_buckets=64, char_buckets=32, max_iter=1)
    lowered = rows.select(F.lower("clean_text").alias("l")).toArrow().column("l").combine_chunks()
    lengths, places, found = counts.hashed_counts(lowered, character_kinds(spark), 64, 32)
    got, ends = list(zip(places.tolist(), found.tolist())), np.cumsum(lengths)
    stages = PipelineModel(fitted.model.stages[:6])
    want = Counter(tuple(zip(map(int, np.flatnonzero(v)), v[v != 0])) for v in (r.counts.toArray() for r in stages.transform(rows).collect()))
    assert Counter(tuple(sorted(got[e - n:e])) for e, n in zip(ends, lengths)) == want


def test_the_challengers_idf_is_sparks(rows):
    from pyspark.ml.feature import IDF

    model = training.train_challenger(rows, word_buckets=64, char_buckets=32, max_iter=1).model
    counted = PipelineModel(model.stages[:6]).transform(rows)
    assert model.stages[6].getScalingVec().toArray() == pytest.approx(IDF(inputCol="counts").fit(counted).idf.toArray())


def test_blocks_hold_the_features_of_the_pipeline(spark, rows, monkeypatch):
    monkeypatch.setattr(counts, "BLOCK_CHARS", 50)
    model = training.train_challenger(rows, word_buckets=64, char_buckets=32, max_iter=1).model
    idf = model.stages[6].getScalingVec().toArray()
    blocks = regression.normalized(counts.hashed_blocks(rows.withColumn("w", F.lit(1.0)), "clean_text", "label", "w", 64, 32), idf).collect()
    got = []
    for raw in blocks:
        own, places, values, labels, _, factors = regression._block(raw)
        dense = np.zeros((len(labels), 96))
        dense[own, places] = values * idf[places] * factors[own]
        got += dense.tolist()
    want = [r.features.toArray().tolist() for r in model.transform(rows).select("features").collect()]
    assert np.allclose(got, want)


def test_a_block_takes_few_bytes_for_an_entry(spark, texts):
    lowered = pa.array([t.lower() for t in texts * 20])
    lengths, places, found = counts.hashed_counts(lowered, character_kinds(spark), 1 << 15, 1 << 13)
    n = len(lengths)
    raw = regression.raw_block(lengths, places, np.minimum(found, 255), np.zeros(n, int), np.ones(n))
    assert sum(map(len, raw)) <= 3 * lengths.sum() + 24 * n


def test_sums_by_a_tree_are_those_of_the_driver(spark, monkeypatch, rows):
    blocks = counts.hashed_blocks(rows.repartition(9).withColumn("w", F.lit(1.0)), "clean_text", "label", "w", 64, 32)
    direct = counts.doc_counts(blocks, 96)
    monkeypatch.setattr(regression, "DIRECT_BYTES", 0)
    assert np.array_equal(direct, counts.doc_counts(blocks, 96)) and direct.sum() > 0


def test_gradient_with_repeated_and_null_keys(spark):
    """The gradient is that of all rows the model was fitted to: keys are not joined."""
    schema = "doc_id long, clean_text string, label int"
    made = [(i % 3 or None, " ".join(f"{'ab'[i % 2]}{i % 5} w{i % 9}".split() + ["x"] * (i % 4)), (i // 3) % 2) for i in range(60)]
    df = spark.createDataFrame(made, schema).coalesce(2)
    fitted = training.train_baseline(df, tol=1e-7)
    assert training.largest_gradient(fitted, df) < 1e-4 < training.largest_gradient(training.train_baseline(df, max_iter=1), df)
