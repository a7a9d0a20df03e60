"""Features, metrics, training, scoring and compression."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from runestone.functions import arrays as ax
from runestone.functions import vectors as vx
from runestone.operators import compression, evaluation, features, sampling, training
from runestone.plans import compression_job, scoring, training_job
from runestone.session import fresh_dir

DOCS = [
    (0, "the cat sat on the mat"), (1, "the dog ate the cat food"), (2, "stocks fell on monday"), (3, "Stocks and bonds, bonds!"),
]


def test_tfidf(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    tokens = [t.lower().replace(",", " ,").replace("!", " !").split() for _, t in DOCS]
    counts = Counter(w for ts in tokens for w in ts)
    kept = sorted(counts, key=lambda w: (-counts[w], w))[:6]
    df_of = {w: sum(w in ts for ts in tokens) for w in kept}
    idf = {w: math.log((1 + len(DOCS)) / (1 + df_of[w])) + 1 for w in kept}
    vocabulary = features.tfidf_vocabulary(df, 6)
    got = {r.term: (r.term_count, r.doc_count, r.idf) for r in vocabulary.collect()}
    assert got == {w: (counts[w], df_of[w], pytest.approx(idf[w])) for w in kept}
    weights = defaultdict(dict)
    for r in features.tfidf_weights(df, vocabulary).collect():
        weights[r.doc_id][r.term] = r.weight
    for i, ts in enumerate(tokens):
        raw = {w: ts.count(w) * idf[w] for w in set(ts) & set(kept)}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        assert weights[i] == {w: pytest.approx(v / norm) for w, v in raw.items()}


def test_class_weights(spark):
    df = spark.createDataFrame([(i, int(i > 6)) for i in range(10)], "doc_id long, label int")
    assert {r.label: r.weight for r in features.class_weights(df).collect()} == {0: pytest.approx(10 / 14), 1: pytest.approx(10 / 6)}


def python_f1(pairs):
    scores = []
    for c in {x for pair in pairs for x in pair}:
        hit = sum(a == b == c for a, b in pairs)
        total = sum(a == c for a, _ in pairs) + sum(b == c for _, b in pairs)
        scores.append(2 * hit / total)
    return sum(scores) / len(scores)


def python_auc(rows, c):
    pos = [p[c] for label, p in rows if label == c]
    neg = [p[c] for label, p in rows if label != c]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        p = [rng.choice([0.0, 0.1, 0.25, 0.5]) for _ in range(3)]
        rows.append((i, rng.choice([0, 0, 0, 0, 1, 2]), p, rng.choice([0, 1, 2, 3]), rng.choice(["en", "sv"])))
    df = spark.createDataFrame(rows, "doc_id long, label int, probability array<double>, pred int, language string")
    return df.cache(), rows


def test_metrics(scored):
    df, rows = scored
    pairs = [(r[1], r[3]) for r in rows]
    got = evaluation.evaluate(df, probabilities="probability").first()
    assert got.accuracy == pytest.approx(sum(a == b for a, b in pairs) / len(pairs))
    assert got.f1_macro == pytest.approx(python_f1(pairs))
    points = [(r[1], r[2]) for r in rows]
    aucs = [python_auc(points, c) for c in range(3)]
    assert got.auc == pytest.approx(sum(aucs) / 3)
    assert {r["class"]: r.auc for r in evaluation.auc_by_class(df).collect()} == {c: pytest.approx(a) for c, a in enumerate(aucs)}
    assert {(r.label, r.pred): r.n for r in evaluation.confusion_matrix(df).collect()} == Counter(pairs)
    by_language = {r.language: r.accuracy for r in evaluation.per_language_accuracy(df).collect()}
    for lang in ("en", "sv"):
        of = [(r[1], r[3]) for r in rows if r[4] == lang]
        assert by_language[lang] == pytest.approx(sum(a == b for a, b in of) / len(of), abs=5e-5)


def test_auc_is_undefined_without_a_class_or_with_two(scored):
    df, _ = scored
    assert evaluation.macro_auc(df.filter("label <> 2")).first().auc is None
    two = df.filter("label < 2").withColumn("probability", F.slice("probability", 1, 2))
    assert evaluation.macro_auc(two).first().auc is None


def test_lift(scored):
    df, _ = scored
    base = df.withColumn("pred", F.lit(0))
    got = evaluation.lift_over_baseline(evaluation.accuracy(df), evaluation.accuracy(base)).first()
    assert got.lift_points == pytest.approx(100 * (got.accuracy - got.baseline_accuracy), abs=0.01)


def test_softmax_argmax_top(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 0.5]), (2, [1000.0, 0.0, 1000.0]), (3, [0.0, 0.0, 0.0])], "i int, z array<double>")
    p = ax.softmax(F.col("z"))
    rows = {r.i: r for r in df.select("i", "z", p.alias("p")).withColumn("c", ax.argmax(F.col("p"))).withColumn(
        "t", ax.top_entries(F.col("p"), 2)).collect()}
    for r in rows.values():
        e = [math.exp(x - max(r.z)) for x in r.z]
        assert r.p == pytest.approx([x / sum(e) for x in e])
    assert [rows[i].c for i in (1, 2, 3)] == [1, 0, 0]
    assert [[x.category_id for x in rows[i].t] for i in (1, 2, 3)] == [[1, 0], [0, 2], [0, 1]]


TOPICS = {
    0: "rain snow wind storm sunny cloud forecast cold".split(), 1: "song album band guitar concert melody singer tune".split(),
    2: "train ticket bus station platform journey seat travel".split(),
}


@pytest.fixture(scope="module")
def topics(spark):
    rng = random.Random(2)
    rows = []
    for i in range(240):
        label = rng.choice([0, 0, 1, 2])
        text = " ".join(rng.choice(TOPICS[label]) if rng.random() < 0.8 else rng.choice(["the", "a", "is"]) for _ in range(7))
        rows.append((i, text, text, label, rng.choice(["en", "sv", "fi"])))
    df = spark.createDataFrame(rows, "doc_id long, text string, clean_text string, label int, language string")
    return sampling.stratified_split(df).cache()


def test_train_report(spark, topics):
    path = fresh_dir(spark, "best")
    parts = training_job.train_report(topics, path, challenger_candidates=[{"c": 0.01, "max_iter": 20}, {"max_iter": 20}], max_iter=30)
    report = parts["report"].first()
    assert report.classification_accuracy > 0.85 and report.baseline_accuracy > 0.85 and report.f1_score_macro > 0.8
    assert report.languages_supported == ["en", "fi", "sv"] and set(report.per_language_accuracy) == {"en", "fi", "sv"}
    candidates = parts["candidates"].collect()
    kept = [c for c in candidates if c.kept]
    assert len(kept) == 1 and kept[0].val_loss == min(c.val_loss for c in candidates)
    losses = [r.loss for r in parts["history"].orderBy("iteration").collect()]
    assert losses[-1] < losses[0]
    assert parts["examples"].columns == ["doc_id", "text", "label", "predicted_label", "language"] and parts["examples"].count() == 20
    folder = fresh_dir(spark, "artifacts")
    training_job.write_artifacts(parts, folder)
    assert spark.read.json(f"{folder}/performance_metrics").first().baseline_accuracy == report.baseline_accuracy
    assert spark.read.csv(f"{folder}/training_history", header=True).columns == ["iteration", "loss"]
    loaded = training.load_model(path)
    again = training.score(loaded, topics.filter("split = 'val'"), ["doc_id"])
    assert {(r.doc_id, r.pred) for r in again.collect()} == {(r.doc_id, r.pred) for r in parts["scored"].collect()}


def test_clean_split(spark):
    df = spark.createDataFrame([(i, f"<b>word {i}</b>" if i % 5 else "<i></i>", i % 2) for i in range(100)],
                               "doc_id long, text string, label int").withColumn("language", F.lit("en"))
    got = training_job.clean_split(df)
    assert got.count() == 80 and got.filter("split = 'val'").count() == 16
    assert got.filter("clean_text like '%<%'").count() == 0


def test_features_of_the_pipeline_are_the_tfidf_table(topics):
    fitted = training.train_baseline(topics, max_features=12, max_iter=3)
    terms = fitted.model.stages[1].vocabulary
    want = defaultdict(dict)
    vocabulary = features.tfidf_vocabulary(topics, 12, "clean_text")
    for r in features.tfidf_weights(topics, vocabulary, "clean_text").collect():
        want[r.doc_id][r.term] = pytest.approx(r.weight)
    for r in fitted.model.transform(topics).select("doc_id", "features").collect():
        assert {terms[i]: v for i, v in zip(r.features.indices.tolist(), r.features.values.tolist())} == want[r.doc_id]


def test_cross_validation(topics):
    folds = training.cross_validate(topics, 3, max_iter=20).collect()
    assert [f.fold for f in folds] == [0, 1, 2] and all(f.f1_macro > 0.7 for f in folds)


def test_training_errors(spark, topics):
    with pytest.raises(ValueError):
        training.train_baseline(None)
    with pytest.raises(KeyError):
        training.train_baseline(topics.drop("label"))
    with pytest.raises(ValueError):
        training.train_baseline(topics.limit(0))
    with pytest.raises(ValueError):
        training.select_model(topics, topics, [], fresh_dir(spark, "m"))


def length_model(classes):
    def load():
        def predict(texts):
            matrix = np.zeros((len(texts), classes))
            for i, t in enumerate(texts):
                n = len(t)
                matrix[i, (n + 1) % classes] = 0.25
                matrix[i, n % classes] = (3 + n % 7) / 10
            return matrix
        return predict
    return load


BATCH = [(1, "Stocks rose today", "en"), (2, "Laget vann", "sv"), (3, "Lääkäri", "fi"), (4, "  ", None), (5, None, None)]


@pytest.fixture(scope="module")
def batch(spark):
    names = spark.createDataFrame([(0, "finance"), (1, "sports"), (2, "health")], "label int, label_text string")
    return spark.createDataFrame(BATCH, "doc_id long, text string, language string"), names


def test_score_batch(batch):
    df, names = batch
    rows = {r.doc_id: r for r in scoring.score_batch(df, scoring.length_scorer(3), names).collect()}
    assert len(rows) == 5
    for key, text, lang in BATCH:
        clean = (text or "").strip()
        r = rows[key]
        assert r.category_id == len(clean) % 3 and r.confidence == (3 + len(clean) % 7) / 10
        assert r.low_confidence == (r.confidence < 0.5)
        assert r.category == ["finance", "sports", "health"][r.category_id] == r.top_categories[0].category
        assert len(r.top_categories) == 3 and r.language == (lang or "en")
        assert r.status == ("ok" if clean else "blank")
    assert rows[4].tags == [] and rows[1].keywords == ["stocks", "rose", "today"]


def test_plugin_scorer_equals_the_column_scorer(batch):
    df, names = batch
    plugged = scoring.score_batch(df, scoring.plugin_scorer(length_model(3)), names).collect()
    native = scoring.score_batch(df, scoring.length_scorer(3), names).collect()
    assert {r.doc_id: r for r in plugged} == {r.doc_id: r for r in native}


def test_unknown_names_are_numbers_and_blanks_raise_when_strict(spark, batch):
    df, names = batch
    rows = scoring.score_batch(df, scoring.length_scorer(5), names.filter("label < 2")).collect()
    assert {r.category for r in rows} <= {"finance", "sports", "2", "3", "4"}
    assert scoring.score_batch(df.limit(0), scoring.length_scorer(3)).count() == 0
    with pytest.raises(ValueError):
        scoring.score_batch(df, scoring.length_scorer(3), strict=True)
    assert scoring.score_one(spark, "hello you", None, scoring.length_scorer(3)).first().category == "0"
    for blank in ("", "  ", None):
        with pytest.raises(ValueError):
            scoring.score_one(spark, blank, None, scoring.length_scorer(3))


def test_names_are_one_per_id(spark, batch):
    """Two names for an id: the first in order. Ids far apart cost as much as their number."""
    df, _ = batch
    names = spark.createDataFrame([(0, "b"), (0, "a"), (2, "x"), (3_000_000, "far"), (None, "n"), (1, None)], "label int, label_text string")
    got = {r.category_id: r.category for r in scoring.score_batch(df, scoring.length_scorer(3), names).collect()}
    assert got == {k: {0: "a", 1: "1", 2: "x"}[k] for k in got}
    with pytest.raises(ValueError, match="names"):
        scoring.category_names(names, max_bytes=3)


def test_annotator_in_scoring(batch):
    df, names = batch

    def load():
        def annotator(text, language):
            if language == "sv":
                raise ValueError("no model")
            return [(text.split()[0], "ORG")] if text else []
        return annotator

    rows = {r.doc_id: r for r in scoring.score_batch(df, scoring.length_scorer(3), names, annotate=load).collect()}
    assert rows[2].error == "ValueError: no model" and rows[2].entities == [] and rows[2].category is not None
    assert rows[1].error is None and [e.text for e in rows[1].entities] == ["Stocks"] and "organization" in rows[1].tags


def test_benchmark(batch):
    df, names = batch
    got = scoring.benchmark(scoring.score_batch(df, scoring.length_scorer(3), names)).first()
    assert got.documents == 5 and got.docs_per_sec > 0


def python_prune(values, sparsity):
    a = np.asarray(values, dtype=np.float32)
    k = math.floor(sparsity * a.size)
    if k == 0:
        return a
    return np.where(np.abs(a) > np.sort(np.abs(a))[k - 1], a, np.float32(0))


@pytest.mark.parametrize("values, sparsity", [
    ([-1.0, 2.0, -3.0, 4.0], 0.5), ([1.0, 1.0, 1.0, 2.0], 0.25), ([0.0] * 5, 0.4), ([3.0, 1.0], 0.3), ([5.0], 0.0),
    (np.random.default_rng(0).normal(size=200).tolist(), 0.3),
])
def test_prune(spark, values, sparsity):
    df = spark.createDataFrame([("t", 2, values), ("bias", 1, values)], "tensor string, rank int, values array<float>")
    rows = {r.tensor: r["values"] for r in compression.prune_tensors(df, sparsity).collect()}
    want = python_prune(values, sparsity)
    assert np.array_equal(np.array(rows["t"], dtype=np.float32), want)
    assert np.array_equal(np.array(rows["bias"], dtype=np.float32), np.asarray(values, dtype=np.float32))
    entries = df.filter("rank = 2").select("tensor", F.posexplode("values").alias("idx", "w"))
    long = {r.idx: r.w for r in compression.prune_long(entries, sparsity).collect()}
    assert np.array_equal(np.array([long[i] for i in range(len(values))], dtype=np.float32), want)
    report = compression.prune_report(compression.prune_tensors(df, sparsity), sparsity).first()
    assert report.params_zeroed == int((want == 0).sum()) and report.tensors_pruned == 1


def test_sparsity_is_checked():
    for bad in (1.0, -0.1):
        with pytest.raises(ValueError):
            vx.check_sparsity(bad)


def test_half_precision_is_ieee(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([
        rng.normal(size=4000) * 10.0 ** rng.integers(-9, 6, 4000),
        [0.0, 65504, 65519.9, 65520, 1e9, 1e-8, 2.0**-24, 2.0**-25, 3 * 2.0**-25, 2.0**-14, 1 - 2.0**-12, 2048.5, 2049.0],
    ]).astype(np.float32)
    df = spark.createDataFrame([("t", 2, x.tolist())], "tensor string, rank int, values array<float>")
    once = compression.fp16_tensors(df)
    with np.errstate(over="ignore"):
        want = x.astype(np.float16).astype(np.float32)
    assert np.array_equal(np.array(once.first()["values"], dtype=np.float32), want)
    assert compression.fp16_tensors(once).first()["values"] == once.first()["values"]


def test_int8(spark):
    values = [[0.5, -1.27, 0.005, 0.015], [0.0, 0.0]]
    df = spark.createDataFrame([(str(i), 2, v) for i, v in enumerate(values)], "tensor string, rank int, values array<float>")
    rows = {r.tensor: r for r in compression.int8_tensors(df).collect()}
    for i, v in enumerate(values):
        a = np.asarray(v, dtype=np.float32).astype(np.float64)
        scale = np.abs(a).max() / 127
        want = np.rint(a / scale) if scale else np.zeros(len(a))
        assert rows[str(i)].codes == want.tolist()
    restored = compression.int8_tensors(df).withColumn("r", vx.int8_restore(F.col("codes"), F.col("scale")))
    assert {r.tensor: r.r for r in restored.collect()}["0"] == pytest.approx(values[0], abs=0.006)


def test_sizes_and_report(spark):
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(3, 16))
    rows = [(i, (centers[i % 3] + 0.1 * rng.normal(size=16)).tolist(), i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    weights = compression.centroid_weights(df)
    assert weights.count() == 3
    assert compression.artifact_size(weights.limit(0)).first().size_mb == 0.0
    got = {(r.variant, r.metric): r.value for r in compression_job.compression_report(weights, df, timed=True).collect()}
    assert got["original", "accuracy"] == 1.0 and got["fp16", "size_reduction_pct"] == 50.0
    assert got["int8", "size_reduction_pct"] == 75.0 and ("int8", "accuracy") not in got
    assert 0.2 <= got["pruned", "achieved_sparsity"] <= 0.35 and got["pruned", "docs_per_sec"] > 0
    path = fresh_dir(spark, "weights")
    weights.write.parquet(path)
    assert compression.stored_size(spark, path).first().size_mb >= 0.0
    assert compression.stored_size(spark, path + "-missing").first().size_mb == 0.0
    many = spark.range(25).select(F.lit("t").alias("tensor"), F.array_repeat(F.lit(1.0).cast("float"), 10_000).alias("values"))
    assert compression.artifact_size(many).first().size_mb == 1.0
