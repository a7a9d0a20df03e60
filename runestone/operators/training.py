"""Classifiers as Spark ML pipelines."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, HashingTF, NGram, Normalizer, RegexTokenizer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions.arrays import argmax
from runestone.functions.tokens import TOKEN
from runestone.operators import counts, evaluation, regression
from runestone.operators.features import class_weights, tfidf_weights, vocabulary_of
from runestone.operators.sampling import assign_folds
from runestone.operators.scaling import join_dimension
from runestone.session import scratch, settle

WEIGHT = "_weight"


@dataclass(frozen=True)
class Fitted:
    """A pipeline and the loss after each iteration."""

    model: PipelineModel
    losses: list[float]

    def history(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(i, float(loss)) for i, loss in enumerate(self.losses)], "iteration int, loss double"
        )


def balanced(df: DataFrame, label: str = "label", key: str = "doc_id") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(WEIGHT))
    return join_dimension(df, weights, [label], "left", salt_by=key)


def _checked(df: DataFrame, label: str, text: str) -> DataFrame:
    if df is None:
        raise ValueError("training data is missing")
    for column in (label, text):
        if column not in df.columns:
            raise KeyError(f"training data has no column {column!r}")
    return df


def train_baseline(
    train: DataFrame,
    label: str = "label",
    text: str = "clean_text",
    key: str = "doc_id",
    max_features: int = settings.MAX_FEATURES,
    c: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-4,
) -> Fitted:
    """TF-IDF over word tokens and a balanced multinomial logistic regression."""
    _checked(train, label, text)
    with scratch(train.sparkSession):
        rows = balanced(train.select(key, label, text), label, key)
        totals = regression.class_totals(rows, label, WEIGHT)
        # Texts are cut into words once, for the vocabulary and for the rows.
        counted = settle(counts.term_blocks(rows, text, label, WEIGHT))
        # At most max_features rows: the vocabulary is part of the model.
        vocabulary = vocabulary_of(counted, max_features).orderBy(F.desc("term_count"), "term").collect()
        if not vocabulary:
            raise ValueError("no terms to learn from")
        terms, idf = [r.term for r in vocabulary], np.array([r.idf for r in vocabulary])
        model, losses = regression.fit_blocks(regression.normalized(counted, idf, terms), totals, idf, c, max_iter, tol)
    return Fitted(PipelineModel([
        RegexTokenizer(inputCol=text, outputCol="terms", pattern=TOKEN, gaps=False, toLowercase=True),
        CountVectorizerModel.from_vocabulary(terms, "terms", "counts"),
        ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="counts", outputCol="raw"),
        Normalizer(p=2.0, inputCol="raw", outputCol="features"),
        model,
    ]), losses)


def train_challenger(
    train: DataFrame,
    label: str = "label",
    text: str = "clean_text",
    key: str = "doc_id",
    word_buckets: int = 1 << 15,
    char_buckets: int = 1 << 13,
    c: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-4,
) -> Fitted:
    """Hashed words and character 3-grams: no vocabulary to collect, and the shape of
    unseen words still counts."""
    _checked(train, label, text)
    words = RegexTokenizer(inputCol=text, outputCol="terms", pattern=TOKEN, gaps=False, toLowercase=True)
    chars = RegexTokenizer(inputCol=text, outputCol="chars", pattern="(?s).", gaps=False, toLowercase=True)
    hashing = [
        words, chars, NGram(n=3, inputCol="chars", outputCol="grams"),
        HashingTF(numFeatures=word_buckets, inputCol="terms", outputCol="word_counts"),
        HashingTF(numFeatures=char_buckets, inputCol="grams", outputCol="gram_counts"),
        VectorAssembler(inputCols=["word_counts", "gram_counts"], outputCol="counts"),
    ]
    with scratch(train.sparkSession):
        rows = balanced(train.select(key, label, text), label, key)
        totals = regression.class_totals(rows, label, WEIGHT)
        # What the stages count is counted once, for the idf and for the rows.
        counted = settle(counts.hashed_blocks(rows, text, label, WEIGHT, word_buckets, char_buckets))
        found = counts.doc_counts(counted, word_buckets + char_buckets)
        idf = np.log((sum(n for _, n in totals.values()) + 1.0) / (found + 1.0))
        model, losses = regression.fit_blocks(regression.normalized(counted, idf), totals, idf, c, max_iter, tol)
    return Fitted(PipelineModel([
        *hashing, ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="counts", outputCol="raw"),
        Normalizer(p=2.0, inputCol="raw", outputCol="features"), model,
    ]), losses)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``pred INT`` and ``probability ARRAY<DOUBLE>``."""
    kept = list(keep) if keep is not None else df.columns
    return model.transform(df).select(
        *kept, F.col("prediction").cast("int").alias("pred"), vector_to_array("probability").alias("probability")
    )


@dataclass(frozen=True)
class LinearText:
    """What a fitted baseline consists of: terms, their idf, and per class weights and an intercept."""

    terms: list[str]
    idf: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray

    def table(self, spark) -> DataFrame:
        """The weights as a weight table, one tensor per class; bounded by classes and vocabulary."""
        rows = [(str(c), 2, [float(x) for x in line]) for c, line in enumerate(self.weights)]
        return spark.createDataFrame(rows, "tensor string, rank int, values array<float>")

    def with_weights(self, table: DataFrame) -> LinearText:
        """The same model with the weights of a variant's table; int8 codes are multiplied out."""
        coded = "codes" in table.columns
        rows = {int(r.tensor): np.array(r.codes, "float64") * r.scale if coded else np.array(r["values"], "float64")
                for r in table.collect()}
        return replace(self, weights=np.stack([rows[c] for c in range(len(self.weights))]))


def linear_parts(model: PipelineModel) -> LinearText:
    """Take a pipeline of ``train_baseline`` apart."""
    _, counter, scaling, _, regression = model.stages
    return LinearText(
        list(counter.vocabulary), scaling.getScalingVec().toArray(), regression.coefficientMatrix.toArray(),
        regression.interceptVector.toArray())


def linear_probabilities(df: DataFrame, parts: LinearText, text: str = "clean_text", into: str = "probability") -> DataFrame:
    """Add the model's probabilities without Spark ML: variants are served this way, in batches and on streams."""
    shared = df.sparkSession.sparkContext.broadcast(
        (pa.array(parts.terms, pa.string()), parts.idf, parts.weights, parts.intercepts))
    kinds = counts.shared_kinds(df.sparkSession)

    @F.arrow_udf("array<double>")
    def probabilities(batch: pa.Array) -> pa.Array:
        known, idf, weights, intercepts = shared.value

        def documents(texts: pa.Array) -> pa.Array:
            terms, rows, numbers, found = counts.word_counts(texts, kinds.value)
            at = regression.places_of(terms, known)[numbers]
            kept = at >= 0
            rows, at = rows[kept], at[kept]
            raw = found[kept] * idf[at]
            norms = np.sqrt(regression.row_sums(rows, raw * raw, len(texts)))
            raw = raw / norms[rows]
            scores = np.stack([regression.row_sums(rows, raw * line[at], len(texts)) for line in weights], axis=1) + intercepts
            e = np.exp(scores - scores.max(axis=1, keepdims=True))
            e /= e.sum(axis=1, keepdims=True)
            ends = np.arange(len(texts) + 1) * len(weights)
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(e.ravel()))

        return counts.text_by_text(documents, batch)

    return df.withColumn(into, probabilities(F.lower(F.col(text))))


def linear_scorer(parts: LinearText) -> Callable[[DataFrame], DataFrame]:
    """A scorer for ``score_batch``."""
    return lambda df: linear_probabilities(df, parts)


def largest_gradient(fitted: Fitted, train: DataFrame, label: str = "label", text: str = "clean_text",
                     key: str = "doc_id", c: float = 1.0) -> float:
    """The largest entry of the objective's gradient at the fitted weights: near 0 after convergence.

    Computed from the TF-IDF table and the weights, apart from the optimizer.
    """
    spark, parts = train.sparkSession, linear_parts(fitted.model)
    vocabulary = spark.createDataFrame([(t, float(x)) for t, x in zip(parts.terms, parts.idf)], "term string, idf double")
    scored = linear_probabilities(balanced(train.select(key, label, text), label, key), parts, text, "_chances")
    rows = settle(scored.withColumn("_errors", F.transform("_chances", lambda p, i: (
        F.col(WEIGHT) * (p - (F.col(label) == i).cast("double"))))).select(key, text, "_errors", WEIGHT))
    total, n = rows.agg(F.sum(WEIGHT), F.count(F.lit(1))).first()
    # A document's errors stay beside its terms: what is shuffled are sums of the tasks, a row per class and term.
    weighed = tfidf_weights(rows, vocabulary, text, key, keep=["_errors"])
    by_term = weighed.select("term", "weight", F.posexplode("_errors").alias("class", "error")).groupBy("term", "class").agg(
        F.sum(F.col("weight") * F.col("error") / total).alias("g")).collect()
    gradient = parts.weights / (c * n)
    places = {t: i for i, t in enumerate(parts.terms)}
    for row in by_term:  # at most classes x vocabulary
        gradient[row["class"], places[row.term]] += row.g
    intercepts = rows.select(F.posexplode("_errors").alias("class", "error")).groupBy("class").agg(
        F.sum(F.col("error") / total).alias("g")).collect()
    return float(max(np.abs(gradient).max(), *(abs(r.g) for r in intercepts)))


def log_loss(model: PipelineModel, df: DataFrame, label: str = "label") -> float:
    """Validation log-loss."""
    return MulticlassClassificationEvaluator(
        metricName="logLoss", labelCol=label, predictionCol="prediction", probabilityCol="probability"
    ).evaluate(model.transform(df))


def select_model(
    train: DataFrame,
    validation: DataFrame,
    candidates: Sequence[dict],
    path: str,
    fit: Callable[..., Fitted] = train_baseline,
    label: str = "label",
) -> tuple[PipelineModel, DataFrame]:
    """Fit every candidate, save the one with the lowest validation loss, report all.

    The saved model is the one returned, so later metrics belong to what is served.
    """
    if not candidates:
        raise ValueError("at least one candidate is needed")
    spark = train.sparkSession
    tried = []
    for i, parameters in enumerate(candidates):
        fitted = fit(train, label=label, **parameters)
        tried.append((log_loss(fitted.model, validation, label), i, fitted.model))
    best_loss, best, model = min(tried, key=lambda t: t[:2])
    model.write().overwrite().save(path)
    report = spark.createDataFrame(
        [(i, str(candidates[i]), float(loss), i == best) for loss, i, _ in tried],
        "candidate int, parameters string, val_loss double, kept boolean",
    )
    return load_model(path), report


def load_model(path: str, variant: str | None = None) -> PipelineModel:
    """A saved pipeline, optionally one of several variants below ``path``."""
    return PipelineModel.load(f"{path.rstrip('/')}/{variant}" if variant else path)


def plugin_probabilities(
    load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = settings.SCORING_BATCH
) -> Callable[[Column], Column]:
    """An external model as a function on columns, ``string -> array<double>``.

    ``load()`` runs once per task and returns ``predict(texts) -> (n, classes)``,
    called on at most ``batch`` texts at a time. The result is a column of the same
    row, so scoring needs no join.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for texts in batches:
            rows: list[np.ndarray] = []
            for start in range(0, len(texts), batch):
                part = texts.iloc[start:start + batch].fillna("").tolist()
                rows.extend(np.asarray(predict(part), dtype="float64"))
            yield pd.Series(rows, index=texts.index, dtype="object")

    # The mark keeps the optimizer from calling the model twice for one row.
    udf = F.pandas_udf(run, "array<double>").asNondeterministic()
    return lambda text: udf(text)


def score_plugin(df: DataFrame, load: Callable, text: str = "clean_text", batch: int = settings.SCORING_BATCH) -> DataFrame:
    """Add ``probability`` from an external model."""
    return df.withColumn("probability", plugin_probabilities(load, batch)(F.col(text)))


def cross_validate(
    df: DataFrame,
    k: int = 3,
    label: str = "label",
    text: str = "clean_text",
    key: str = "doc_id",
    fit: Callable[..., Fitted] = train_baseline,
    **options,
) -> DataFrame:
    """Out-of-fold macro-F1 and accuracy: ``(fold, accuracy, f1_macro)``, stratified folds."""
    folds = settle(assign_folds(df, k, label, key).select(key, "fold"))
    # Both sides are keyed by the unique document id: no hot key.
    folded = settle(df.select(key, label, text).join(folds.hint("shuffle_hash"), key))
    rows = []
    for fold in range(k):
        fitted = fit(folded.filter(F.col("fold") != fold), label=label, text=text, key=key, **options)
        scored = settle(score(fitted.model, folded.filter(F.col("fold") == fold), [label]))
        metrics = evaluation.evaluate(scored, label).first()
        rows.append((fold, metrics.accuracy, metrics.f1_macro))
    return df.sparkSession.createDataFrame(rows, "fold int, accuracy double, f1_macro double")


def probability_prediction(df: DataFrame, probability: str = "probability") -> DataFrame:
    return df.withColumn("pred", argmax(F.col(probability)))
