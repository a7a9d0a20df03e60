"""The training job: clean and split -> baseline and challenger -> report."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runestone import settings
from runestone.operators import evaluation, training
from runestone.operators.cleaning import clean_and_drop
from runestone.operators.sampling import eval_sample, stratified_split
from runestone.session import settle
from runestone.sources.tables import write_csv, write_report


def clean_split(
    corpus: DataFrame,
    test_size: float = settings.TEST_SIZE,
    seed: int = settings.SEED,
    label: str = "label",
    key: str = "doc_id",
    passes: int = 1,
) -> DataFrame:
    """Cleaned documents with ``clean_text`` and ``split``.

    The clean rows are written once: the cut-offs of the split look at the rows that
    are left after cleaning, and would otherwise clean them again on every pass.
    """
    return stratified_split(settle(clean_and_drop(corpus, passes=passes)), test_size, label, key, seed)


def train_report(
    split: DataFrame,
    path: str,
    text: str = "clean_text",
    label: str = "label",
    key: str = "doc_id",
    challenger_candidates: Sequence[dict] = ({"c": 1.0},),
    **baseline_options,
) -> dict[str, DataFrame]:
    """The whole training job on a corpus with a ``split`` column.

    Returns the report row, the example predictions, the loss history and the
    scored validation rows. Each model scores validation once; all metrics, the
    per-language ones included, come from that table.
    """
    spark = split.sparkSession
    columns = [key, "text", text, label, "language"]
    train = split.filter(F.col("split") == "train").select(*columns)
    validation = split.filter(F.col("split") == "val").select(*columns)

    baseline = training.train_baseline(train, label, text, key, **baseline_options)
    base = settle(training.score(baseline.model, validation, [label]))
    chosen, candidates = training.select_model(
        train, validation, list(challenger_candidates), path,
        fit=lambda data, label, **p: training.train_challenger(data, label, text, key, **p), label=label,
    )
    started = time.time()
    scored = settle(training.score(chosen, validation, [key, "text", label, "language"]))
    seconds = max(1e-9, time.time() - started)
    chosen_metrics, base_metrics = evaluation.evaluate(scored, label), evaluation.evaluate(base, label)
    languages = evaluation.per_language_accuracy(scored, label)
    report = spark.range(1).select(
        F.round(chosen_metrics.select("accuracy").scalar(), 4).alias("classification_accuracy"),
        F.round(chosen_metrics.select("f1_macro").scalar(), 4).alias("f1_score_macro"),
        F.round(F.lit(scored.count() / seconds), 1).alias("processing_speed_docs_per_sec"),
        languages.agg(F.array_sort(F.collect_set("language"))).scalar().alias("languages_supported"),
        languages.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "accuracy")))))
        .scalar().alias("per_language_accuracy"),
        F.round(base_metrics.select("accuracy").scalar(), 4).alias("baseline_accuracy"),
        F.round(base_metrics.select("f1_macro").scalar(), 4).alias("baseline_f1_macro"),
    )
    return {
        "report": report,
        "candidates": candidates,
        "history": baseline.history(spark),
        "scored": scored,
        "examples": example_predictions(scored, label=label, key=key),
    }


def example_predictions(scored: DataFrame, n: int = settings.EXAMPLE_PREDICTIONS, label: str = "label",
                        key: str = "doc_id", seed: int = settings.SEED) -> DataFrame:
    return eval_sample(scored, n, key, seed).select(
        key, "text", F.col(label).alias("label"), F.col("pred").alias("predicted_label"), "language"
    )


def write_artifacts(parts: dict[str, DataFrame], folder: str) -> None:
    """The report as JSON, the example predictions and the loss history as CSV."""
    write_report(parts["report"], f"{folder}/performance_metrics")
    write_csv(parts["examples"].drop("doc_id"), f"{folder}/example_predictions")
    write_csv(parts["history"], f"{folder}/training_history")
