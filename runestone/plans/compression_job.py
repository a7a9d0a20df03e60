"""The compression sweep: original -> pruned -> half precision -> int8."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runestone import settings
from runestone.operators import compression as cx
from runestone.operators import training
from runestone.operators.sampling import eval_sample, stratified_split
from runestone.session import settle


def variants(weights: DataFrame, sparsity: float = settings.TARGET_SPARSITY,
             min_rank: int = settings.PRUNE_MIN_RANK) -> dict[str, DataFrame]:
    """Cumulative variants of one weight table."""
    pruned = cx.prune_tensors(weights, sparsity, min_rank)
    half = cx.fp16_tensors(pruned)
    restored = cx.int8_tensors(half)
    return {"original": weights, "pruned": pruned, "fp16": half, "int8": restored}


def _metrics(table: DataFrame, variant: str) -> DataFrame:
    """One-row metrics -> ``(variant, metric, value)``."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in table.columns
    ])
    return table.select(F.explode(entries).alias("m")).select(
        F.lit(variant).alias("variant"), "m.metric", "m.value"
    )


def compression_report(
    weights: DataFrame,
    examples: DataFrame,
    values: str = "embedding",
    label: str = "label",
    sparsity: float = settings.TARGET_SPARSITY,
    timed: bool = False,
) -> DataFrame:
    """``(variant, metric, value)``: size, reduction and, except for int8, accuracy and
    its drop after each step. ``timed`` adds documents per second."""
    tables = {name: settle(t) for name, t in variants(weights, sparsity).items()}
    original_size = tables["original"].agg(F.sum(F.size("values") * cx.BYTES["original"])).scalar()
    base = settle(cx.classifier_accuracy(tables["original"], examples, values, label))
    parts = []
    for name, table in tables.items():
        size = table.agg(F.sum(F.size("values") * cx.BYTES[name]).alias("size_bytes")).withColumn(
            "size_reduction_pct", F.round(100.0 * (1.0 - F.col("size_bytes") / original_size), 1)
        )
        parts.append(_metrics(size, name))
        if name == "int8":
            continue
        started = time.time()
        measured = settle(cx.classifier_accuracy(table, examples, values, label))
        seconds = max(1e-9, time.time() - started)
        measured = measured.withColumn("accuracy_drop", F.round(base.scalar() - F.col("accuracy"), 4))
        if timed:
            measured = measured.withColumn("docs_per_sec", F.round(F.lit(examples.count() / seconds), 1))
        parts.append(_metrics(measured, name))
    parts.append(_metrics(cx.prune_report(tables["pruned"], sparsity).select("achieved_sparsity"), "pruned"))
    return reduce(DataFrame.unionByName, parts)


def optimize(
    examples: DataFrame,
    eval_rows: int = settings.EVAL_SAMPLE,
    key: str = "vec_id",
    values: str = "embedding",
    label: str = "label",
    sparsity: float = settings.TARGET_SPARSITY,
    timed: bool = False,
) -> DataFrame:
    """The whole job: split, learn the weights on train, sweep over sampled validation rows."""
    split = settle(stratified_split(examples, label=label, key=key))
    weights = cx.centroid_weights(split.filter(F.col("split") == "train"), values, label)
    sample = settle(eval_sample(split.filter(F.col("split") == "val").drop("split"), eval_rows, key))
    return compression_report(weights, sample, values, label, sparsity, timed)


def compress_classifier(
    fitted: training.Fitted,
    validation: DataFrame,
    label: str = "label",
    text: str = "clean_text",
    sparsity: float = settings.TARGET_SPARSITY,
) -> tuple[DataFrame, dict[str, training.LinearText]]:
    """Compress a trained classifier and serve every variant.

    Returns ``(variant, metric, value)`` with size, reduction, accuracy, its drop and
    documents per second (prediction only), and the variants, each ready for ``linear_scorer``.
    """
    spark, parts = validation.sparkSession, training.linear_parts(fitted.model)
    rows = settle(validation.select(label, text))
    documents = rows.count()
    tables = variants(parts.table(spark), sparsity)
    served = {name: parts.with_weights(table) for name, table in tables.items()}
    whole, base, metrics = parts.weights.size * cx.BYTES["original"], None, []
    for name, model in served.items():
        size = model.weights.size * cx.BYTES[name]
        predicted = training.probability_prediction(training.linear_scorer(model)(rows.withColumnRenamed(text, "clean_text")))
        started = time.time()
        accuracy = predicted.agg(F.avg((F.col("pred") == F.col(label)).cast("double"))).first()[0] or 0.0
        seconds = max(1e-9, time.time() - started)
        base = accuracy if base is None else base
        found = {
            "size_bytes": float(size), "size_reduction_pct": round(100.0 * (1.0 - size / whole), 1), "accuracy": round(accuracy, 4),
            "accuracy_drop": round(base - accuracy, 4), "docs_per_sec": round(documents / seconds, 1),
        }
        metrics += [(name, metric, value) for metric, value in found.items()]
    return spark.createDataFrame(metrics, "variant string, metric string, value double"), served
