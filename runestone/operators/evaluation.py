"""Metrics of a scored table. Score once, then aggregate; every metric is a small
aggregation over (label, pred) counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runestone.operators.scaling import prefix_sums
from runestone.session import settle


def confusion_matrix(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def accuracy(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    return _accuracy_of(confusion_matrix(scored, label, pred))


def _accuracy_of(cells: DataFrame) -> DataFrame:
    hits = F.coalesce(F.sum(F.when(F.col("label") == F.col("pred"), F.col("n"))), F.lit(0))
    return cells.agg((hits / F.sum("n")).alias("accuracy"))


def macro_f1(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Unweighted mean F1 over every class that occurs as a label or a prediction; 0 / 0 is 0."""
    return _macro_f1_of(confusion_matrix(scored, label, pred))


def _macro_f1_of(cells: DataFrame) -> DataFrame:
    # Each cell counts once for its label and once for its prediction.
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("pred").alias("class"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("hit")),
    )
    per_class = cells.select(F.explode(sides).alias("s")).groupBy("s.class").agg(
        F.sum("s.actual").alias("actual"), F.sum("s.predicted").alias("predicted"), F.sum("s.hit").alias("hit")
    )
    # F1 = 2 hit / (actual + predicted), which is 0 when nothing was hit.
    return per_class.agg(
        F.avg(F.lit(2.0) * F.col("hit") / (F.col("actual") + F.col("predicted"))).alias("f1_macro")
    )


def per_language_accuracy(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    return scored.groupBy("language").agg(
        F.round(F.avg((F.col(label) == F.col(pred)).cast("int")), 4).alias("accuracy")
    )


def auc_by_class(scored: DataFrame, label: str = "label", probabilities: str = "probability") -> DataFrame:
    """One-vs-rest AUC of every class that has both members and others.

    Mann-Whitney on counts per (class, probability): a pair is won by the higher
    probability, ties count half. The running count of negatives comes from
    ``prefix_sums``, so no class is sorted in one task.
    """
    points = scored.select(label, F.posexplode(probabilities).alias("class", "p")).groupBy("class", "p").agg(
        F.count_if(F.col(label) == F.col("class")).alias("positives"),
        F.count_if(F.col(label) != F.col("class")).alias("negatives"),
    )
    ranked = prefix_sums(points, ["class"], ["p"], {"negatives_below": "negatives"})
    won = F.col("positives").cast("double") * (2.0 * F.col("negatives_below") + F.col("negatives"))
    return (
        ranked.groupBy("class")
        .agg(F.sum(won).alias("won"), F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
        .filter((F.col("p") > 0) & (F.col("n") > 0))
        .select("class", (F.col("won") / (2.0 * F.col("p") * F.col("n"))).alias("auc"))
    )


def macro_auc(scored: DataFrame, label: str = "label", probabilities: str = "probability",
              per_class: DataFrame | None = None) -> DataFrame:
    """Macro one-vs-rest AUC; NULL with two classes or when a class has no true label.

    ``per_class`` may hand in the result of ``auc_by_class``.
    """
    width = scored.agg(F.max(F.size(probabilities))).scalar()
    if per_class is None:
        per_class = auc_by_class(scored, label, probabilities)
    return per_class.agg(
        F.avg("auc").alias("mean"), F.count(F.lit(1)).alias("defined")
    ).select(
        F.when((F.col("defined") == width) & (F.col("defined") > 2), F.col("mean")).alias("auc")
    )


def evaluate(scored: DataFrame, label: str = "label", pred: str = "pred",
             probabilities: str | None = None) -> DataFrame:
    """One row: accuracy, f1_macro and, given probabilities, auc. The first two come
    from one count of the (label, pred) cells."""
    cells = settle(confusion_matrix(scored, label, pred))
    columns = [_accuracy_of(cells).scalar().alias("accuracy"), _macro_f1_of(cells).scalar().alias("f1_macro")]
    if probabilities:
        columns.append(macro_auc(scored, label, probabilities).scalar().alias("auc"))
    return scored.sparkSession.range(1).select(*columns)


def lift_over_baseline(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """Accuracy difference of two one-row metric tables, in points."""
    return model.sparkSession.range(1).select(
        model.select("accuracy").scalar().alias("accuracy"),
        baseline.select("accuracy").scalar().alias("baseline_accuracy"),
    ).withColumn("lift_points", F.round((F.col("accuracy") - F.col("baseline_accuracy")) * 100, 2))
