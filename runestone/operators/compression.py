"""Weight tables: ``(tensor STRING, rank INT, values ARRAY<FLOAT>)``, or long
``(tensor, idx, w)`` for tensors too large for a row."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions import vectors as vx
from runestone.operators.scaling import join_dimension
from runestone.session import settle

BYTES = {"original": 4, "pruned": 4, "fp16": 2, "int8": 1}
MB = 1_000_000


def prune_tensors(weights: DataFrame, sparsity: float = settings.TARGET_SPARSITY,
                  min_rank: int = settings.PRUNE_MIN_RANK) -> DataFrame:
    """Prune tensors of at least ``min_rank`` dimensions, keep the others as they are."""
    vx.check_sparsity(sparsity)
    return weights.withColumn(
        "values", F.when(F.col("rank") >= min_rank, vx.prune(F.col("values"), sparsity)).otherwise(F.col("values"))
    )


def prune_report(pruned: DataFrame, sparsity: float = settings.TARGET_SPARSITY,
                 min_rank: int = settings.PRUNE_MIN_RANK) -> DataFrame:
    """Totals over the pruned tensors; all zeros count."""
    return pruned.filter(F.col("rank") >= min_rank).agg(
        F.lit(float(sparsity)).alias("target_sparsity"),
        F.coalesce(F.sum(F.size("values").cast("long")), F.lit(0)).alias("params_total"),
        F.coalesce(F.sum(vx.zero_count(F.col("values")).cast("long")), F.lit(0)).alias("params_zeroed"),
        F.count(F.lit(1)).alias("tensors_pruned"),
    ).withColumn(
        "achieved_sparsity", F.round(F.col("params_zeroed") / F.greatest("params_total", F.lit(1)), 4)
    )


def prune_long(weights: DataFrame, sparsity: float = settings.TARGET_SPARSITY) -> DataFrame:
    """Prune ``(tensor, idx, w)`` rows; a tensor may hold any share of all weights.

    Weights are counted per tensor and magnitude bucket, 64 to an octave. Only the
    magnitudes of the bucket with the k-th smallest are then counted one by one (a
    bucket of 32-bit floats has at most 2 ** 18), and each weight is compared with
    the threshold found there. The weights themselves are not shuffled.
    """
    vx.check_sparsity(sparsity)
    magnitude = F.abs("w")
    # Monotone in the magnitude; zero lies below all others.
    bucket = F.when(magnitude == 0, F.lit(-1_000_000)).otherwise(F.floor(F.log2(magnitude.cast("double")) * 64)).cast("int")
    counts = settle(weights.groupBy("tensor", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
    running = counts.withColumn("through", F.sum("n").over(Window.partitionBy("tensor").orderBy("bucket"))).withColumn(
        "k", F.floor(F.lit(float(sparsity)) * F.sum("n").over(Window.partitionBy("tensor"))))
    edge = settle(
        running.filter((F.col("k") <= F.col("through")) & (F.col("k") > F.col("through") - F.col("n")))
        .select("tensor", "bucket", (F.col("k") - F.col("through") + F.col("n")).alias("nth"))
    )
    candidates = join_dimension(
        weights.select("tensor", "idx", bucket.alias("bucket"), magnitude.alias("magnitude")), edge, ["tensor", "bucket"], "inner",
        salt_by="idx", settled=True)
    exact = candidates.groupBy("tensor", "nth", "magnitude").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("tensor").orderBy("magnitude"))
    thresholds = (
        exact.withColumn("upto", upto).filter((F.col("nth") <= F.col("upto")) & (F.col("nth") > F.col("upto") - F.col("n")))
        .select("tensor", F.col("magnitude").alias("threshold"))
    )
    joined = join_dimension(weights, thresholds, ["tensor"], "left", salt_by="idx")
    kept = F.col("threshold").isNull() | (F.abs("w") > F.col("threshold"))
    return joined.select("tensor", "idx", F.when(kept, F.col("w")).otherwise(F.lit(0.0).cast("float")).alias("w"))


def fp16_tensors(weights: DataFrame) -> DataFrame:
    return weights.withColumn("values", vx.half_precision(F.col("values")))


def int8_tensors(weights: DataFrame) -> DataFrame:
    """Add ``scale`` and ``codes``."""
    return weights.withColumn("scale", vx.int8_scale(F.col("values"))).withColumn(
        "codes", vx.int8_codes(F.col("values"), F.col("scale"))
    )


def artifact_size(weights: DataFrame, bytes_per_value: int = 4) -> DataFrame:
    """Parameters and size in MB; 0.0 for an empty table."""
    return weights.agg(F.coalesce(F.sum(F.size("values").cast("long")), F.lit(0)).alias("params")).withColumn(
        "size_mb", F.round(F.col("params") * bytes_per_value / float(MB), 2)
    )


def stored_size(spark, path: str) -> DataFrame:
    """Size of the files below ``path`` in MB, without reading their content; 0.0 for a missing path."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "length long")
    return files.agg(F.round(F.coalesce(F.sum("length"), F.lit(0)) / float(MB), 2).alias("size_mb"))


def centroid_weights(examples: DataFrame, values: str = "embedding", label: str = "label") -> DataFrame:
    """A linear classifier as a weight table: the mean vector of each label."""
    means = (
        examples.select(label, F.posexplode(values).alias("at", "x"))
        .groupBy(label, "at").agg(F.avg(F.col("x").cast("double")).alias("mean"))
        .groupBy(label).agg(F.array_sort(F.collect_list(F.struct("at", "mean"))).alias("entries"))
    )
    return means.select(
        F.col(label).cast("string").alias("tensor"), F.lit(2).alias("rank"),
        F.transform("entries", lambda e: e["mean"].cast("float")).alias("values"),
    )


def _nearest(vector: Column, classes: Column) -> Column:
    """Label of the class vector with the largest dot product, the lowest on a tie."""
    scores = F.transform(classes, lambda c: F.struct(
        (-F.aggregate(
            F.zip_with(c["values"], vector, lambda w, x: w.cast("double") * x.cast("double")),
            F.lit(0.0), lambda acc, x: acc + x,
        )).alias("cost"), c["tensor"].alias("tensor")))
    return F.array_min(scores)["tensor"]


def classifier_accuracy(weights: DataFrame, examples: DataFrame, values: str = "embedding",
                        label: str = "label") -> DataFrame:
    """Accuracy of the weight table as a classifier of ``examples``, in one pass over them.

    The class vectors go to every task, so their bytes are measured and bounded.
    """
    packed = settle(weights.select("tensor", "values"))
    size = packed.agg(F.sum(F.octet_length("tensor") + 4 * F.size("values"))).first()[0] or 0
    if size > settings.VECTORS_MAX_BYTES:
        raise ValueError(f"{size} bytes of class vectors, more than {settings.VECTORS_MAX_BYTES}")
    classes = packed.agg(F.array_sort(F.collect_list(F.struct("tensor", "values")))).scalar()
    hit = _nearest(F.col(values), F.col("_classes")) == F.col(label).cast("string")
    return examples.select(values, label, classes.alias("_classes")).agg(F.round(F.avg(hit.cast("int")), 4).alias("accuracy"))
