"""Exact, seeded, row-reproducible samples, splits and folds.

The order is the md5 of (seed, key), so the same rows come out on any cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runestone import settings
from runestone.operators.scaling import (
    PREFIX, below_cutoff, hash_cutoffs, join_dimension, sampling_digest,
)

_CUT = ["_cut_digest", "_cut_key", "_size"]


def _smallest_per_group(df: DataFrame, group: str, key: str, seed: int, n: int) -> DataFrame:
    return _chosen(df, hash_cutoffs(df, group, key, seed, n), group, key, seed)


def _chosen(df: DataFrame, cuts: DataFrame, group: str, key: str, seed: int) -> DataFrame:
    joined = join_dimension(df, cuts, [group], "inner", salt_by=key)
    return joined.filter(below_cutoff(key, seed)).select(*df.columns)


def stratified_sample(
    df: DataFrame,
    sample_size: int | None,
    label: str = "label_text",
    key: str = "doc_id",
    seed: int = settings.SEED,
    on_small: str = "raise",
) -> DataFrame:
    """The same number of rows of every class, about ``sample_size`` in all.

    Everything is returned when the sample would not be smaller than the input. A
    class with too few rows raises, or with ``on_small='take_all'`` is kept whole.
    """
    if on_small not in ("raise", "take_all"):
        raise ValueError("on_small must be 'raise' or 'take_all'")
    if sample_size is None:
        return df
    sizes = df.groupBy(label).count().agg(
        F.sum("count").alias("rows"), F.count(F.lit(1)).alias("classes"), F.min("count").alias("smallest")
    ).first()
    if sizes.rows is None or sample_size >= sizes.rows:
        return df
    per_class = max(1, sample_size // max(1, sizes.classes))
    if sizes.smallest < per_class and on_small == "raise":
        raise ValueError(f"a class has {sizes.smallest} rows, fewer than the {per_class} asked for")
    return _smallest_per_group(df, label, key, seed, per_class)


def demo_sample(
    df: DataFrame,
    rows: int = settings.DEMO_ROWS_PER_LANGUAGE,
    key: str = "doc_id",
    seed: int = settings.SEED,
) -> DataFrame:
    """At most ``rows`` random documents of each language."""
    return _smallest_per_group(df, "language", key, seed, rows)


def stratified_split(
    df: DataFrame,
    test_size: float = settings.TEST_SIZE,
    label: str = "label",
    key: str = "doc_id",
    seed: int = settings.SEED,
) -> DataFrame:
    """Add ``split`` = 'train' / 'val' with round(n * test_size) validation rows per
    label. The rows are not shuffled: each is compared with its label's cut-off."""
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must be in (0, 1)")
    cuts = hash_cutoffs(df, label, key, seed, lambda n: F.round(n * F.lit(test_size)).cast("long"))
    joined = join_dimension(df, cuts, [label], "left", salt_by=key)
    return joined.withColumn(
        "split", F.when(below_cutoff(key, seed), F.lit("val")).otherwise(F.lit("train"))
    ).drop(*_CUT)


def eval_sample(df: DataFrame, n: int = settings.EVAL_SAMPLE, key: str = "doc_id",
                seed: int = settings.SEED) -> DataFrame:
    """``n`` random rows.

    The cut-off is found from digests alone. A sort with a limit would instead send
    n whole documents of every input split to one task.
    """
    cuts = hash_cutoffs(df.select(F.lit(0).alias("_all"), key), "_all", key, seed, n)
    return _chosen(df.withColumn("_all", F.lit(0)), cuts, "_all", key, seed).drop("_all")


def assign_folds(
    df: DataFrame,
    k: int = 3,
    label: str = "label",
    key: str = "doc_id",
    seed: int = settings.SEED,
) -> DataFrame:
    """``(key, label, fold)``: rank of the row in its label's seeded order, modulo k.

    The rank is the count of earlier digest prefixes plus the rank inside the
    prefix, so a label is never gathered in one task.
    """
    if k < 2:
        raise ValueError("k must be at least 2")
    keyed = df.select(key, label, sampling_digest(key, seed).alias("_digest")).withColumn(
        "_prefix", F.substring("_digest", 1, PREFIX)
    )
    earlier = (
        keyed.groupBy(label, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_earlier", F.sum("_n").over(
            Window.partitionBy(label).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)))
        .select(label, "_prefix", F.coalesce("_earlier", F.lit(0)).alias("_earlier"))
    )
    inside = Window.partitionBy(label, "_prefix").orderBy("_digest", key)
    ranked = keyed.withColumn("_rank", F.row_number().over(inside)).join(earlier, [label, "_prefix"])
    return ranked.select(
        key, label, F.pmod(F.col("_earlier") + F.col("_rank") - 1, F.lit(k)).cast("int").alias("fold")
    )
