"""Scans and sinks of corpora and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORPUS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("label_text", T.StringType()),
    T.StructField("language", T.StringType()),
])


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of an input with fewer splits than cores.

    A table of any size has more splits than cores and is returned as it is, so
    this adds no shuffle at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def scan_split(spark: SparkSession, root: str, subset: str | None = None, split: str | None = None) -> DataFrame:
    """Scan a dataset laid out as ``subset=…/split=…`` folders; unread folders are pruned."""
    df = spark.read.parquet(root)
    if subset is not None:
        df = df.filter(F.col("subset") == subset)
    if split is not None:
        df = df.filter(F.col("split") == split)
    return df


def scan_splits(spark: SparkSession, root: str, subset: str, splits: Sequence[str]) -> DataFrame:
    """Bag union of several splits of one subset."""
    if not splits:
        raise ValueError("at least one split is needed")
    return reduce(DataFrame.unionByName, [scan_split(spark, root, subset, s) for s in splits])


def scan_csv(spark: SparkSession, path: str, schema: T.StructType = CORPUS_SCHEMA) -> DataFrame:
    """UTF-8 CSV with a header and quoted line breaks. A missing path raises."""
    return (
        spark.read.schema(schema)
        .option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"')
        # An empty quoted string stays empty; only an empty unquoted field is NULL.
        .option("emptyValue", "").option("nullValue", "\u0000")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("lineSep", "\n").option("maxCharsPerColumn", -1)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    (
        df.write.mode(mode)
        .option("header", True).option("quote", '"').option("escape", '"')
        .option("quoteAll", True).option("emptyValue", "").option("nullValue", "\u0000")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("lineSep", "\n")
        .csv(path)
    )


def write_corpus(corpus: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Corpus sink: Parquet, one folder per language so a language filter prunes files.

    No shuffle goes before it: each task writes its own file per language, and
    a hot language is written by all the tasks that hold it.
    """
    corpus.write.mode(mode).partitionBy("language").parquet(path)


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Metrics sink (JSON)."""
    report.write.mode(mode).json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame | None:
    """Metrics read-back; None where none was written."""
    try:
        return spark.read.json(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def label_dimension(corpus: DataFrame) -> DataFrame:
    """Distinct (label, label_text): only those two columns are scanned."""
    return corpus.select("label", "label_text").distinct()
