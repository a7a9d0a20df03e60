"""Live scoring, tag counts and monitoring with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from runestone import settings
from runestone.operators.tagging import tag_counts
from runestone.plans.scoring import Scorer, score_batch
from runestone.session import remove_dir


def document_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int = 1000
) -> DataFrame:
    """Documents from the Parquet files that arrive in a folder; ``path`` may be a glob."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def score_stream(documents: DataFrame, scorer: Scorer, partitions: int | None = None, **options) -> DataFrame:
    """The batch plan on a stream: every step is per document, so there is no state.

    ``profiles`` detect undeclared languages here too. ``partitions`` spreads
    micro-batches that arrive in fewer splits than there are cores.
    """
    return score_batch(documents.repartition(partitions) if partitions else documents, scorer, **options)


def stream_tag_counts(scored: DataFrame, keywords: bool = True) -> DataFrame:
    """Running tag counts. A new checkpoint clears the history.

    With keywords there is a state row per keyword that ever occurred; without them
    one per unified tag, a fixed set.
    """
    if not keywords:
        scored = scored.withColumn("keywords", F.array().cast("array<string>"))
    return tag_counts(scored)


def monitor(scored: DataFrame) -> DataFrame:
    """Running documents, mean confidence and low-confidence documents per language."""
    return scored.groupBy("language").agg(
        F.count(F.lit(1)).alias("documents"),
        F.avg("confidence").alias("mean_confidence"),
        F.count_if(F.col("confidence") < settings.LOW_CONFIDENCE).alias("low_confidence"),
    )


def append_to(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append scored documents to Parquet, exactly once."""
    return (
        scored.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def replace_at(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest complete tables of a running aggregation, one folder per batch.

    A batch that is run again overwrites its own folder only. The one before stays for
    readers that are at it, earlier ones are removed.
    """

    def write(table: DataFrame, batch: int) -> None:
        table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")
        remove_dir(table.sparkSession, f"{path.rstrip('/')}/batch={batch - 2}")

    return (
        counts.writeStream.outputMode("complete").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``replace_at`` wrote last; earlier folders are not read."""
    batches = spark.read.parquet(path)
    last = batches.select("batch").agg(F.max("batch")).first()[0]
    return batches.filter(F.col("batch") == last).drop("batch")


class ThroughputListener(StreamingQueryListener):
    """Collects rows and rows per second of every micro-batch."""

    def __init__(self) -> None:
        self.progress: list[tuple[int, int, float]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.progress.append((p.batchId, p.numInputRows, p.processedRowsPerSecond))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
