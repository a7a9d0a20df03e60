"""A stream gives what the batch gives, also over two drops of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from runestone.operators.tagging import tag_counts
from runestone.plans.scoring import length_scorer, score_batch
from runestone.session import fresh_dir
from runestone.streaming import live

SCHEMA = "doc_id long, text string, language string"


def documents(spark, start, n):
    return spark.range(start, start + n).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("Alpha Beta wrote about market number "), F.col("id").cast("string"), F.lit(" <b>daily</b>"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int"))).alias("text"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("sv").alias("language"),
    )


def test_stream_equals_batch(spark):
    source, out, progress = (fresh_dir(spark, p) for p in ("in", "out", "progress"))
    tags, tags_progress = fresh_dir(spark, "tags"), fresh_dir(spark, "progress")
    watch, watch_progress = fresh_dir(spark, "monitor"), fresh_dir(spark, "progress")
    listener = live.ThroughputListener()
    spark.streams.addListener(listener)
    try:
        for start, n in ((0, 30), (30, 20)):
            documents(spark, start, n).write.mode("append").parquet(source)
            arrived = live.document_stream(spark, source, SCHEMA)
            scored = live.score_stream(arrived, length_scorer(3))
            live.append_to(scored, out, progress).awaitTermination()
            live.replace_at(live.stream_tag_counts(scored), tags, tags_progress).awaitTermination()
            live.replace_at(live.monitor(scored), watch, watch_progress).awaitTermination()
    finally:
        spark.streams.removeListener(listener)
    batch = score_batch(documents(spark, 0, 50), length_scorer(3))
    streamed = spark.read.parquet(out)
    assert sorted(map(str, streamed.select(batch.columns).collect())) == sorted(map(str, batch.collect()))
    assert {r.tag: r.n for r in live.latest_table(spark, tags).collect()} == {r.tag: r.n for r in tag_counts(batch).collect()}
    monitored = {r.language: (r.documents, round(r.mean_confidence, 6), r.low_confidence)
                 for r in live.latest_table(spark, watch).collect()}
    want = {r.language: (r.n, round(r.mean, 6), r.low) for r in batch.groupBy("language").agg(
        F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("mean"), F.count_if("low_confidence").alias("low")).collect()}
    assert monitored == want and 0 < sum(low for _, _, low in want.values()) < 50
    assert sum(rows for _, rows, _ in listener.progress) >= 50
