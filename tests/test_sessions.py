"""Session histories with clears, and bounded summaries of frequent tags, over several batches."""

from __future__ import annotations

import os
import random
import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from runestone.session import fresh_dir
from runestone.streaming import live, sessions

EVENTS = "session string, at timestamp, tags array<string>, clear boolean"
START = datetime(2024, 1, 1)


def play(spark, drops, **options):
    """One stream, started again for every drop of files."""
    source, out, progress = (fresh_dir(spark, p) for p in ("in", "out", "progress"))
    for rows in drops:
        spark.createDataFrame(rows, EVENTS).coalesce(2).write.mode("append").parquet(source)
        arrived = spark.readStream.schema(EVENTS).parquet(source)
        live.append_to(sessions.session_history(arrived, "session", "at", "tags", "clear", **options), out, progress).awaitTermination()
    rows = sessions.newest(spark.read.parquet(out), "session").collect()
    return {s: {r.tag: r.n for r in rows if r.session == s and r.tag is not None} for s in {r.session for r in rows}}


def at(minute):
    return START + timedelta(minutes=minute)


def test_two_sessions_one_cleared(spark):
    drops = [
        [("a", at(1), ["x", "y"], False), ("b", at(1), ["x"], False), ("a", at(2), ["x"], None), (None, at(1), ["x"], False), ("b", None, ["x"], False)],
        [("a", at(3), ["gone"], True), ("b", at(4), ["z", None], False), ("b", at(5), None, False)],
        [("a", at(2), ["late"], False), ("a", at(9), ["x"], False)],  # an occurrence before the clear arrives after it
    ]
    assert play(spark, drops) == {"a": {"x": 1}, "b": {"x": 1, "z": 1}}
    assert play(spark, drops[:2]) == {"a": {}, "b": {"x": 1, "z": 1}}


def test_late_and_folded(spark):
    hour = timedelta(hours=1)
    drops = [
        [("a", at(0), ["old"], False), ("a", at(200), ["new"], False)],
        [("a", at(150), ["in time"], False), ("a", at(100), ["too late"], False), ("a", at(120), [], True)],  # the clear is too late as well
        [("a", at(201), ["more"], False)],
    ]
    assert play(spark, drops, lateness=hour) == {"a": {"old": 1, "new": 1, "in time": 1, "more": 1}}
    # A clear in time takes what was folded, and leaves what is later.
    assert play(spark, [*drops, [("a", at(160), [], True)]], lateness=hour) == {"a": {"new": 1, "more": 1}}


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_events(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("abc"), at(rng.randrange(500)), [rng.choice("uvw") for _ in range(rng.randrange(3))], rng.random() < 0.03) for _ in range(200)]
    want = {}
    for s in {r[0] for r in rows}:
        last = max([r[1] for r in rows if r[0] == s and r[3]], default=datetime.min)
        want[s] = dict(Counter(t for r in rows if r[0] == s and r[1] > last for t in r[2]))
    rng.shuffle(rows)
    assert play(spark, [rows[:90], rows[90:]], lateness=timedelta(days=9)) == want


def test_frequent_tags(spark):
    rng = random.Random(1)
    drops = [[("hot",)] * 700 + [(f"t{int(rng.paretovariate(0.7))}",) for _ in range(1500)] for _ in range(3)]
    source, out, progress = (fresh_dir(spark, p) for p in ("in", "out", "progress"))
    size = 20
    for rows in drops:
        spark.createDataFrame([*rows, (None,)], "tag string").repartition(3).write.mode("append").parquet(source)
        arrived = spark.readStream.schema("tag string").parquet(source)
        live.append_to(sessions.frequent_tags(arrived, size=size, parts=2), out, progress).awaitTermination()
    summaries = spark.read.parquet(out)
    found = {r.tag: (r.at_least, r.at_most) for r in sessions.frequent_counts(summaries).collect()}
    true = Counter(t for rows in drops for (t,) in rows)
    total = sum(true.values())
    assert all(found[t][0] <= true[t] <= found[t][1] for t in found)
    assert all(t in found for t, n in true.items() if n > total / (size + 1)) and "hot" in found
    assert all(high - low <= total / (size + 1) for low, high in found.values())
    assert summaries.filter("tag IS NOT NULL").groupBy("part", "version").count().agg(F.max("count")).first()[0] <= size
    assert sessions.newest(summaries, "part").filter("tag IS NULL").agg(F.sum("total")).first()[0] == total


def test_resting_sessions_are_forgotten(spark):
    source, out = fresh_dir(spark, "in"), fresh_dir(spark, "out")

    def drop(session, tag):
        spark.createDataFrame([(session, at(1), [tag], False)], EVENTS).coalesce(1).write.mode("append").parquet(source)

    drop("a", "x")
    arrived = spark.readStream.schema(EVENTS).parquet(source)
    history = sessions.session_history(arrived, "session", "at", "tags", "clear", ttl=timedelta(seconds=2))
    stream = history.writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_dir(spark, "progress")).trigger(
        processingTime="1 second").start()

    def wait_for(rows):
        for _ in range(90):
            time.sleep(1)
            if os.path.isdir(f"{out}/_spark_metadata") and spark.read.schema(sessions.HISTORY).parquet(out).count() >= rows:
                return

    try:
        wait_for(1)
        time.sleep(8)
        drop("a", "y")
        wait_for(2)
    finally:
        stream.stop()
    rows = [tuple(r) for r in spark.read.parquet(out).select("session", "version", "tag", "n").collect()]
    assert sorted(rows) == [("a", 1, "x", 1), ("a", 1, "y", 1)]
