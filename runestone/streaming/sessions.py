"""Streaming state that belongs to a session, and a bounded sketch of frequent tags.

Both operators keep one state row per key (``applyInPandasWithState``), so it is checkpointed with the
stream and moves with its key. Each batch that touches a key appends the key's whole result under the next
version; ``newest`` picks the last one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from datetime import timedelta
from itertools import chain

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# The time of occurrences that are too old to be cleared one by one; before any real time.
FOLDED = -(1 << 62)
HISTORY = "session string, version long, tag string, n long"
HISTORY_STATE = "latest long, cleared long, version long, tags array<string>, times array<long>, counts array<long>"
FREQUENT = "part int, version long, tag string, n long, short long, total long"
FREQUENT_STATE = "total long, short long, version long, tags array<string>, counts array<long>"


def _kept_for(state: GroupState, ttl: timedelta | None) -> None:
    if ttl is not None:
        state.setTimeoutDuration(int(ttl.total_seconds() * 1000))


def _timeout(ttl: timedelta | None) -> str:
    return GroupStateTimeout.NoTimeout if ttl is None else GroupStateTimeout.ProcessingTimeTimeout


def advance_history(state: tuple, batch: Iterator[tuple], lateness: int) -> tuple:
    """The state of a session after a batch of (time, tags, clear), in any order."""
    latest, before, version, *held = state
    # What is older than this came too late, be it an occurrence or a clear.
    edge = max(FOLDED, latest - lateness) + 1
    cleared = before
    fresh: Counter[tuple[str, int]] = Counter()
    for at, tags, clear in batch:
        latest = max(latest, at)
        if at >= edge:
            cleared = max(cleared, at) if clear else cleared
            fresh.update((tag, at) for tag in tags if tag is not None)
    fold = max(FOLDED, latest - lateness)
    kept: Counter[tuple[str, int]] = Counter()
    for tag, at, n in [*zip(*held, strict=True), *((tag, at, n) for (tag, at), n in fresh.items())]:
        # Folded occurrences are older than any clear that comes now.
        if at > cleared or at == FOLDED and cleared == before:
            kept[tag, at if at > fold else FOLDED] += n
    return latest, cleared, version + 1, [tag for tag, _ in kept], [at for _, at in kept], list(kept.values())


def advance_summary(state: tuple, batches: Iterator[Counter], size: int) -> tuple:
    """The summary of a part after batches of tag counts, or of summaries (counts, total, short).

    Counters are lower bounds. When there are more than ``size``, the largest that must go is taken from
    all; the sum of what was taken so is the most by which a counter can be short, and at
    most total / (size + 1). Summaries of this kind can be merged, so the batches may be cut anywhere.
    """
    total, short, version, tags, counts = state
    kept = Counter(dict(zip(tags, counts, strict=True)))
    for batch in batches:
        own, n, missed = batch if isinstance(batch, tuple) else (batch, batch.total(), 0)
        kept.update(own)
        total += n
        short += missed
        if len(kept) > size:
            taken = sorted(kept.values(), reverse=True)[size]
            short += taken
            kept = Counter({tag: n - taken for tag, n in kept.items() if n > taken})
    return total, short, version + 1, list(kept), list(kept.values())


def _summarized(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One summary of a split's (part, tag) rows; the row without a tag tells its total and what it is short of."""

    def counters(batches: Iterator[pa.RecordBatch]) -> Iterator[Counter]:
        for batch in batches:
            counted = pc.value_counts(batch.column(1))
            yield Counter(dict(zip(counted.field("values").to_pylist(), counted.field("counts").to_pylist(), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((batch for batch in batches if batch.num_rows), None)
        if first is None:
            return
        part = first.column(0)[0].as_py()
        total, short, _, tags, counts = advance_summary((0, 0, 0, [], []), counters(chain([first], batches)), size)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * (1 + len(tags)), pa.int32()), pa.array([None, *tags], pa.string()), pa.array([total, *counts], pa.int64()),
             pa.array([short] + [0] * len(tags), pa.int64())], ["part", "tag", "n", "short"])

    return run


def session_history(
    events: DataFrame, session: str | Column, at: str | Column, tags: str | Column, clear: str | Column,
    lateness: timedelta = timedelta(hours=1), ttl: timedelta | None = None,
) -> DataFrame:
    """``(session, version, tag, n)`` of a stream of events: each session's tag counts since its last clear.

    Occurrences are kept by tag and time. Those more than ``lateness`` older than the session's latest event become
    one entry a tag, so a session's state is its tags and a window of recent times.
    A clear removes the session's occurrences up to its own time, whichever comes first in the stream, its own
    tags included. What is more than ``lateness`` older than the latest event of an earlier batch of
    the session is dropped. Sessions that rest for ``ttl`` are forgotten; the timer makes Spark run batches
    without end, so it is for streams with a processing-time trigger, not for ``availableNow``. Events without a
    session or time are left out; a session without tags has one row with a NULL tag.
    """
    session, at, tags, clear = (F.col(c) if isinstance(c, str) else c for c in (session, at, tags, clear))
    rows = events.select(
        session.cast("string").alias("session"), F.unix_micros(at.cast("timestamp")).alias("at"),
        F.coalesce(tags, F.array().cast("array<string>")).alias("tags"), F.coalesce(clear, F.lit(False)).alias("clear"),
    ).filter("session IS NOT NULL AND at IS NOT NULL")
    microseconds = int(lateness.total_seconds() * 1_000_000)

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get if state.exists else (FOLDED, FOLDED, 0, [], [], [])
        batch = (row for p in parts for row in zip(p["at"].tolist(), p["tags"], p["clear"].tolist(), strict=True))
        now = advance_history(tuple(held), batch, microseconds)
        state.update(now)
        _kept_for(state, ttl)
        totals: Counter[str] = Counter()
        for tag, n in zip(now[3], now[5], strict=True):
            totals[tag] += n
        # A session without tags has a row too, so that its clearing is seen.
        shown = sorted(totals.items()) or [(None, 0)]
        yield pd.DataFrame({"session": key[0], "version": now[2], "tag": [t for t, _ in shown], "n": [n for _, n in shown]})

    return rows.groupBy("session").applyInPandasWithState(update, HISTORY, HISTORY_STATE, "append", _timeout(ttl))


def frequent_tags(tags: DataFrame, tag: str = "tag", size: int = 1000, parts: int = 8, ttl: timedelta | None = None) -> DataFrame:
    """Summaries of a stream with one tag a row, for ``frequent_counts``: ``(part, version, tag, n, short, total)``.

    Rows go to ``parts`` summaries of ``size`` counters by the split they come from, so a tag that owns a third of
    the rows burdens no single one. The state holds at most parts * size tags, however many occur. A split is
    summarized where it is read: ``size`` counters of it are shuffled, not its rows.
    """
    rows = tags.filter(F.col(tag).isNotNull()).select(F.pmod(F.spark_partition_id(), F.lit(parts)).alias("part"), F.col(tag).alias("tag"))
    dealt = rows.mapInArrow(_summarized(size), "part int, tag string, n long, short long")

    def merged(p: pd.DataFrame) -> tuple[Counter, int, int]:
        counts, totals = p[p["tag"].notna()], p[p["tag"].isna()]
        kept = Counter()
        for tag, n in zip(counts["tag"].tolist(), counts["n"].tolist(), strict=True):
            kept[tag] += n
        return kept, int(totals["n"].sum()), int(totals["short"].sum())

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get if state.exists else (0, 0, 0, [], [])
        now = advance_summary(tuple(held), (merged(p) for p in parts), size)
        state.update(now)
        _kept_for(state, ttl)
        # The row without a tag tells what is true of the part.
        shown = [(None, 0), *sorted(zip(now[3], now[4], strict=True))]
        yield pd.DataFrame({
            "part": pd.Series([key[0]] * len(shown), dtype="int32"), "version": now[2], "tag": [t for t, _ in shown], "n": [n for _, n in shown],
            "short": now[1], "total": now[0],
        })

    return dealt.groupBy("part").applyInPandasWithState(update, FREQUENT, FREQUENT_STATE, "append", _timeout(ttl))


def frequent_counts(summaries: DataFrame) -> DataFrame:
    """``(tag, at_least, at_most)`` from all summaries so far.

    The two differ by at most total / (size + 1), so a tag that makes up more than a (size + 1)-th of all rows is there.
    """
    last = newest(summaries, "part")
    short = last.filter("tag IS NULL").agg(F.coalesce(F.sum("short"), F.lit(0))).scalar()
    return last.filter("tag IS NOT NULL").groupBy("tag").agg(F.sum("n").alias("at_least")).withColumn("at_most", F.col("at_least") + short)


def newest(results: DataFrame, key: str) -> DataFrame:
    """The rows of each key's last version, of the appended results of a stream; a row with a NULL tag holds no count."""
    last = results.groupBy(key).agg(F.max("version").alias("version"))
    return results.join(last, [key, "version"])
