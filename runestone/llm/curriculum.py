"""Mixing sources to target weights as a curriculum that changes over time.

Each source has a weight schedule: steps of training time in [0, 1] with a weight
each. Its integral up to a time is the share of the source's tokens due by then.
The documents of a source form one stream of tokens, in a seeded order and
repeated up to ``MAX_REPEATS`` times; where a document's middle lies in the stream
is inverted through the integral to the time at which it is trained on. Copies
whose middle lies beyond the source's target are not taken, so a source misses its
target by half a document at most.

Only DataFrame expressions. No window sees a source: the order is that of a
digest, a slice of the order is a digest prefix, and a row adds the total of the
earlier slices to its sum inside its slice. Slices are as many as the largest
source needs, so a source with a third of all rows is spread as any other.

Defined results: a null or empty text has size 0 and is never taken, but has a
row. Null sources form one source, last in order. A null doc_id is ordered as
the digest of the seed alone. Repeated rows are documents of their own. Documents of equal id and
size may exchange places; nothing else depends on the order of the input. An empty
table gives an empty table. Other columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runestone.llm.common import free_name
from runestone.operators.scaling import prefix_sums
from runestone.session import settle

# Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
# Steps of equal length for each of the WEIGHTS: how much of its mean weight a source has then.
# Heavy sources lead, light ones follow; each schedule has the mean 1.
PHASES = ((1.5, 1.25, 0.75, 0.5), (1.0, 1.0, 1.0, 1.0), (0.5, 0.75, 1.25, 1.5))
MAX_REPEATS = 3
# Documents that one task orders.
SLICE_ROWS = 100_000
SEED = "mix"

WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A name for every source, null included, that is never null itself."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) -> rank, weight and target of each source.

    The shares of all tokens are filled like water: in order of the size at which a
    source is full for its weight, sources are full as long as the rest, dealt by
    weight, would overfill them. Sources are ordered by range-partitioned running
    sums, so their number is not bounded either.
    """
    named = sizes.withColumns({"_null": F.col("source").isNull(), "_one": F.lit(1)})
    ranked = prefix_sums(named, [], ["_null", "source"], {"_rank": "_one"})
    choice = F.array(*[F.lit(int(w)) for w in weights])
    filled = ranked.withColumns({
        "_weight": F.element_at(choice, (F.col("_rank") % len(weights) + 1).cast("int")),
        "_most": F.col("source_size") * max_repeats,
    }).withColumn("_level", F.col("_most") / F.col("_weight"))
    running = settle(prefix_sums(filled, [], ["_level", "_rank"], {"_full": "_most", "_spent": "_weight"}))
    totals = running.agg(F.sum("source_size").alias("_all"), F.sum("_weight").alias("_weights"))
    # One row each side: totals of the table.
    rest = running.join(F.broadcast(totals)).withColumn(
        "_even", (F.col("_all") - F.col("_full")) / (F.col("_weights") - F.col("_spent"))
    )
    # The water line is that of the first source which is not full by its own share.
    line = rest.filter(F.col("_level") >= F.col("_even")).agg(F.min(F.struct("_level", "_even"))["_even"].alias("_line"))
    due = F.coalesce(F.col("_weight") * F.col("_line"), F.col("_most").cast("double"))
    return rest.join(F.broadcast(line)).select(
        "source", "source_size", "_rank", F.least(F.col("_most").cast("double"), due).alias("target")
    )


def training_time(share: Column, phases: tuple[float, ...]) -> Column:
    """The time at which the integral of the schedule reaches ``share`` of its whole."""
    width, whole = 1.0 / len(phases), sum(phases)
    out, start = F.lit(1.0), 0.0
    steps = []
    for i, weight in enumerate(phases):
        end = start + weight / whole
        if weight > 0:
            steps.append((end, i * width + (share - F.lit(start)) / F.lit(end - start) * F.lit(width)))
        start = end
    for end, time in reversed(steps):
        out = F.when(share <= F.lit(end), time).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def mix(
    docs: DataFrame, weights=WEIGHTS, phases=PHASES, max_repeats: int = MAX_REPEATS, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target``, ``mix_taken``, ``mix_times``.

    ``mix_times`` holds the training time of every taken copy, in order;
    ``mix_taken`` is their size together. A column of ``docs`` with one of these
    names is replaced.
    """
    if len(phases) != len(weights) or any(min(p) < 0 or sum(p) <= 0 for p in phases):
        raise ValueError("one schedule per weight, none negative, none all zero")
    docs = docs.drop("mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_times")
    digest, place, key, running, rank = (
        free_name(docs, x) for x in ("_mix_digest", "_mix_slice", "_mix_key", "_mix_running", "_mix_rank")
    )
    base = docs.withColumns({
        "mix_size": words_in(F.col("text").cast("string")),
        digest: F.md5(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string"))),
        key: source_key(F.col("source")),
    })
    # Sizes per source and digest prefix: at most 16 ** 4 rows of a source, from which
    # everything that follows is summed, so the texts are counted once here and once below.
    counted = settle(
        base.groupBy("source", key, F.substring(digest, 1, 4).alias(place))
        .agg(F.sum("mix_size").alias("_in"), F.count(F.lit(1)).alias("_rows"))
    )
    sizes = settle(counted.groupBy("source", key).agg(F.sum("_in").alias("source_size"), F.sum("_rows").alias("_rows")))
    most = sizes.agg(F.max("_rows")).first()[0] or 0
    # Digits of the digest that make a slice of the order.
    digits = min(4, max(0, math.ceil(math.log(max(1.0, most / slice_rows), 16))))
    earlier = Window.partitionBy(key).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        counted.groupBy(key, F.substring(place, 1, digits).alias(place)).agg(F.sum("_in").alias("_in"))
        .withColumn("_before", F.coalesce(F.sum("_in").over(earlier), F.lit(0)))
    )
    targets = source_targets(sizes.drop("_rows", key), weights, max_repeats)
    lookup = settle(
        slices.join(targets.withColumn(key, source_key(F.col("source"))), key).select(
            key, place, F.col("_before").alias(running), F.col("_rank").alias(rank),
            F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
        )
    )
    inside = Window.partitionBy(key, place).orderBy(digest, "mix_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        base.withColumn(place, F.substring(digest, 1, digits))
        .join(lookup, [key, place])
        .withColumn(running, F.col(running) + F.coalesce(F.sum("mix_size").over(inside), F.lit(0)))
    )

    def middle(copy: Column) -> Column:
        return 2 * (F.col(running) + copy * F.col("mix_source_size")) + F.col("mix_size")

    def time(copy: Column) -> Column:
        share = middle(copy) / (2 * F.col("mix_target"))
        out = F.lit(None).cast("double")
        for i, steps in enumerate(phases):
            out = F.when(F.col(rank) % len(phases) == i, training_time(share, steps)).otherwise(out)
        return out

    copies = F.array(*[F.lit(k).cast("long") for k in range(max_repeats)])
    taken = F.filter(copies, lambda k: (F.col("mix_size") > 0) & (middle(k) <= 2 * F.col("mix_target")))
    return (
        placed.withColumn("mix_times", F.transform(taken, time))
        .withColumn("mix_taken", F.size("mix_times") * F.col("mix_size"))
        .select(*docs.columns, "mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_times")
    )


def training_order(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per taken copy with its time ``mix_time``, range-sorted by it."""
    digest = F.md5(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string")))
    exploded = mixed.withColumn("mix_time", F.explode("mix_times")).drop("mix_times")
    keys = ["mix_time", digest]
    ranged = exploded.repartitionByRange(partitions, *keys) if partitions else exploded.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)
