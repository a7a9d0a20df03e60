"""Join and ordering primitives that hold when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runestone import settings
from runestone.session import settle

# A top-n may bring at most this many rows together in its last task.
TOP_ROWS_DIRECT = 2_000_000

# Digest prefixes that split a group for counting: 16 ** PREFIX buckets.
PREFIX = 4


def join_dimension(
    rows: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salt_by: str | None = None,
    settled: bool = False,
    max_rows: int = settings.BROADCAST_MAX_ROWS,
    max_bytes: int = settings.BROADCAST_MAX_BYTES,
    heavy_rows: int = settings.HEAVY_ROWS,
) -> DataFrame:
    """Join a lookup table to ``rows`` without ever shuffling a hot key to one task.

    The dimension is materialised and measured. Up to ``max_rows`` rows and
    ``max_bytes`` bytes (as text) it is broadcast and ``rows`` stay where they are.
    Beyond that both sides are shuffled. Keys with more than ``heavy_rows`` rows are
    counted first (there are few: all rows / ``heavy_rows`` at most); their rows are
    dealt to as many tasks as their count asks for, by the hash of ``salt_by``, and
    only their dimension rows are repeated.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"join_dimension cannot do a {how} join")
    on = list(on)
    if not settled:
        dimension = settle(dimension)
    size = dimension.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")
    ).first()
    if size.rows <= max_rows and (size.bytes or 0) <= max_bytes:
        return rows.join(F.broadcast(dimension), on, how)
    heavy = settle(
        rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > heavy_rows)
        .select(*on, F.ceil(F.col("_n") / heavy_rows).cast("int").alias("_salts"))
    )
    if heavy.isEmpty():
        return rows.join(dimension, on, how)
    # The salt must not change when a task is run again, so it is a hash of data.
    salt_source = [salt_by] if salt_by else [c for c in rows.columns if c not in on] or on
    salted = rows.join(F.broadcast(heavy), on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*salt_source), F.coalesce("_salts", F.lit(1))).cast("int")
    ).drop("_salts")
    copies = dimension.join(F.broadcast(heavy), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    ).drop("_salts")
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def prefix_sums(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    amounts: dict[str, str],
    slices: int | None = None,
) -> DataFrame:
    """For every row, totals over the rows before it in its group.

    ``amounts`` maps a new column to the column it accumulates. (group, order)
    must be unique. A window over the group would pull a hot group into one task;
    here the rows are range-partitioned on (group, order), each slice is summed,
    and a row adds the total of the earlier slices to its rank inside its slice.
    """
    group, order = list(group), list(order)
    spark = rows.sparkSession
    slices = slices or max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    ranged = settle(
        rows.repartitionByRange(slices, *group, *order).withColumn("_slice", F.spark_partition_id())
    )
    inside = (
        Window.partitionBy(*group, "_slice").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most one row per slice and group: this window never sees the data itself.
    across = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*group, "_slice").agg(
        *[F.sum(source).alias(f"_total_{name}") for name, source in amounts.items()]
    )
    earlier = totals.select(
        *group, "_slice",
        *[
            F.coalesce(F.sum(f"_total_{name}").over(across), F.lit(0)).alias(f"_earlier_{name}")
            for name in amounts
        ],
    )
    joined = ranged.join(earlier, [*group, "_slice"])
    for name, source in amounts.items():
        joined = joined.withColumn(
            name, F.coalesce(F.sum(source).over(inside), F.lit(0)) + F.col(f"_earlier_{name}")
        )
    return joined.drop("_slice", *[f"_earlier_{name}" for name in amounts])


def top_rows(rows: DataFrame, amount: str, tie: str, n: int, direct: int = TOP_ROWS_DIRECT) -> DataFrame:
    """The ``n`` rows with the largest ``amount``, ties by ``tie``; ``rows`` is an aggregate.

    A sort with a limit sends n rows of every task to one task. Where that could be
    too many, the amounts are counted first and only rows that can be in the result
    are sorted: those with fewer than n rows of a larger amount.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if tasks * n > direct:
        rows = settle(rows)
        sizes = rows.groupBy((-F.col(amount)).alias("_cost")).agg(F.count(F.lit(1)).alias("_n"))
        reached = prefix_sums(sizes, [], ["_cost"], {"_larger": "_n"}).filter(F.col("_larger") < n)
        rows = rows.filter(F.col(amount) >= -reached.agg(F.max("_cost")).scalar())
    return rows.orderBy(F.desc(amount), tie).limit(n)


def sampling_digest(key: str, seed: int) -> Column:
    """Seeded pseudo-random order of the rows; unique keys break equal digests."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def hash_cutoffs(
    rows: DataFrame,
    group: str,
    key: str,
    seed: int,
    wanted: int | Callable[[Column], Column],
) -> DataFrame:
    """Per group, the digest and key of its n-th row in seeded order.

    ``wanted`` is n, or a function from the group's size to n. Comparing a row's
    digest with the cut-off picks exactly n rows and needs no shuffle of the rows.
    Only (group, digest prefix) counts are windowed, then only the rows of the one
    prefix that holds the cut-off, so no task ever sees a whole group.
    """
    keyed = rows.select(group, key, sampling_digest(key, seed).alias("_digest")).withColumn(
        "_prefix", F.substring("_digest", 1, PREFIX)
    )
    counts = keyed.groupBy(group, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    by_prefix = Window.partitionBy(group).orderBy("_prefix")
    running = counts.withColumn("_through", F.sum("_n").over(by_prefix)).withColumn(
        "_size", F.sum("_n").over(Window.partitionBy(group))
    )
    n = F.lit(wanted) if isinstance(wanted, int) else wanted(F.col("_size"))
    running = running.withColumn("_n_wanted", F.least(n.cast("long"), F.col("_size")))
    edge = settle(
        running.filter(
            (F.col("_n_wanted") > F.col("_through") - F.col("_n"))
            & (F.col("_n_wanted") <= F.col("_through"))
        ).select(
            group, "_prefix", "_size",
            (F.col("_n_wanted") - F.col("_through") + F.col("_n")).alias("_nth"),
        )
    )
    candidates = join_dimension(keyed, edge, [group, "_prefix"], "inner", salt_by=key, settled=True)
    seeded = Window.partitionBy(group).orderBy("_digest", key)
    return (
        candidates.withColumn("_at", F.row_number().over(seeded))
        .filter(F.col("_at") == F.col("_nth"))
        .select(group, F.col("_digest").alias("_cut_digest"), F.col(key).alias("_cut_key"),
                F.col("_size"))
    )


def below_cutoff(key: str, seed: int) -> Column:
    """True for the rows chosen by the joined cut-off; false where there is none."""
    digest = sampling_digest(key, seed)
    return F.coalesce(
        (digest < F.col("_cut_digest"))
        | ((digest == F.col("_cut_digest")) & (F.col(key) <= F.col("_cut_key"))),
        F.lit(False),
    )
