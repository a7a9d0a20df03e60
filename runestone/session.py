"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and bench.py."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("runestone")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset only a
    local master may fall back to a temporary folder: elsewhere the files of a
    lost machine would be lost with it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="runestone-")
    context.setCheckpointDir(folder)
    return folder


# Folders made inside each open ``scratch`` block, the innermost last.
_OWNED: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables settled inside the block are removed when it ends.

    The result must be written, or its rows collected, before that.
    """
    _OWNED.append([])
    try:
        yield
    finally:
        for path in _OWNED.pop():
            remove_dir(spark, path)


def remove_dir(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any file system that Spark knows; false where there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and go on from there.

    It cuts the lineage as a checkpoint does, survives lost executors, and as
    Parquet it is compressed, read by column, and of a size the optimizer knows.
    It stays until the folder is emptied or the ``scratch`` block around it ends.
    """
    path = fresh_dir(df.sparkSession, "settled")
    if _OWNED:
        _OWNED[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
