"""Weight tables as compressed artifacts: zeros cost a bit, equal bytes stand side by side.

A part of a tensor is a bitmap of the weights that are not zero, and those weights with their bytes
split into planes (all first bytes, all second bytes ...), each compressed. Pruning therefore has a size: a zeroed
weight leaves one bit of the bitmap. Encoding is exact for the kind it names: ``fp32`` keeps every bit, ``fp16``
and ``int8`` keep what those formats hold. The artifact is a Parquet table, so it is
written, measured (``compression.stored_size``) and read by any number of tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runestone.operators import compression

# Weights in a row of the artifact.
PART_VALUES = 1 << 16
KINDS = {"fp32": "<f4", "fp16": "<f2", "int8": "i1"}
PLAIN_STORE = {"compression": "none", "parquet.enable.dictionary": "false", "parquet.column.statistics.enabled": "false"}
ARTIFACT = "tensor string, rank int, part int, n int, kind string, scale double, nonzero binary, planes binary"


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Bitmap and byte planes of the values whose bits are not all 0."""
    bits = values.view(np.uint8).reshape(len(values), values.itemsize)
    there = bits.any(axis=1)
    return zlib.compress(np.packbits(there).tobytes()), zlib.compress(bits[there].T.tobytes())


def unpack(nonzero: bytes, planes: bytes, n: int, kind: str) -> np.ndarray:
    there = np.unpackbits(np.frombuffer(zlib.decompress(nonzero), np.uint8), count=n).astype(bool)
    values = np.zeros(n, KINDS[kind])
    held = np.frombuffer(zlib.decompress(planes), np.uint8).reshape(values.itemsize, -1)
    values[there] = np.ascontiguousarray(held.T).view(KINDS[kind]).ravel()
    return values


def encode(weights: DataFrame, kind: str = "fp32", part_values: int = PART_VALUES) -> DataFrame:
    """A weight table as rows of an artifact. A tensor without values has one empty part; NULL values count as none.

    ``int8`` stores the codes of ``compression.int8_tensors`` and their scale.
    """
    if kind not in KINDS:
        raise ValueError(f"an artifact is one of {sorted(KINDS)}, not {kind!r}")
    ready = weights.withColumn("values", F.coalesce("values", F.array().cast("array<float>")))
    if kind == "int8":
        ready = compression.int8_tensors(ready).withColumn("values", F.col("codes").cast("array<float>"))
    elif kind == "fp16":
        ready = compression.fp16_tensors(ready)
    scale = F.col("scale").cast("double") if kind == "int8" else F.lit(None).cast("double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tensor, rank, scaled = (batch.column(i)[row].as_py() for i in (0, 1, 3))
                values = batch.column(2)[row].values.to_numpy(zero_copy_only=False)
                out = []
                for part, at in enumerate(range(0, max(1, len(values)), part_values)):
                    own = np.ascontiguousarray(values[at:at + part_values].astype(KINDS[kind]))
                    out.append((tensor, rank, part, len(own), kind, scaled, *pack(own)))
                names, kinds = zip(*(x.split() for x in ARTIFACT.split(", ")), strict=True)
                arrow = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array(c, arrow[k]) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], list(names))

    return ready.select("tensor", F.col("rank").cast("int"), F.col("values").cast("array<float>"), scale.alias("scale")).mapInArrow(run, ARTIFACT)


def decode(artifact: DataFrame) -> DataFrame:
    """The weight table of an artifact, with ``scale`` and ``codes`` multiplied out for ``int8``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tensor, rank, part, n, kind, scale, nonzero, planes = (c[row].as_py() for c in batch.columns)
                values = unpack(nonzero, planes, n, kind)
                if kind == "int8":
                    values = values.astype(np.float64) * scale if scale is not None else values
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tensor], pa.string()), pa.array([rank], pa.int32()), pa.array([part], pa.int32()), pa.array([values.astype("<f4")], pa.list_(pa.float32()))],
                    ["tensor", "rank", "part", "values"],
                )

    columns = [x.split()[0] for x in ARTIFACT.split(", ")]
    parts = artifact.select(*columns).mapInArrow(run, "tensor string, rank int, part int, values array<float>")
    # A tensor of one part is whole already; only larger ones are put together.
    whole = F.array_sort(F.collect_list(F.struct("part", "values")))
    return parts.groupBy("tensor", "rank").agg(F.flatten(F.transform(whole, lambda p: p["values"])).alias("values"))


def write_artifact(weights: DataFrame, path: str, kind: str = "fp32") -> DataFrame:
    """Write the artifact and return its measured size, ``size_mb``."""
    # What is compressed already is stored as it is, and its smallest and largest values are of no use.
    encode(weights, kind).write.options(**PLAIN_STORE).parquet(path)
    return compression.stored_size(weights.sparkSession, path)


def read_artifact(spark: SparkSession, path: str) -> DataFrame:
    return decode(spark.read.parquet(path))


def payload_bytes(artifact: DataFrame) -> DataFrame:
    """``(params, bytes)`` of an artifact's parts, without the files' own overhead."""
    return artifact.agg(
        F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0)).alias("params"),
        F.coalesce(F.sum((F.octet_length("nonzero") + F.octet_length("planes")).cast("long")), F.lit(0)).alias("bytes"),
    )
