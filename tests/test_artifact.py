"""Compressed weight artifacts: exact round trips and measured sizes."""

from __future__ import annotations

import numpy as np
import pytest

from runestone.operators import artifact, compression
from runestone.session import fresh_dir


@pytest.mark.parametrize("kind", ["fp32", "fp16", "int8"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_pack(kind, n):
    rng = np.random.default_rng(n)
    values = (rng.normal(size=n) * 50).astype(artifact.KINDS[kind])
    values[rng.random(n) < 0.4] = 0
    if kind != "int8" and n > 2:
        values[:3] = [-0.0, np.nan, np.inf]
    back = artifact.unpack(*artifact.pack(values), n, kind)
    assert back.dtype == values.dtype and back.tobytes() == values.tobytes()


@pytest.fixture(scope="module")
def weights(spark):
    rng = np.random.default_rng(2)
    rows = [(f"t{i}", 2, [float(np.float32(x)) for x in rng.normal(0, 0.05, 3000)]) for i in range(4)]
    return spark.createDataFrame([*rows, ("bias", 1, [0.0, -0.0, 1.5]), ("empty", 2, []), ("none", 2, None)], "tensor string, rank int, values array<float>")


def values_of(df):
    return {r.tensor: list(r["values"] or []) for r in df.collect()}


def test_round_trip(spark, weights):
    path = fresh_dir(spark, "artifact")
    artifact.write_artifact(weights, path)
    assert values_of(artifact.read_artifact(spark, path)) == values_of(weights)
    small = artifact.encode(weights, part_values=999)
    assert small.filter("tensor = 't0'").count() == 4 and values_of(artifact.decode(small)) == values_of(weights)
    half = values_of(artifact.decode(artifact.encode(weights, "fp16")))
    assert half == values_of(compression.fp16_tensors(weights.na.fill({}).filter("values IS NOT NULL"))) | {"none": []}
    coded = {r.tensor: [float(np.float32(c * r.scale)) for c in r.codes] for r in compression.int8_tensors(weights.filter("tensor LIKE 't%'")).collect()}
    whole = values_of(artifact.decode(artifact.encode(weights, "int8")))
    assert all(whole[t] == coded[t] for t in coded)


def test_pruning_has_a_size(spark, weights):
    pruned = compression.prune_tensors(weights, 0.6)
    sizes = {}
    for name, table, kind in (("original", weights, "fp32"), ("pruned", pruned, "fp32"), ("fp16", pruned, "fp16"), ("int8", pruned, "int8")):
        path = fresh_dir(spark, name)
        artifact.write_artifact(table, path, kind)
        sizes[name] = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg({"length": "sum"}).first()[0]
    assert sizes["original"] > sizes["pruned"] > sizes["fp16"] > sizes["int8"] and sizes["pruned"] < 0.6 * sizes["original"]
    assert values_of(artifact.decode(artifact.encode(pruned))) == values_of(pruned) | {"none": []}
    assert artifact.payload_bytes(artifact.encode(weights)).first().params == 12_003


def test_faults(spark, weights):
    with pytest.raises(ValueError, match="an artifact is one of"):
        artifact.encode(weights, "fp8")
    assert artifact.decode(artifact.encode(weights.filter("false"))).isEmpty()
