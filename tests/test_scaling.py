"""Joins, running totals and cut-offs against brute force, with hot keys."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from runestone.operators import sampling, scaling
from runestone.session import fresh_dir, settle, shared_dir


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows."""
    return spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 10)).alias("label"),
        ((F.col("id") * 7919) % 1009).alias("v"),
    ).cache()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_rows", [10, 0])
def test_join_dimension(spark, skewed, how, max_rows):
    dim = spark.createDataFrame([("hot", 1), ("g8", 2), ("absent", 3)], "label string, x int")
    got = scaling.join_dimension(skewed, dim, ["label"], how, salt_by="doc_id", max_rows=max_rows, heavy_rows=5)
    want = skewed.join(dim, ["label"], how)
    assert got.columns == want.columns
    assert Counter(got.collect()) == Counter(want.collect())
    # Beyond the bound both sides are salted; only the few heavy keys are broadcast.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("_salt" in plan) == (max_rows == 0) and "strategy=broadcast" in plan


def test_a_dimension_with_few_but_wide_rows_is_not_broadcast(spark, skewed):
    dim = spark.createDataFrame([("hot", "x" * 2000), ("g8", "y")], "label string, x string")
    got = scaling.join_dimension(skewed, dim, ["label"], "left", salt_by="doc_id", max_bytes=1000, heavy_rows=1000)
    assert "_salt" in got._jdf.queryExecution().optimizedPlan().toString()
    assert Counter(got.collect()) == Counter(skewed.join(dim, ["label"], "left").collect())


def test_only_heavy_keys_are_repeated(spark, skewed):
    """The hot key's dimension row is repeated as often as its share asks for, the others not at all."""
    dim = spark.createDataFrame([("hot", 1), ("g8", 2), ("absent", 3)], "label string, x int")
    light = scaling.join_dimension(skewed, dim, ["label"], "left", salt_by="doc_id", max_rows=0, heavy_rows=10_000)
    assert "_salt" not in light._jdf.queryExecution().optimizedPlan().toString()
    heavy = scaling.join_dimension(skewed, dim, ["label"], "left", salt_by="doc_id", max_rows=0, heavy_rows=1000)
    assert Counter(heavy.collect()) == Counter(light.collect()) == Counter(skewed.join(dim, ["label"], "left").collect())


def test_join_dimension_rejects_other_joins(spark, skewed):
    with pytest.raises(ValueError):
        scaling.join_dimension(skewed, skewed, ["label"], "full")


@pytest.mark.parametrize("group", [["label"], []])
def test_prefix_sums(spark, skewed, group):
    points = skewed.groupBy("label", "v").agg(F.count(F.lit(1)).alias("n"))
    if not group:
        points = points.groupBy("v").agg(F.sum("n").alias("n")).withColumn("label", F.lit("all"))
    got = scaling.prefix_sums(points, group, ["v"], {"below": "n"}, slices=5).collect()
    groups = defaultdict(list)
    for r in points.collect():
        groups[r.label].append((r.v, r.n))
    assert len(got) == sum(map(len, groups.values()))
    for r in got:
        assert r.below == sum(n for v, n in groups[r.label] if v < r.v)


def order_of(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest(), key


def smallest(rows, n, seed=42):
    return {r.doc_id for r in sorted(rows, key=lambda r: order_of(seed, r.doc_id))[:n]}


@pytest.fixture(scope="module")
def by_label(skewed):
    groups = defaultdict(list)
    for r in skewed.collect():
        groups[r.label].append(r)
    return groups


def test_cutoffs_pick_exactly_the_smallest(skewed, by_label):
    got = sampling.stratified_sample(skewed, 4 * 37, label="label").collect()
    assert {r.doc_id for r in got} == set().union(*(smallest(rows, 37) for rows in by_label.values()))


def test_small_class_raises_or_is_kept(skewed, by_label):
    with pytest.raises(ValueError):
        sampling.stratified_sample(skewed, 3900, label="label")
    got = Counter(r.label for r in sampling.stratified_sample(skewed, 3900, label="label", on_small="take_all").collect())
    assert got == {label: min(len(rows), 3900 // 4) for label, rows in by_label.items()}
    assert sampling.stratified_sample(skewed, 4000, label="label").count() == 4000
    assert sampling.stratified_sample(skewed, None, label="label") is skewed
    with pytest.raises(ValueError):
        sampling.stratified_sample(skewed, 10, label="label", on_small="x")


def test_split(skewed, by_label):
    got = sampling.stratified_split(skewed).collect()
    assert len(got) == 4000
    val = {r.doc_id for r in got if r.split == "val"}
    assert val == set().union(*(smallest(rows, round(len(rows) * 0.2)) for rows in by_label.values()))
    again = sampling.stratified_split(skewed.repartition(3)).filter("split = 'val'")
    assert {r.doc_id for r in again.collect()} == val
    other = {r.doc_id for r in sampling.stratified_split(skewed, seed=1).filter("split = 'val'").collect()}
    assert other != val and len(other) == len(val)
    with pytest.raises(ValueError):
        sampling.stratified_split(skewed, test_size=1.0)


def test_a_single_member_goes_to_train(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1)], "doc_id long, label int")
    got = {r.doc_id: r.split for r in sampling.stratified_split(df).collect()}
    assert got[1] == "train" and list(got.values()).count("val") == 1


def test_eval_sample(skewed):
    rows = skewed.collect()
    assert {r.doc_id for r in sampling.eval_sample(skewed, 100).collect()} == smallest(rows, 100)
    assert sampling.eval_sample(skewed, 10_000).count() == 4000


def test_demo_sample(spark, skewed):
    got = sampling.demo_sample(skewed.withColumnRenamed("label", "language"), 5)
    assert set(Counter(r.language for r in got.collect()).values()) == {5}


def test_folds(skewed, by_label):
    got = {r.doc_id: r.fold for r in sampling.assign_folds(skewed, 3).collect()}
    for rows in by_label.values():
        ranked = sorted(rows, key=lambda r: order_of(42, r.doc_id))
        assert [got[r.doc_id] for r in ranked] == [i % 3 for i in range(len(ranked))]
    with pytest.raises(ValueError):
        sampling.assign_folds(skewed, 1)


@pytest.mark.parametrize("direct", [10**9, 0])
@pytest.mark.parametrize("n", [1, 17, 300, 5000])
def test_top_rows(skewed, direct, n):
    counts = skewed.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    want = sorted(((r.v, r.n) for r in counts.collect()), key=lambda t: (-t[1], t[0]))[:n]
    got = scaling.top_rows(counts, "n", "v", n, direct=direct).collect()
    assert sorted((r.v, r.n) for r in got) == sorted(want)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        shared_dir(Session())


def test_settle_uses_the_session_folder(spark):
    folder = shared_dir(spark)
    assert fresh_dir(spark, "x").startswith(folder.rstrip("/"))
    df = settle(spark.range(5))
    assert df.count() == 5 and "Range (" not in df._jdf.queryExecution().toString()
