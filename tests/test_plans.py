"""Physical plans: what must not shuffle, and what must be pushed down."""

from __future__ import annotations

import pytest

from runestone.functions.text import sanitize
from runestone.operators import cleaning, labels, sampling, tagging
from runestone.plans.scoring import length_scorer, score_batch


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("lang", "language").withColumnRenamed(
        "source", "label_text")


def test_cleaning_scoring_and_tagging_do_not_shuffle(spark, documents):
    for df in (
        cleaning.clean_corpus(documents), cleaning.clean_and_drop(documents), tagging.tag_documents(documents),
        score_batch(documents, length_scorer(4)),
    ):
        assert "Exchange" not in plan(df)


def test_a_filter_on_clean_text_does_not_clean_twice(documents):
    text = plan(cleaning.clean_and_drop(documents))
    assert text.count("ArrowEvalPython") == 1 and text.count("(?msd)^-- ?$.*") == 1


def test_only_used_columns_are_read(documents):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(sanitize(documents).select("doc_id", "clean_text"))


def test_lookups_are_broadcast_and_rows_stay(spark, documents):
    names = labels.label_map(documents)
    text = plan(labels.encode_labels(documents, names))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    split = plan(sampling.stratified_split(documents, label="label_text"))
    assert "BroadcastHashJoin" in split and "Exchange hashpartitioning" not in split
    assert "Window" not in split


def test_tag_counts_combine_before_the_shuffle(documents):
    text = plan(tagging.tag_counts(tagging.tag_documents(documents)))
    assert text.count("Exchange hashpartitioning(tag") == 1 and "partial_count(1)" in text


def test_no_cross_joins(spark, sf):
    from runestone.registry.queries import QUERIES

    for name in ("score_batch", "length_outliers", "compression_report", "corpus_summary", "eval_auc", "class_weights"):
        text = plan(QUERIES[name](spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
