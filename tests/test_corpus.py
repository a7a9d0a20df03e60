"""Sources, labels, corpus build and profiles."""

from __future__ import annotations

import statistics

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from runestone.operators import compression, labels, profiling
from runestone.plans import corpus_build
from runestone.session import fresh_dir, remove_dir, scratch, settle
from runestone.sources import tables


def test_csv_roundtrip_keeps_every_text(spark):
    texts = ['plain', 'quote " inside', 'two\nlines', 'cr\r\nlf', '', ' edges ', 'comma, "q"\n', 'back\\slash', None, 'null', 'NA']
    rows = [(i, t, i, "x", "en") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, tables.CORPUS_SCHEMA)
    path = fresh_dir(spark, "csv")
    tables.write_csv(df, path)
    got = {r.doc_id: r.text for r in tables.scan_csv(spark, path).collect()}
    assert got == dict(enumerate(texts))


def test_missing_csv_raises(spark):
    with pytest.raises(AnalysisException):
        tables.scan_csv(spark, "/nowhere/at/all.csv").count()


def test_reports(spark):
    path = fresh_dir(spark, "report")
    assert tables.read_report(spark, path) is None
    tables.write_report(spark.createDataFrame([(0.5,)], "accuracy double"), path)
    assert tables.read_report(spark, path).first().accuracy == 0.5


def test_splits_are_pruned(spark, corpus):
    path = fresh_dir(spark, "splits")
    split = F.when(F.col("doc_id") % 3 == 0, "validation").otherwise("train")
    corpus.withColumnRenamed("language", "subset").withColumn("split", split).write.partitionBy("subset", "split").parquet(path)
    assert tables.scan_splits(spark, path, "sv", ["train", "validation"]).count() == 12
    one = tables.scan_split(spark, path, "sv", "train")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(subset" in plan
    with pytest.raises(ValueError):
        tables.scan_splits(spark, path, "sv", [])


def test_standardize(spark):
    df = spark.createDataFrame([("hello world", 0, "greeting")], "body string, y int, cat string")
    got = labels.standardize(df, "body", "y", "cat", "en")
    assert got.columns == ["text", "label", "label_text", "language"]
    assert tuple(got.first()) == ("hello world", 0, "greeting", "en")
    with pytest.raises(KeyError):
        labels.standardize(df.drop("y", "cat"), "body", "y", "cat", "en")


def test_label_map(spark):
    names = spark.createDataFrame([("weather",), ("alarm",), ("weather",), ("calendar",), (None,)], "label_text string")
    got = {r.label_text: r.label for r in labels.label_map(names).collect()}
    assert got == {"alarm": 0, "calendar": 1, "weather": 2}
    with pytest.raises(ValueError):
        labels.label_map(names.limit(0))


def test_label_order_is_by_code_point(spark):
    names = ["b", "B", "a", "\xe5", "Z", "_", "\U0001f600", "\uffee"] + [f"n{i}" for i in range(300)]
    df = spark.createDataFrame([(n,) for n in names], "label_text string")
    got = {r.label_text: r.label for r in labels.label_map(df).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names))}


def test_encode_and_decode(spark, corpus):
    names = labels.language_label_map(corpus)
    coded = labels.encode_labels(corpus, names)
    assert {(r.label_text, r.label) for r in coded.collect()} == {("alarm", 0), ("weather", 1)}
    ids = spark.createDataFrame([(1, 0), (2, 7)], "doc_id long, label int")
    assert {r.doc_id: r.category for r in labels.decode_labels(ids, names).collect()} == {1: "alarm", 2: "7"}
    extra = corpus.withColumn("label_text", F.concat("label_text", F.lit("!")))
    with pytest.raises(KeyError):
        labels.encode_labels(extra, names)
    assert labels.encode_labels(extra, names, strict=False).filter("label is null").count() == 36


def test_languages(corpus):
    assert labels.check_language("sv") == "sv"
    with pytest.raises(ValueError):
        labels.check_language("de")
    assert labels.unsupported_language_rows(corpus, ["en", "sv"]).count() == 12
    assert labels.union_corpora([corpus, corpus]).count() == 72
    with pytest.raises(ValueError):
        labels.union_corpora([])


def test_build_corpus(spark, corpus):
    raw = corpus.unionByName(spark.createDataFrame(
        [(900, "<b></b>", "alarm", "en"), (901, None, "alarm", "sv"), (902, "nicht", "alarm", "de")], corpus.schema))
    built = corpus_build.build_corpus(raw)
    assert built.columns == ["doc_id", "text", "label", "label_text", "language"]
    assert built.count() == 36
    by_language = {r.language: r.names for r in built.groupBy("language").agg(
        F.array_sort(F.collect_set("label")).alias("names")).collect()}
    assert by_language == {"en": [0, 1], "sv": [0, 1], "fi": [0, 1]}
    sampled = corpus_build.build_corpus(corpus, sample_size=4)
    assert {(r.language, r.label): r["count"] for r in sampled.groupBy("language", "label").count().collect()} == {
        (lang, label): 2 for lang in ("en", "sv", "fi") for label in (0, 1)}
    missing = raw.filter("not (language = 'en' and label_text = 'weather')")
    with pytest.raises(KeyError):
        corpus_build.build_corpus(missing)


def test_one_source_per_language(corpus):
    sources = {lang: corpus.filter(F.col("language") == lang).drop("language") for lang in ("en", "sv", "fi")}
    built = corpus_build.build_corpus(corpus_build.combine_sources(sources))
    assert sorted(built.collect()) == sorted(corpus_build.build_corpus(corpus).collect())


def test_build_and_write(spark, corpus):
    path, sample = fresh_dir(spark, "corpus"), fresh_dir(spark, "sample")
    written = corpus_build.build_and_write(corpus, path, sample)
    assert written.count() == 36 and spark.read.parquet(sample).count() == 36
    plan = written.filter("language = 'fi'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(language" in plan


PROFILE = [
    (1, "a b c d", "x", "en"), (2, "a b c d ", "x", "en"), (3, "one", "y", "en"), (4, "", "y", "sv"), (5, None, "y", "sv"),
    (6, " \t", "z", "sv"), (7, " ".join("w" * 90), "x", "sv"), (8, "k l m", "x", "en"), (9, "k l m n o", "x", "sv"),
]


@pytest.fixture(scope="module")
def profiled(spark):
    return spark.createDataFrame(PROFILE, "doc_id long, text string, label_text string, language string").cache()


def test_missing_taxonomy(profiled):
    got = {r.category: (r["count"], r.percent) for r in profiling.missing_taxonomy(profiled).collect()}
    assert got == {"NaN / Null": (1, 11.11), "Empty / Whitespace": (2, 22.22), "Micro (<3 words)": (1, 11.11), "Valid": (5, 55.56)}
    empty = profiling.missing_taxonomy(profiled.limit(0)).collect()
    assert [r["count"] for r in empty] == [0, 0, 0, 0]


def test_duplicates(profiled):
    got = profiling.duplicates(profiled).first()
    assert (got.total, got.distinct_texts, got.duplicates, got.duplicate_percent) == (9, 6, 3, 33.33)


def test_lengths(profiled):
    words = pd.Series([len(t.split()) for _, t, *_ in PROFILE if t and len(t.split()) >= 3])
    want = words.describe(percentiles=profiling.PERCENTS)
    got = profiling.length_describe(profiled).first()
    assert got["count"] == len(words) and got["min"] == 3 and got["max"] == 90
    assert got["mean"] == pytest.approx(want["mean"]) and got["std"] == pytest.approx(want["std"])
    for p in profiling.PERCENTS:
        assert got[f"p{round(p * 100)}"] == pytest.approx(words.quantile(p))
    q1, q3 = words.quantile(0.25), words.quantile(0.75)
    out = profiling.length_outliers(profiled).first()
    assert out.upper_bound == pytest.approx(q3 + 1.5 * (q3 - q1)) and out.outliers == 1 and out.outlier_percent == 20.0
    bins = {r.bin: r.documents for r in profiling.length_histogram(profiled).collect()}
    assert bins == {0: 3, 1: 1, 59: 1}
    with pytest.raises(ValueError):
        profiling.length_describe(profiled.limit(0), strict=True)


def test_summary_keeps_documents_without_a_language(spark):
    rows = [(1, "a b", "x", None), (2, "a b", None, None), (3, "c", "x", "en"), (4, "d", "x", "en"), (5, "e", "y", "en"), (6, "f", None, "sv")]
    df = spark.createDataFrame(rows, "doc_id long, text string, label_text string, language string")
    got = {r.language: (r.documents, r.duplicates, r.classes, r.imbalance) for r in profiling.corpus_summary(df).collect()}
    assert got == {None: (2, 1, 1, 1.0), "en": (3, 0, 2, 2.0), "sv": (1, 0, 0, None)}


def test_scratch_tables_are_removed(spark):
    with scratch(spark):
        table = settle(spark.range(3))
        path = table.inputFiles()[0].rsplit("/", 1)[0]
        assert table.count() == 3
    assert compression.stored_size(spark, path).first().size_mb == 0.0 and not remove_dir(spark, path)


def test_one_length_only(spark):
    df = spark.createDataFrame([(1, "a b c", "en")], "doc_id long, text string, language string")
    assert profiling.length_describe(df).first()["std"] is None
    assert [(r.bin, r.documents) for r in profiling.length_histogram(df).collect()] == [(0, 1)]


def test_classes(profiled):
    assert [(r.label_text, r.documents) for r in profiling.class_distribution(profiled).collect()] == [("x", 5), ("y", 3), ("z", 1)]
    got = profiling.class_imbalance(profiled).first()
    assert (got.most_common, got.least_common, got.imbalance_ratio) == ("x", "z", 5.0)
    assert profiling.language_distribution(profiled.drop("language")).count() == 0
    medians = {r.language: r.median_words for r in profiling.median_words_by_language(profiled).collect()}
    assert medians["en"] == statistics.median([4, 4, 1, 3]) and medians["sv"] == statistics.median([0, 0, 0, 90, 5])


def test_summary(profiled):
    got = {r.language: r for r in profiling.corpus_summary(profiled).collect()}
    assert (got["sv"].documents, got["sv"].empty, got["sv"].duplicates, got["sv"].classes) == (5, 3, 2, 3)
    profile = {r.language: r["count"] for r in profiling.profile_by_language(profiled).collect()}
    assert profile == {"en": 4, "sv": 2, "*": 6}
