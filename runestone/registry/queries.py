"""Every operator as a query on the driver's tables: ``(spark, sf_dir) -> DataFrame``.

``documents`` is the corpus (``lang`` is the language, ``source`` the category
name), ``pages`` holds HTML, ``embeddings`` holds vectors with ten labels, and news
posts are put together from ``conversations``. All rows and whole texts are used.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions import arrays as ax
from runestone.functions import text as tx
from runestone.functions import tokens as tk
from runestone.functions import vectors as vx
from runestone.operators import (
    artifact, cleaning, compression, evaluation, features, labels, language, names, network, profiling, sampling, subwords, tagging, training,
)
from runestone.plans import compression_job, corpus_build, scoring, training_job
from runestone.session import fresh_dir, settle
from runestone.sources import tables
from runestone.streaming import live, sessions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The driver's corpus has no Swedish or Finnish.
LANGUAGES = ["de", "en", "es", "fr"]
SUBWORD_LANGUAGES = ["de"]
LOGIT_SCALE = 20.0


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf: plain(function(spark, sf))
    return function


def plain(df: DataFrame) -> DataFrame:
    """Widen numbers, so both engines name the same types."""
    wide = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double"}
    return df.select(*[F.col(c).cast(wide[t]).alias(c) if t in wide else F.col(c) for c, t in df.dtypes])


# --- inputs ------------------------------------------------------------------

def table(spark: SparkSession, sf: str, name: str, key: str, *columns) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return tables.spread(df.select(key, *columns), key)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(
        spark, sf, "documents", "doc_id",
        "text", F.col("lang").alias("language"), F.col("source").alias("label_text"),
    )


def light_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The columns beside the text; too little work to spread."""
    return spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", F.col("lang").alias("language"), F.col("source").alias("label_text")
    )


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """News posts with headers, an attribution, a quote and a signature."""
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    parts = [
        F.lit("From: "), "role", F.lit("\nX-Turn: "), F.col("turn").cast("string"), F.lit("\n\nIn article <"),
        F.col("conv_id").cast("string"), F.lit("@news>\n"), "role", F.lit(" writes:\n\n> "), "text",
        F.lit("\nAB> quoted\n: colon\n"), "text", F.lit("\nSubject: tail\n-- \n"), "role", F.lit("\nsig"),
    ]
    return tables.spread(rows.select("conv_id", "turn", F.concat(*parts).alias("text")), "conv_id")


def gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """Place names of the nation and region tables."""
    nations = spark.read.parquet(f"{sf}/nation.parquet").select(
        F.lower("n_name").alias("name"), F.lit("GPE").alias("label"))
    regions = spark.read.parquet(f"{sf}/region.parquet").select(
        F.lower("r_name").alias("name"), F.lit("LOC").alias("label"))
    return nations.unionByName(regions)


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label")


def probabilities(spark: SparkSession, sf: str) -> DataFrame:
    """Softmax over the labels of the dot products of a whole vector with the label means."""
    rows = vectors(spark, sf)
    means = rows.select("label", F.posexplode("embedding").alias("at", "x")).groupBy("label", "at").agg(
        F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))
    classes = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("at", "mean"))).alias("entries"))
    # One row: the ten labels and 64 dimensions of the table.
    packed = classes.agg(F.transform(
        F.array_sort(F.collect_list(F.struct("label", "entries"))), lambda c: c["entries"]["mean"]).alias("_classes"))
    logits = F.transform("_classes", lambda c: LOGIT_SCALE * F.aggregate(
        F.zip_with(c, "embedding", lambda w, x: w * x.cast("double")), F.lit(0.0), lambda acc, x: acc + x))
    p = F.transform(ax.softmax(logits), lambda x: F.round(x, 7))
    return rows.select("vec_id", "label", "embedding", settle(packed).scalar().alias("_classes")).select(
        "vec_id", "label", p.alias("probability"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Language ids as labels, the length stand-in model as predictions."""
    names = F.array(*[F.lit(lang) for lang in LANGUAGES])
    return documents(spark, sf).select(
        "doc_id", "text", "language",
        (F.array_position(names, F.col("language")) - 1).cast("int").alias("label"),
        (F.length("text") % len(LANGUAGES)).alias("pred"),
        # The baseline always answers English.
        F.lit(LANGUAGES.index("en")).alias("baseline_pred"),
    )


def joined(column: Column) -> Column:
    return F.array_join(column, "|")


def entity_text(entities: Column) -> Column:
    return joined(F.transform(entities, lambda e: F.concat_ws(
        "~", e["text"], e["label"], e["tag"], e["count"].cast("string"))))


# --- sources and sinks -------------------------------------------------------

@query
def scan_corpus(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")


@query
def scan_csv_roundtrip(spark, sf):
    rows = documents(spark, sf).withColumn("label", F.length("label_text"))
    path = fresh_dir(spark, "csv")
    tables.write_csv(rows.select("doc_id", "text", "label", "label_text", "language"), path)
    return tables.scan_csv(spark, path)


@query
def label_dimension(spark, sf):
    return tables.label_dimension(
        light_documents(spark, sf).withColumn("label", F.length("label_text"))
    )


@query
def union_splits(spark, sf):
    split = sampling.stratified_split(documents(spark, sf), label="label_text")
    path = fresh_dir(spark, "splits")
    split.withColumnRenamed("language", "subset").write.partitionBy("subset", "split").parquet(path)
    return tables.scan_splits(spark, path, "en", ["train", "val"]).select("doc_id", "text", "label_text", "split")


@query
def demo_sample(spark, sf):
    return sampling.demo_sample(documents(spark, sf)).select("doc_id", "language", "text")


@query
def example_predictions(spark, sf):
    split = sampling.stratified_split(predictions(spark, sf))
    return training_job.example_predictions(split.filter(F.col("split") == "val"))


@query
def performance_report(spark, sf):
    scored = settle(predictions(spark, sf).drop("text"))
    report = spark.range(1).select(
        F.round(evaluation.accuracy(scored).scalar(), 4).alias("classification_accuracy"),
        F.round(evaluation.macro_f1(scored).scalar(), 4).alias("f1_score_macro"),
        F.round(evaluation.accuracy(scored, pred="baseline_pred").scalar(), 4).alias("baseline_accuracy"),
        F.round(evaluation.macro_f1(scored, pred="baseline_pred").scalar(), 4).alias("baseline_f1_macro"),
        F.array_join(scored.agg(F.array_sort(F.collect_set("language"))).scalar(), ",").alias("languages_supported"),
    )
    path = fresh_dir(spark, "report")
    tables.write_report(report, path)
    return tables.read_report(spark, path)


# --- schema, labels, filters -------------------------------------------------

@query
def standardize(spark, sf):
    raw = spark.read.parquet(f"{sf}/documents.parquet")
    return labels.standardize(raw, "text", "n_chars", "source", F.col("lang"), "doc_id")


@query
def label_map(spark, sf):
    return labels.label_map(light_documents(spark, sf))


@query
def label_map_en(spark, sf):
    return labels.language_label_map(light_documents(spark, sf), "en")


@query
def encode_labels(spark, sf):
    rows = light_documents(spark, sf)
    return labels.encode_labels(rows, labels.label_map(rows))


@query
def decode_labels(spark, sf):
    rows = light_documents(spark, sf)
    names = labels.label_map(rows)
    # Ids past the end of the map have no name.
    return labels.decode_labels(
        rows.select("doc_id", (F.col("doc_id") % 25).cast("int").alias("label")), names
    )


@query
def unknown_labels(spark, sf):
    rows = light_documents(spark, sf).withColumn("label_text", F.concat_ws("-", "label_text", "language"))
    return labels.unknown_labels(rows, labels.language_label_map(rows, "en"))


@query
def unsupported_language_rows(spark, sf):
    return labels.unsupported_language_rows(light_documents(spark, sf))


@query
def drop_ghosts(spark, sf):
    return cleaning.drop_ghosts(documents(spark, sf), 3).select("doc_id", "language")


@query
def clean_and_drop(spark, sf):
    return cleaning.clean_and_drop(documents(spark, sf)).select("doc_id", "clean_text")


@query
def low_confidence(spark, sf):
    p = F.col("probability")
    scored = probabilities(spark, sf).withColumn("confidence", F.round(F.array_max(p), 4))
    return scored.filter(F.col("confidence") < settings.LOW_CONFIDENCE).select("vec_id", "confidence")


# --- cleaning ----------------------------------------------------------------

def _cleaned(df: DataFrame, keys: list[str], cleaner: tx.Cleaner, column: str = "text") -> DataFrame:
    return tx.apply_cleaners(df, [cleaner], column, "clean_text").select(*keys, "clean_text")


def pages(spark, sf):
    return table(spark, sf, "pages", "page_id", "html")


@query
def clean_html(spark, sf):
    return _cleaned(pages(spark, sf), ["page_id"], tx.strip_tags, "html")


@query
def clean_urls(spark, sf):
    return _cleaned(pages(spark, sf), ["page_id"], tx.strip_urls, "html")


@query
def clean_emails(spark, sf):
    return _cleaned(documents(spark, sf), ["doc_id"], tx.strip_emails)


# One ligature and one accent to compose, since the tables hold none.
UNNORMALIZED = " \N{LATIN SMALL LIGATURE FI}n e\N{COMBINING ACUTE ACCENT}"


@query
def clean_nfkc(spark, sf):
    rows = documents(spark, sf).withColumn("text", F.concat("text", F.lit(UNNORMALIZED)))
    return _cleaned(rows, ["doc_id"], tx.normalize_nfkc)


@query
def clean_nfc(spark, sf):
    rows = documents(spark, sf).withColumn("text", F.concat("text", F.lit(UNNORMALIZED)))
    return _cleaned(rows, ["doc_id"], tx.normalize_nfc)


@query
def non_ascii_count(spark, sf):
    return documents(spark, sf).select("doc_id", tx.non_ascii_count(F.col("text")).alias("non_ascii"))


@query
def collapse_whitespace(spark, sf):
    rows = documents(spark, sf).withColumn(
        "text", F.concat(F.lit("\t "), F.regexp_replace("text", "\\. ", ". \n  "), F.lit(" \n")))
    return _cleaned(rows, ["doc_id"], tx.collapse_whitespace)


@query
def strip_edges(spark, sf):
    rows = documents(spark, sf).withColumn("text", F.concat(F.lit("\t \N{IDEOGRAPHIC SPACE}"), "text", F.lit(" \n")))
    return _cleaned(rows, ["doc_id"], tx.strip_edges)


@query
def clean_signature(spark, sf):
    return _cleaned(posts(spark, sf), ["conv_id", "turn"], tx.strip_signature)


@query
def clean_headers(spark, sf):
    return _cleaned(posts(spark, sf), ["conv_id", "turn"], tx.strip_headers)


@query
def clean_attribution(spark, sf):
    return _cleaned(posts(spark, sf), ["conv_id", "turn"], tx.strip_attribution)


@query
def clean_quotes(spark, sf):
    return _cleaned(posts(spark, sf), ["conv_id", "turn"], tx.strip_quotes)


@query
def clean_composite(spark, sf):
    cleaners = [tx.strip_tags, tx.strip_artifacts, tx.normalize_nfkc, tx.collapse_whitespace]
    return tx.apply_cleaners(pages(spark, sf), cleaners, "html", "clean_text").select("page_id", "clean_text")


@query
def sanitize(spark, sf):
    return tx.sanitize(documents(spark, sf)).select("doc_id", "clean_text")


@query
def sanitize_posts(spark, sf):
    return tx.sanitize(posts(spark, sf)).select("conv_id", "turn", "clean_text")


@query
def clean_corpus(spark, sf):
    return cleaning.clean_corpus(documents(spark, sf)).select("doc_id", "language", "text")


@query
def cleaning_impact(spark, sf):
    return cleaning.cleaning_impact(documents(spark, sf))


@query
def build_impact(spark, sf):
    """The same sums, observed while the corpus is written."""
    seen = Observation("impact")
    corpus_build.build_and_write(documents(spark, sf), fresh_dir(spark, "corpus"), languages=LANGUAGES, observation=seen)
    return cleaning.observed_impact(spark, seen, LANGUAGES)


# --- samples and splits ------------------------------------------------------

@query
def stratified_sample(spark, sf):
    return sampling.stratified_sample(documents(spark, sf), 200).select("doc_id", "label_text", "text")


@query
def stratified_split(spark, sf):
    return sampling.stratified_split(light_documents(spark, sf), label="language").select(
        "doc_id", "language", "split")


@query
def eval_sample(spark, sf):
    return sampling.eval_sample(documents(spark, sf), 100).select("doc_id", "text")


@query
def kfold_assign(spark, sf):
    return sampling.assign_folds(light_documents(spark, sf), 3, label="language")


# --- assembly ----------------------------------------------------------------

@query
def union_languages(spark, sf):
    raw = spark.read.parquet(f"{sf}/documents.parquet")
    return labels.union_corpora([
        labels.standardize(raw.filter(F.col("lang") == lang), "text", "n_chars", "source", lang, "doc_id")
        for lang in LANGUAGES
    ])


@query
def build_corpus(spark, sf):
    return corpus_build.build_corpus(documents(spark, sf), LANGUAGES)


@query
def normalize_entity_label(spark, sf):
    known = F.array(*[F.lit(name) for name in [*settings.ENTITY_TAGS, "UNLISTED"]])
    label = F.get(known, (F.col("doc_id") % (len(settings.ENTITY_TAGS) + 1)).cast("int"))
    return light_documents(spark, sf).select("doc_id", label.alias("label")).withColumn(
        "tag", tagging.entity_tag(F.col("label")))


@query
def merge_tags(spark, sf):
    rows = _tagged(spark, sf)
    return rows.select("doc_id", joined(tagging.merge_tags(F.col("entity_tags"), F.col("keywords"))).alias("tags"))


# --- profiles ----------------------------------------------------------------

@query
def missing_taxonomy(spark, sf):
    return profiling.missing_taxonomy(documents(spark, sf))


@query
def duplicates(spark, sf):
    return profiling.duplicates(documents(spark, sf))


@query
def length_describe(spark, sf):
    return profiling.length_describe(documents(spark, sf))


@query
def length_outliers(spark, sf):
    return profiling.length_outliers(documents(spark, sf))


@query
def length_histogram(spark, sf):
    return profiling.length_histogram(documents(spark, sf))


@query
def class_distribution(spark, sf):
    return profiling.class_distribution(light_documents(spark, sf), "language")


@query
def class_imbalance(spark, sf):
    return profiling.class_imbalance(light_documents(spark, sf), "language")


@query
def language_distribution(spark, sf):
    return profiling.language_distribution(light_documents(spark, sf))


@query
def median_words_by_language(spark, sf):
    return profiling.median_words_by_language(documents(spark, sf))


@query
def profile_by_language(spark, sf):
    return profiling.profile_by_language(documents(spark, sf))


@query
def corpus_summary(spark, sf):
    return profiling.corpus_summary(documents(spark, sf))


# --- languages ---------------------------------------------------------------

@query
def lang_profiles(spark, sf):
    return language.profile_rows(language.fit_profiles(documents(spark, sf)))


@query
def detect_language(spark, sf):
    rows = documents(spark, sf)
    return language.detect(rows, language.fit_profiles(rows)).select("doc_id", "detected", "score")


@query
def detect_saved_profiles(spark, sf):
    """Damaged texts against a profile that was written and read again; every row is returned."""
    rows = documents(spark, sf)
    path = fresh_dir(spark, "profiles")
    language.save_profiles(language.fit_profiles(rows), path)
    damaged = rows.withColumn("text", _damaged(F.col("text")))
    return language.detect(damaged, language.load_profiles(spark, path)).select("doc_id", "detected", "score")


@query
def route_language(spark, sf):
    return light_documents(spark, sf).select(
        "doc_id", "language", language.route_language(F.col("language")).alias("routed"))


def _damaged(text: Column) -> Column:
    """Some texts blanked and some stripped of letters, to show every status."""
    return (
        F.when(F.length("text") % 7 == 0, F.lit(" \t\n"))
        .when(F.length("text") % 7 == 1, F.regexp_replace(text, r"\p{L}", ""))
        .otherwise(text)
    )


@query
def detect_status(spark, sf):
    rows = documents(spark, sf).withColumn("text", _damaged(F.col("text")))
    return rows.select("doc_id", language.detect_status(F.col("text")).alias("status"))


# --- tokens ------------------------------------------------------------------

@query
def word_tokens(spark, sf):
    rows = documents(spark, sf).select("doc_id", tk.word_tokens(F.col("text")).alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), joined(F.col("t")).alias("tokens"))


@query
def truncate_tokens(spark, sf):
    rows = documents(spark, sf).select("doc_id", tk.truncate_tokens(tk.word_tokens(F.col("text"))).alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), joined(F.col("t")).alias("tokens"))


@query
def subword_vocab(spark, sf):
    return subwords.learn_subwords(documents(spark, sf))


def _encoder(spark, sf):
    return subwords.subword_encoder(subwords.learn_subwords(documents(spark, sf)))


@query
def subword_tokens(spark, sf):
    rows = documents(spark, sf).withColumn("t", subwords.subword_tokens(F.col("text"), _encoder(spark, sf)))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), joined(F.col("t")).alias("tokens"))


@query
def route_tokens(spark, sf):
    routed = subwords.route_tokens(documents(spark, sf), _encoder(spark, sf), SUBWORD_LANGUAGES)
    return routed.select("doc_id", "language", F.size("tokens").alias("n_tokens"), joined(F.col("tokens")).alias("tokens"))


# --- tags --------------------------------------------------------------------

def _mentioned(spark, sf):
    return tagging.entity_mentions(documents(spark, sf), gazetteer(spark, sf))


@query
def entity_mentions(spark, sf):
    return _mentioned(spark, sf).select("doc_id", F.explode("mentions").alias("m")).select(
        "doc_id", F.col("m.pos").alias("pos"), F.col("m.text").alias("text"), F.col("m.label").alias("label"))


@query
def entity_dedupe(spark, sf):
    entities = tagging.dedupe_entities(F.col("mentions"))
    return _mentioned(spark, sf).select("doc_id", F.posexplode(entities).alias("rank", "e")).select(
        "doc_id", "rank", "e.text", "e.label", "e.tag", F.col("e.count").alias("mentions"))


@query
def entity_majority(spark, sf):
    """Majority labels where mentions of one surface disagree: the label depends on the position."""
    relabelled = F.transform("mentions", lambda m: F.struct(
        m["text"].alias("text"),
        F.when(m["pos"] % 3 == 0, F.lit("ORG")).otherwise(F.lit("PERSON")).alias("label"), m["pos"].alias("pos")))
    entities = tagging.dedupe_entities(relabelled)
    return _mentioned(spark, sf).select("doc_id", F.posexplode(entities).alias("rank", "e")).select(
        "doc_id", "rank", "e.text", "e.label", F.col("e.count").alias("mentions"))


@query
def entity_tags(spark, sf):
    entities = _mentioned(spark, sf).withColumn("entities", tagging.dedupe_entities(F.col("mentions")))
    return entities.select("doc_id", joined(tagging.entity_tags(F.col("entities"))).alias("entity_tags"))


@query
def keyword_candidates(spark, sf):
    counts = tagging.keyword_frequencies(F.col("text"), F.col("mentions"), F.col("language"))
    return _mentioned(spark, sf).select("doc_id", F.explode(counts).alias("w")).select(
        "doc_id", "w.word", "w.n", "w.first")


@query
def top_keywords(spark, sf):
    counts = tagging.keyword_frequencies(F.col("text"), F.col("mentions"), F.col("language"))
    rows = _mentioned(spark, sf).withColumn("counts", counts)
    return rows.select("doc_id", F.posexplode(ax.most_common(F.col("counts"), settings.MAX_KEYWORDS)).alias(
        "rank", "word"))


def _tagged(spark, sf):
    return tagging.tag_documents(documents(spark, sf), gazetteer(spark, sf))


@query
def tag_documents(spark, sf):
    return _tagged(spark, sf).select(
        "doc_id", entity_text(F.col("entities")).alias("entities"), joined(F.col("entity_tags")).alias("entity_tags"),
        joined(F.col("keywords")).alias("keywords"), joined(F.col("tags")).alias("tags"))


@query
def tag_routed(spark, sf):
    rows = language.with_language(
        documents(spark, sf).withColumn("language", F.when(F.length("text") % 2 == 0, F.col("language"))),
        language.fit_profiles(documents(spark, sf)), supported=LANGUAGES)
    return tagging.tag_documents(rows, gazetteer(spark, sf)).select("doc_id", "language", joined(F.col("tags")).alias("tags"))


@query
def annotate_plugin(spark, sf):
    def load():
        def annotator(text, lang):
            return [(word, "ORG") for word in text.split() if word.isupper() and len(word) > 1]
        return annotator

    rows = documents(spark, sf)
    return tagging.annotate(rows, load).select(
        "doc_id", F.size("mentions").alias("n_mentions"),
        joined(F.transform("mentions", lambda m: m["text"])).alias("surfaces"), "error")


def passage_names(spark: SparkSession, sf: str) -> DataFrame:
    """The first four words of each benchmark passage, and the place names, as names of any case."""
    passages = spark.read.parquet(f"{sf}/benchmark.parquet").select(
        F.lower(F.substring_index("text", " ", 4)).alias("name"), F.lit("PASSAGE").alias("label"))
    return gazetteer(spark, sf).unionByName(passages.filter(F.col("name").rlike("^[a-z]+( [a-z]+)*$")))


@query
def name_mentions(spark, sf):
    found = names.find_names(documents(spark, sf), passage_names(spark, sf)).select("doc_id", F.explode("names").alias("n"))
    return found.groupBy("doc_id", F.lower("n.text").alias("name"), F.col("n.label").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query
def tag_counts_doc(spark, sf):
    return tagging.tag_counts_per_document(_tagged(spark, sf))


@query
def tag_counts_all(spark, sf):
    return tagging.tag_counts(_tagged(spark, sf))


# --- classifiers -------------------------------------------------------------

@query
def tfidf_vocab(spark, sf):
    return features.tfidf_vocabulary(documents(spark, sf)).withColumn("idf", F.round("idf", 6))


@query
def tfidf_weights(spark, sf):
    rows = documents(spark, sf)
    return features.tfidf_weights(rows, features.tfidf_vocabulary(rows)).withColumn("weight", F.round("weight", 6))


@query
def class_weights(spark, sf):
    return features.class_weights(light_documents(spark, sf), "language").withColumn("weight", F.round("weight", 6))


def _quality_split(spark, sf):
    """The documents with a quality label (low or high, whatever their language), cleaned and split."""
    quality = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").cast("int").alias("label"))
    return settle(training_job.clean_split(documents(spark, sf).join(quality, "doc_id")))


def _parts(split):
    return [split.filter(F.col("split") == name) for name in ("train", "val")]


def _metrics(fitted, validation):
    scored = settle(training.score(fitted.model, validation, ["label"]))
    return evaluation.evaluate(scored, probabilities="probability")


@query
def baseline_train(spark, sf):
    train, validation = _parts(_quality_split(spark, sf))
    return _metrics(training.train_baseline(train), validation)


@query
def baseline_predict(spark, sf):
    train, validation = _parts(_quality_split(spark, sf))
    return training.score(training.train_baseline(train).model, validation, ["doc_id", "label"]).drop("probability")


@query
def baseline_proba(spark, sf):
    train, validation = _parts(_quality_split(spark, sf))
    scored = training.score(training.train_baseline(train).model, validation, ["doc_id"])
    return scored.select("doc_id", F.posexplode("probability").alias("category_id", "probability"))


@query
def baseline_gradient(spark, sf):
    """The objective's gradient, computed apart from the optimizer, is far smaller than after its first step."""
    train, _ = _parts(_quality_split(spark, sf))
    fitted, begun = training.train_baseline(train), training.train_baseline(train, max_iter=1)
    flatter = training.largest_gradient(fitted, train) < 0.1 * training.largest_gradient(begun, train)
    return spark.range(1).select(F.lit(flatter).alias("flatter"), F.lit(len(training.linear_parts(fitted.model).weights)).alias("classes"))


@query
def baseline_proba_equal(spark, sf):
    """Probabilities of Spark ML against the same weights applied to TF-IDF vectors by hand."""
    train, validation = _parts(_quality_split(spark, sf))
    model = training.train_baseline(train).model
    scored = training.linear_probabilities(
        training.score(model, validation, ["doc_id", "clean_text"]), training.linear_parts(model), into="other")
    both = scored.select("doc_id", F.posexplode(F.arrays_zip("probability", "other")).alias("category_id", "p"))
    return both.select("doc_id", "category_id", (F.abs(F.col("p.probability") - F.col("p.other")) < 1e-9).alias("equal"))


@query
def training_history(spark, sf):
    train, _ = _parts(_quality_split(spark, sf))
    return training.train_baseline(train).history(spark)


@query
def training_history_falls(spark, sf):
    train, _ = _parts(_quality_split(spark, sf))
    losses = training.train_baseline(train).losses
    rows = list(zip(losses, losses[1:]))
    return spark.range(1).select(
        F.lit(len(rows) > 1).alias("moved"), F.lit(all(after <= before + 1e-9 for before, after in rows)).alias("falls"))


@query
def challenger_train(spark, sf):
    train, validation = _parts(_quality_split(spark, sf))
    return _metrics(training.train_challenger(train), validation)


def _network(spark, sf):
    train, validation = _parts(_quality_split(spark, sf))
    path = fresh_dir(spark, "network")
    return network.train_network(train, validation, path, epochs=4), path, validation


@query
def network_history(spark, sf):
    """Accuracy and loss on both splits after each epoch, and the epoch that is kept."""
    fit, _, _ = _network(spark, sf)
    return fit.history.withColumn("kept", F.col("epoch") == fit.best_epoch)


@query
def network_predict(spark, sf):
    """Validation documents as scored by the checkpoint that is read back."""
    fit, path, validation = _network(spark, sf)
    kept = network.load_network(spark, path, fit.best_epoch)
    scored = training.probability_prediction(kept.probabilities(validation))
    return scored.select("doc_id", "label", "pred", F.round(F.element_at("probability", 2), 6).alias("probability"))


CANDIDATES = [{"c": 0.1}, {"c": 1.0}]


@query
def select_model(spark, sf):
    train, validation = _parts(_quality_split(spark, sf))
    _, report = training.select_model(train, validation, CANDIDATES, fresh_dir(spark, "model"))
    return report


@query
def select_model_kept(spark, sf):
    """The kept candidate has the smallest loss, and the model that is returned has just that loss."""
    train, validation = _parts(_quality_split(spark, sf))
    model, report = training.select_model(train, validation, CANDIDATES, fresh_dir(spark, "model"))
    scored = training.score(model, validation, ["label"])
    loss = scored.agg(F.avg(-F.log(F.greatest(F.get("probability", F.col("label")), F.lit(1e-15))))).first()[0]
    smallest = report.agg(F.min("val_loss")).first()[0]
    return report.select(
        "candidate", (F.col("kept") == (F.col("val_loss") == smallest)).alias("kept_is_best"),
        F.lit(abs(loss - smallest) < 1e-6).alias("best_is_returned"))


@query
def model_roundtrip(spark, sf):
    """Per document, whether the model read back predicts what the saved one does."""
    train, validation = _parts(_quality_split(spark, sf))
    model = training.train_baseline(train).model
    path = fresh_dir(spark, "variants")
    model.write().overwrite().save(f"{path}/baseline")
    kept = training.score(model, validation, ["doc_id"])
    again = training.score(training.load_model(path, "baseline"), validation, ["doc_id"])
    return kept.join(again.select("doc_id", F.col("pred").alias("_pred"), F.col("probability").alias("_p")), "doc_id").select(
        "doc_id", ((F.col("pred") == F.col("_pred")) & (F.col("probability") == F.col("_p"))).alias("equal"))


@query
def train_report(spark, sf):
    parts = training_job.train_report(_quality_split(spark, sf), fresh_dir(spark, "best"))
    return parts["report"].select(
        "classification_accuracy", "f1_score_macro", "processing_speed_docs_per_sec",
        F.array_join("languages_supported", ",").alias("languages_supported"),
        F.to_json("per_language_accuracy").alias("per_language_accuracy"), "baseline_accuracy", "baseline_f1_macro")


@query
def cross_validate(spark, sf):
    return training.cross_validate(_quality_split(spark, sf))


@query
def compress_classifier(spark, sf):
    train, validation = _parts(_quality_split(spark, sf))
    return compression_job.compress_classifier(training.train_baseline(train), validation)[0]


def _length_model(classes: int):
    def load():
        def predict(texts):
            matrix = np.zeros((len(texts), classes))
            for i, text in enumerate(texts):
                matrix[i, len(text) % classes] = 0.9
            return matrix
        return predict

    return load


@query
def score_plugin(spark, sf):
    scored = training.score_plugin(documents(spark, sf), _length_model(4), text="text")
    return scored.select("doc_id", F.posexplode("probability").alias("category_id", "probability"))


@query
def softmax(spark, sf):
    return probabilities(spark, sf).select("vec_id", F.posexplode("probability").alias("category_id", "probability"))


@query
def eval_accuracy(spark, sf):
    return evaluation.accuracy(predictions(spark, sf)).select(F.round("accuracy", 6).alias("accuracy"))


@query
def eval_macro_f1(spark, sf):
    return evaluation.macro_f1(predictions(spark, sf)).select(F.round("f1_macro", 6).alias("f1_macro"))


@query
def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(predictions(spark, sf))


@query
def eval_auc(spark, sf):
    scored = probabilities(spark, sf)
    per_class = settle(evaluation.auc_by_class(scored))
    macro = evaluation.macro_auc(scored, per_class=per_class).select(F.lit("macro").alias("class"), "auc")
    return per_class.withColumn("class", F.col("class").cast("string")).unionByName(macro).withColumn("auc", F.round("auc", 6))


@query
def per_language_accuracy(spark, sf):
    return evaluation.per_language_accuracy(predictions(spark, sf))


@query
def lift_over_baseline(spark, sf):
    scored = predictions(spark, sf)
    lift = evaluation.lift_over_baseline(
        evaluation.accuracy(scored), evaluation.accuracy(scored, pred="baseline_pred"))
    return lift.select(F.round("accuracy", 6).alias("accuracy"),
                       F.round("baseline_accuracy", 6).alias("baseline_accuracy"), "lift_points")


# --- scoring -----------------------------------------------------------------

def flat_scores(scored: DataFrame, *more: str) -> DataFrame:
    return scored.select(
        "doc_id", "status", "language", "category", "category_id", "confidence", "low_confidence",
        joined(F.transform("top_categories", lambda t: t["category"])).alias("top_categories"),
        joined(F.col("tags")).alias("tags"), joined(F.col("keywords")).alias("keywords"),
        entity_text(F.col("entities")).alias("entities"), *more,
    )


@query
def score_batch(spark, sf):
    rows = documents(spark, sf)
    names = labels.label_map(light_documents(spark, sf))
    scored = scoring.score_batch(
        rows.select("doc_id", "text"), scoring.length_scorer(20), names, language.fit_profiles(rows),
        gazetteer(spark, sf), supported=LANGUAGES)
    return flat_scores(scored)


@query
def score_known_language(spark, sf):
    scored = scoring.score_batch(
        documents(spark, sf), scoring.length_scorer(20), None, None, gazetteer(spark, sf), supported=LANGUAGES)
    return flat_scores(scored)


@query
def score_trained(spark, sf):
    """The flagship on a fitted model: quality as the category."""
    train, _ = _parts(_quality_split(spark, sf))
    names = spark.createDataFrame([(0, "low"), (1, "high")], "label int, label_text string")
    scored = scoring.score_batch(
        documents(spark, sf), scoring.pipeline_scorer(training.train_baseline(train).model), names, None,
        gazetteer(spark, sf), supported=LANGUAGES)
    return flat_scores(scored)


def _shouts(fails: int):
    """An annotator of words in capitals that fails on every ``fails``-th length of text."""
    def load():
        def annotator(text, lang):
            if len(text) % fails == 0:
                raise ValueError("cannot annotate")
            return [(word, "ORG") for word in text.split() if word.isupper() and len(word) > 1]
        return annotator

    return load


@query
def score_annotated(spark, sf):
    scored = scoring.score_batch(documents(spark, sf), scoring.length_scorer(20), annotate=_shouts(3), supported=LANGUAGES)
    return flat_scores(scored, "error")


@query
def score_blank_status(spark, sf):
    rows = documents(spark, sf).withColumn("text", _damaged(F.col("text")))
    scored = scoring.score_batch(rows, scoring.length_scorer(20))
    return scored.select("doc_id", "status", F.size("tags").alias("n_tags"))


@query
def argmax_confidence(spark, sf):
    p = F.col("probability")
    return probabilities(spark, sf).select(
        "vec_id", ax.argmax(p).alias("category_id"), F.round(F.array_max(p), 4).alias("confidence"))


@query
def top3_categories(spark, sf):
    top = ax.top_entries(F.col("probability"), settings.TOP_CATEGORIES)
    return probabilities(spark, sf).select("vec_id", F.posexplode(top).alias("rank", "t")).select(
        "vec_id", "rank", "t.category_id", F.round("t.probability", 4).alias("probability"))


@query
def benchmark(spark, sf):
    return scoring.benchmark(score_known_language(spark, sf))


# --- compression -------------------------------------------------------------

def _weights(spark, sf):
    """Every vector as a tensor; odd labels stand for tensors of rank 1."""
    return vectors(spark, sf).select(
        F.col("vec_id").cast("string").alias("tensor"), (2 - F.col("label") % 2).alias("rank"),
        F.col("embedding").alias("values"))


def _long(weights: DataFrame, values: str = "values") -> DataFrame:
    return weights.select("tensor", F.posexplode(values).alias("idx", "w"))


@query
def prune_vectors(spark, sf):
    rows = vectors(spark, sf).withColumn("embedding", vx.prune(F.col("embedding"), settings.TARGET_SPARSITY))
    return rows.select("vec_id", F.posexplode("embedding").alias("idx", "w"))


@query
def prune_report(spark, sf):
    return compression.prune_report(compression.prune_tensors(_weights(spark, sf)))


@query
def prune_long(spark, sf):
    """The vectors of one label are one tensor, its entries numbered by vector and position."""
    entries = vectors(spark, sf).select(
        F.col("label").cast("string").alias("tensor"), "vec_id", F.posexplode("embedding").alias("at", "w"))
    return compression.prune_long(entries.select("tensor", (F.col("vec_id") * 64 + F.col("at")).alias("idx"), "w"))


@query
def fp16_vectors(spark, sf):
    return _long(compression.fp16_tensors(_weights(spark, sf)))


@query
def int8_vectors(spark, sf):
    coded = compression.int8_tensors(_weights(spark, sf))
    return coded.select("tensor", F.posexplode("codes").alias("idx", "code"))


@query
def artifact_roundtrip(spark, sf):
    """Pruned vectors written as a compressed artifact and read back: what each keeps, weight for weight."""
    rows = vectors(spark, sf).select(F.col("vec_id").cast("string").alias("tensor"), F.lit(2).alias("rank"), F.col("embedding").alias("values"))
    path = fresh_dir(spark, "artifact")
    artifact.write_artifact(compression.prune_tensors(rows), path)
    kept = F.filter("values", lambda w: w != 0)
    return artifact.read_artifact(spark, path).select(
        F.col("tensor").cast("long").alias("vec_id"), F.size("values").alias("params"), F.size(kept).alias("kept"),
        F.round(F.aggregate(kept, F.lit(0.0), lambda acc, w: acc + F.abs(w.cast("double"))), 6).alias("weight"))


@query
def artifact_size(spark, sf):
    sized = [
        compression.artifact_size(_weights(spark, sf), size).select(F.lit(name).alias("variant"), "params", "size_mb")
        for name, size in compression.BYTES.items()
    ]
    return reduce(DataFrame.unionByName, sized)


@query
def compression_report(spark, sf):
    rows = vectors(spark, sf)
    return compression_job.compression_report(compression.centroid_weights(rows), rows)


@query
def optimize_weights(spark, sf):
    return compression_job.optimize(vectors(spark, sf))


# --- streams -----------------------------------------------------------------

STREAM_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _score_stream(spark, sf, profiles=None):
    # As a glob the path may be a table's folder or a single file.
    arrived = live.document_stream(spark, f"{sf}/documents.parque[t]", STREAM_SCHEMA)
    given = F.col("lang") if profiles is None else F.when(F.length("text") % 2 == 0, F.col("lang"))
    rows = arrived.select("doc_id", "text", given.alias("language"))
    return live.score_stream(
        rows, scoring.length_scorer(20), partitions=spark.sparkContext.defaultParallelism, gazetteer=gazetteer(spark, sf),
        profiles=profiles, supported=LANGUAGES)


@query
def stream_score(spark, sf):
    path = fresh_dir(spark, "scored")
    live.append_to(_score_stream(spark, sf), path, fresh_dir(spark, "progress")).awaitTermination()
    return flat_scores(spark.read.parquet(path))


@query
def stream_detect(spark, sf):
    """Half of the documents arrive without a language."""
    path = fresh_dir(spark, "scored")
    profiles = language.fit_profiles(documents(spark, sf))
    live.append_to(_score_stream(spark, sf, profiles), path, fresh_dir(spark, "progress")).awaitTermination()
    return flat_scores(spark.read.parquet(path))


@query
def stream_tag_counts(spark, sf):
    path = fresh_dir(spark, "tags")
    live.replace_at(
        live.stream_tag_counts(_score_stream(spark, sf)), path, fresh_dir(spark, "progress")).awaitTermination()
    return live.latest_table(spark, path)


@query
def stream_monitor(spark, sf):
    path = fresh_dir(spark, "monitor")
    live.replace_at(live.monitor(_score_stream(spark, sf)), path, fresh_dir(spark, "progress")).awaitTermination()
    return live.latest_table(spark, path).withColumn("mean_confidence", F.round("mean_confidence", 6))


@query
def stream_session_tags(spark, sf):
    """Event types per user since the user's last error, which clears the history."""
    path = fresh_dir(spark, "sessions")
    arrived = spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string, value double, props string").parquet(
        f"{sf}/events.parque[t]")
    history = sessions.session_history(
        arrived, "user_id", "ts", F.array("event_type"), F.col("event_type") == "error", lateness=timedelta(days=3650))
    live.append_to(history, path, fresh_dir(spark, "progress")).awaitTermination()
    return sessions.newest(spark.read.parquet(path), "session").filter("tag IS NOT NULL").select("session", "tag", "n")


@query
def stream_frequent_words(spark, sf):
    """Words that make up more than a 400th of all, with whether the bounded summary of a stream holds their count."""
    path, size = fresh_dir(spark, "frequent"), 400
    words = F.explode(tk.word_tokens(F.lower("text"))).alias("tag")
    arrived = live.document_stream(spark, f"{sf}/documents.parque[t]", STREAM_SCHEMA).select(words)
    live.append_to(sessions.frequent_tags(arrived, size=size), path, fresh_dir(spark, "progress")).awaitTermination()
    exact = settle(documents(spark, sf).select(words).groupBy("tag").agg(F.count(F.lit(1)).alias("n")))
    often = exact.filter(F.col("n") * size > exact.agg(F.sum("n")).scalar())
    held = F.col("n").between(F.col("at_least"), F.col("at_most"))
    return often.join(sessions.frequent_counts(spark.read.parquet(path)), "tag", "left").select("tag", "n", F.coalesce(held, F.lit(False)).alias("held"))
