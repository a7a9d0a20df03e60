"""Entities, keywords and tags.

A document's mentions and keywords never leave its row: they are arrays built by
sorting inside the row, so tagging needs no shuffle and also runs on a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions.arrays import majority_labels, most_common, word_frequencies
from runestone.functions.arrow import in_slices, list_ends, lists_of
from runestone.functions.text import strip_edges
from runestone.functions.tokens import LETTER_RUN
from runestone.operators.scaling import join_dimension
from runestone.session import settle

# Repeated groups are possessive: Java would otherwise recurse once per repetition,
# and a long run of capitalised words would overflow the stack.
# One alternative per kind of mention; the last one swallows ordinary words, so a
# name is only found at the start of a word.
NUMBER = r"[0-9]+(?:[.,][0-9]+)*+"
MENTION = "|".join([
    r"[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    r"[0-9]{1,2}:[0-9]{2}",
    rf"[$\x{{20ac}}\x{{a3}}] ?{NUMBER}",
    rf"{NUMBER} ?%",
    NUMBER,
    r"\p{Lu}[\p{L}\p{M}]+(?: \p{Lu}[\p{L}\p{M}]+)*+",
])
# A whole word token that is all letters.
CANDIDATE = (
    rf"(?<![\p{{L}}\p{{M}}\p{{N}}])\p{{L}}{{{settings.MIN_KEYWORD_LENGTH},}}+(?![\p{{M}}\p{{N}}])"
)
MENTION_OR_WORD = rf"({MENTION})|[\p{{L}}\p{{M}}\p{{N}}]+"


def raw_mentions(text: Column) -> Column:
    """Surface forms of possible mentions, in textual order."""
    found = F.regexp_extract_all(text, F.lit(MENTION_OR_WORD), F.lit(1))
    return F.filter(found, lambda m: F.length(m) > 0)


def rule_label(surface: Column) -> Column:
    """Label of a surface form by its shape; NULL for a single capitalised word."""
    head = F.substring(surface, 1, 1)
    return (
        F.when(surface.contains("@"), F.lit("EMAIL"))
        .when(surface.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.lit("DATE"))
        .when(surface.rlike("^[0-9]{1,2}:[0-9]{2}$"), F.lit("TIME"))
        .when(head.isin("$", "€", "£"), F.lit("MONEY"))
        .when(surface.endswith("%"), F.lit("PERCENT"))
        .when(head.rlike("^[0-9]"), F.lit("CARDINAL"))
        .when(surface.contains(" "), F.lit("MISC"))
    )


def listed_names(gazetteer: DataFrame) -> DataFrame:
    """One label per name, the first in order; names compare in lower case, and rows
    without a name or label are left out."""
    return (
        gazetteer.filter(F.col("name").isNotNull() & F.col("label").isNotNull())
        .groupBy(F.lower("name").alias("name")).agg(F.min("label").alias("label"))
    )


def name_lookup(
    gazetteer: DataFrame, max_rows: int = settings.GAZETTEER_MAX_ROWS, max_bytes: int = settings.BROADCAST_MAX_BYTES
) -> Callable[[Column], Column]:
    """A function on columns, array of names -> array of their labels (NULL where unlisted).

    The names are measured and sent to the workers, so that a document stays in its row,
    on a stream too. A gazetteer beyond the bounds raises; ``entity_mentions`` then joins.
    """
    names = settle(listed_names(gazetteer))
    size = names.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("name") + F.octet_length("label")).alias("bytes")).first()
    if size.rows > max_rows or (size.bytes or 0) > max_bytes:
        raise OverflowError(f"a gazetteer of {size.rows} names and {size.bytes} bytes is not sent around")
    shared = names.sparkSession.sparkContext.broadcast({row.name: row.label for row in names.collect()})

    @F.arrow_udf("array<string>")
    def lookup(batch: pa.Array) -> pa.Array:
        label = shared.value.get

        def documents(lists: pa.Array) -> pa.Array:
            found = lists.flatten().dictionary_encode()
            labels = pa.array([label(name) for name in found.dictionary.to_pylist()], pa.string())
            return lists_of(list_ends(lists), labels.take(found.indices), lists)

        return in_slices(documents, batch)

    return lookup


def entity_mentions(
    df: DataFrame,
    gazetteer: DataFrame | None = None,
    text: str = "text",
    key: str = "doc_id",
    max_rows: int = settings.GAZETTEER_MAX_ROWS,
) -> DataFrame:
    """Add ``mentions array<struct<text, label, pos>>``, in textual order.

    ``gazetteer`` is ``(name, label)``; it wins over the rules, and a name with two
    labels has the first in order. Documents stay in their rows. Only a gazetteer too
    large to be sent around is joined, with the same result, by ``key``.
    """
    df = df.withColumn("_raw", raw_mentions(F.col(text)))

    def labelled(label: Callable[[Column, Column], Column]) -> Column:
        entries = F.transform("_raw", lambda surface, i: F.struct(
            surface.alias("text"), label(surface, i).alias("label"), i.alias("pos")))
        return F.filter(entries, lambda m: m["label"].isNotNull())

    if gazetteer is None:
        return df.withColumn("mentions", labelled(lambda s, _: rule_label(s))).drop("_raw")
    try:
        lookup = name_lookup(gazetteer, max_rows)
    except OverflowError:
        return _joined_mentions(df, gazetteer, text, key)
    listed = lookup(F.transform("_raw", F.lower))
    return df.withColumn("_listed", listed).withColumn(
        "mentions", labelled(lambda s, i: F.coalesce(F.get(F.col("_listed"), i), rule_label(s)))
    ).drop("_raw", "_listed")


def _joined_mentions(df: DataFrame, gazetteer: DataFrame, text: str, key: str) -> DataFrame:
    seen = df.select(key, F.posexplode("_raw").alias("pos", "text")).withColumn("name", F.lower("text"))
    labels = listed_names(gazetteer).withColumnRenamed("label", "_listed")
    in_order = F.array_sort(F.collect_list(F.struct("pos", "text", "label")))
    found = (
        join_dimension(seen, labels, ["name"], "left", salt_by=key)
        .withColumn("label", F.coalesce("_listed", rule_label(F.col("text"))))
        .filter(F.col("label").isNotNull())
        .groupBy(key).agg(F.transform(in_order, lambda m: F.struct(
            m["text"].alias("text"), m["label"].alias("label"), m["pos"].alias("pos"))).alias("mentions"))
    )
    joined = df.drop("_raw").join(found, key, "left")
    empty = F.array().cast("array<struct<text:string,label:string,pos:int>>")
    return joined.withColumn("mentions", F.when(F.col(text).isNotNull(), F.coalesce("mentions", empty)))


def entity_tag(label: Column) -> Column:
    """Unified tag of an entity label; labels outside the map are 'misc'."""
    known = F.create_map(*[F.lit(v) for pair in settings.ENTITY_TAGS.items() for v in pair])
    return F.coalesce(F.element_at(known, label), F.lit(settings.UNKNOWN_TAG))


def dedupe_entities(mentions: Column) -> Column:
    """One entity per surface form: majority label, unified tag, number of mentions."""
    return F.transform(majority_labels(mentions), lambda e: F.struct(
        e["text"].alias("text"), e["label"].alias("label"),
        entity_tag(e["label"]).alias("tag"), e["count"].alias("count")))


def entity_tags(entities: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(entities, lambda e: e["tag"])))


def stop_words(language: Column) -> Column:
    """The stop words of a language; those of the default for any other."""
    default = F.array(*[F.lit(w) for w in settings.STOP_WORDS[settings.DEFAULT_LANGUAGE]])
    chosen = None
    for lang, words in settings.STOP_WORDS.items():
        if lang == settings.DEFAULT_LANGUAGE:
            continue
        listed = F.array(*[F.lit(w) for w in words])
        chosen = F.when(language == lang, listed) if chosen is None else chosen.when(language == lang, listed)
    return chosen.otherwise(default)


def candidate_words(text: Column) -> Column:
    """Alphabetic words of at least three letters, lower-cased, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), F.lower)


def _entity_words(mentions: Column) -> Column:
    return F.flatten(F.transform(
        mentions, lambda m: F.regexp_extract_all(F.lower(m["text"]), F.lit(LETTER_RUN), F.lit(0))))


def keyword_frequencies(text: Column, mentions: Column, language: Column) -> Column:
    """``array<struct<word, n, first>>`` of content words: not in an entity, not a stop word."""
    return word_frequencies(candidate_words(text), F.concat(stop_words(language), _entity_words(mentions)))


def lexicon_frequencies(df: DataFrame, lexicon: DataFrame, parts: Sequence[str] = ("NOUN", "PROPN"),
                        key: str = "doc_id") -> DataFrame:
    """Replace the forms in ``keyword_counts`` by lemmas of the given parts of speech.

    ``lexicon`` is ``(language, form, lemma, pos)``. Forms outside it are kept as
    they are; forms listed only with other parts of speech are dropped.
    """
    forms = df.select(key, "language", F.explode("keyword_counts").alias("w")).select(
        key, "language", F.col("w.word").alias("form"), F.col("w.n").alias("n"), F.col("w.first").alias("first")
    )
    wanted = F.col("pos").isin(list(parts))
    entries = lexicon.groupBy("language", "form").agg(
        F.min(F.when(wanted, F.col("lemma"))).alias("lemma"), F.lit(True).alias("listed")
    )
    lemmas = (
        join_dimension(forms, entries, ["language", "form"], "left", salt_by=key)
        .withColumn("word", F.when(F.col("listed"), F.col("lemma")).otherwise(F.col("form")))
        .filter(F.col("word").isNotNull())
        .groupBy(key, "word").agg(F.sum("n").cast("int").alias("n"), F.min("first").alias("first"))
        .groupBy(key).agg(F.collect_list(F.struct("word", "n", "first")).alias("keyword_counts"))
    )
    empty = F.array().cast("array<struct<word:string,n:int,first:int>>")
    return df.drop("keyword_counts").join(lemmas, key, "left").withColumn(
        "keyword_counts", F.coalesce("keyword_counts", empty)
    )


def merge_tags(tags: Column, keywords: Column) -> Column:
    return F.array_sort(F.array_union(tags, keywords))


def tag_documents(
    df: DataFrame,
    gazetteer: DataFrame | None = None,
    lexicon: DataFrame | None = None,
    text: str = "text",
    key: str = "doc_id",
    max_keywords: int = settings.MAX_KEYWORDS,
    strict: bool = False,
) -> DataFrame:
    """Add ``entities, entity_tags, keywords, tags``. ``language`` picks the stop words
    and is reported as given. Blank texts get empty arrays; ``strict`` raises.

    A ``mentions`` column, for example from ``annotate``, is used instead of the rules.
    """
    if strict and not df.filter(F.coalesce(F.length(strip_edges(F.col(text))), F.lit(0)) == 0).isEmpty():
        raise ValueError("cannot tag an empty document")
    df = df.withColumn("_text", F.coalesce(text, F.lit("")))
    if "mentions" not in df.columns:
        df = entity_mentions(df, gazetteer, "_text", key)
    df = df.withColumn("entities", dedupe_entities(F.col("mentions")))
    df = df.withColumn(
        "keyword_counts", keyword_frequencies(F.col("_text"), F.col("mentions"), F.col("language"))
    )
    if lexicon is not None:
        df = lexicon_frequencies(df, lexicon, key=key)
    df = df.withColumn("keywords", most_common(F.col("keyword_counts"), max_keywords))
    df = df.withColumn("entity_tags", entity_tags(F.col("entities")))
    df = df.withColumn("tags", merge_tags(F.col("entity_tags"), F.col("keywords")))
    return df.drop("_text", "mentions", "keyword_counts")


def tag_occurrences(entities: Column, keywords: Column) -> Column:
    """One entry per entity and per keyword of a document."""
    return F.concat(F.transform(entities, lambda e: e["tag"]), keywords)


def tag_counts_per_document(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, tag, n)``, counted inside the row."""
    counts = word_frequencies(tag_occurrences(F.col("entities"), F.col("keywords")))
    return tagged.select(key, F.explode(counts).alias("t")).select(
        key, F.col("t.word").alias("tag"), F.col("t.n").alias("n")
    )


def tag_counts(tagged: DataFrame) -> DataFrame:
    """Cumulative ``(tag, n)``; also valid on a stream, where the state is one row per tag."""
    return (
        tagged.select(F.explode(tag_occurrences(F.col("entities"), F.col("keywords"))).alias("tag"))
        .groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    )


def annotate(
    df: DataFrame,
    load: Callable[[], Callable[[str, str], Sequence[tuple[str, str]]]],
    text: str = "text",
) -> DataFrame:
    """Add ``mentions`` and ``error`` from an external annotator.

    ``load()`` is called once per task and returns ``annotator(text, language) ->
    [(surface, label), ...]``. A document whose annotator fails gets no mentions and
    the reason in ``error``; the job goes on.
    """

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        annotator = load()
        for texts, languages in batches:
            mentions, errors = [], []
            for document, language in zip(texts, languages):
                try:
                    found = annotator(document, language)
                    mentions.append([
                        {"text": surface, "label": label, "pos": i} for i, (surface, label) in enumerate(found)
                    ])
                    errors.append(None)
                except Exception as problem:  # noqa: BLE001 - any plug-in failure is data
                    mentions.append([])
                    errors.append(f"{type(problem).__name__}: {problem}")
            yield pd.DataFrame({"mentions": mentions, "error": pd.Series(errors, dtype="object")})

    schema = "mentions array<struct<text:string,label:string,pos:int>>, error string"
    udf = F.pandas_udf(run, schema).asNondeterministic()
    return df.withColumn("_found", udf(F.col(text), F.col("language"))).withColumns(
        {"mentions": F.col("_found.mentions"), "error": F.col("_found.error")}
    ).drop("_found")
