"""Language identification from character n-grams, as two jobs: fit and predict.

Detection leaves the text in its row: the profile is measured, sent to the workers,
and looked up in Arrow batches, so it needs no shuffle and runs on a stream too.

Scores are whole micro-nats (1e-6 of a natural logarithm). Integer sums do not
depend on the order of addition, so a document gets the same language on any
cluster and after any retry.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runestone import settings
from runestone.functions import text as tx
from runestone.functions.arrays import word_frequencies
from runestone.functions.arrow import in_slices
from runestone.operators.scaling import join_dimension, top_rows
from runestone.session import settle

LETTERS = r"[\p{L}\p{M}]+"
MICRO = 1_000_000
# Words whose score is kept ready-made: few words make up most of any text.
COMMON_WORDS = 50_000
# Further words whose score a worker remembers.
REMEMBERED_WORDS = 200_000


@dataclass(frozen=True)
class LanguageProfiles:
    """``grams``: (gram, scores) and ``words``: (word, scores), the sum over the grams
    of the commonest words. ``scores`` has one bigint per language, in order."""

    grams: DataFrame
    words: DataFrame
    languages: list[str]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0))


def _grams(word: Column) -> Column:
    """1- to 3-grams of a word; the longer ones also see its edges as spaces."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    # A look-ahead matches at every character, so one pass yields all windows.
    return F.concat(
        F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0)),
        F.regexp_extract_all(padded, F.lit("(?s)(?=(..))"), F.lit(1)),
        F.regexp_extract_all(padded, F.lit("(?s)(?=(...))"), F.lit(1)),
    )


def fit_profiles(
    corpus: DataFrame, text: str = "text", language: str = "language", common_words: int = COMMON_WORDS,
    max_languages: int = 1000,
) -> LanguageProfiles:
    """Add-one smoothed log-probabilities of every gram in every language.

    Languages are columns of the profile, so their number is bounded by a parameter. Words are counted first, so grams are only taken of distinct words; counting
    combines on the map side, so a common word or gram is no hot key.
    """
    labelled = corpus.filter(F.col(language).isNotNull())
    names = labelled.select(language).distinct().limit(max_languages + 1).collect()
    if not names:
        raise ValueError("no labelled text to learn languages from")
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages = sorted(row[0] for row in names)
    columns = [f"n{i}" for i in range(len(languages))]
    words = settle(
        # Counted inside the row first: a text repeats most of its words.
        labelled.select(F.col(language).alias("_of"), F.explode(word_frequencies(_words(F.col(text)))).alias("w"))
        .groupBy(F.col("w.word").alias("word"))
        .agg(*[F.sum(F.when(F.col("_of") == lang, F.col("w.n")).otherwise(0)).alias(c) for c, lang in zip(columns, languages)])
    )
    counts = settle(
        words.select(*columns, F.explode(_grams(F.col("word"))).alias("gram"))
        .groupBy("gram").agg(*[F.sum(c).alias(c) for c in columns])
    )
    totals = counts.agg(F.count(F.lit(1)).alias("grams"), *[F.sum(c).alias(c) for c in columns]).first()
    grams = counts.select("gram", F.array(*[
        F.round(
            F.log((F.col(c) + 1).cast("double") / F.lit(float((totals[c] or 0) + totals.grams))) * MICRO
        ).cast("long")
        for c in columns
    ]).alias("scores"))
    counted = words.select("word", sum(F.col(c) for c in columns).alias("n"))
    common = top_rows(counted, "n", "word", common_words)
    spelled = common.select("word", F.explode(_grams(F.col("word"))).alias("gram"))
    scored = join_dimension(spelled, grams, ["gram"], "inner", salt_by="word", settled=True)
    ready = scored.groupBy("word").agg(
        F.array(*[F.sum(F.get("scores", F.lit(i))) for i in range(len(languages))]).alias("scores"))
    return LanguageProfiles(grams, settle(ready), languages)


def profile_rows(profiles: LanguageProfiles) -> DataFrame:
    """``(language, gram, score)``."""
    names = F.array(*[F.lit(lang) for lang in profiles.languages])
    return profiles.grams.select(
        "gram", F.posexplode("scores").alias("_i", "score")
    ).select(F.get(names, F.col("_i")).alias("language"), "gram", "score")


def save_profiles(profiles: LanguageProfiles, path: str) -> None:
    """Write a profile below ``path``, to be used without fitting again."""
    root = path.rstrip("/")
    profiles.grams.write.parquet(f"{root}/grams")
    profiles.words.write.parquet(f"{root}/words")
    spark = profiles.grams.sparkSession
    spark.createDataFrame(list(enumerate(profiles.languages)), "i int, language string").write.parquet(f"{root}/languages")


def load_profiles(spark: SparkSession, path: str) -> LanguageProfiles:
    root = path.rstrip("/")
    names = spark.read.parquet(f"{root}/languages").orderBy("i").collect()
    return LanguageProfiles(
        spark.read.parquet(f"{root}/grams"), spark.read.parquet(f"{root}/words"), [row.language for row in names])


def spell(word: str) -> list[str]:
    """The grams of a word, as ``_grams`` has them."""
    padded = f" {word} "
    return [*word, *(padded[i:i + 2] for i in range(len(padded) - 1)), *(padded[i:i + 3] for i in range(len(padded) - 2))]


def row_detector(
    profiles: LanguageProfiles, max_rows: int = settings.PROFILE_MAX_ROWS, max_bytes: int = settings.BROADCAST_MAX_BYTES
) -> Callable[[Column], Column] | None:
    """A function on columns, text -> struct<detected, score>; None for a profile too large to be sent around."""
    tables, rows, size = [], 0, 0
    for table, name in ((profiles.grams, "gram"), (profiles.words, "word")):
        table = table.select(F.col(name).alias("name"), "scores")
        measured = table.agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("name") + 8 * F.size("scores")).alias("bytes")).first()
        rows, size = rows + measured.rows, size + (measured.bytes or 0)
        tables.append(table)
    if rows > max_rows or size > max_bytes:
        return None
    grams, words = ({row.name: tuple(row.scores) for row in table.collect()} for table in tables)
    languages = profiles.languages
    shared = profiles.grams.sparkSession.sparkContext.broadcast((grams, words))
    order = sorted(range(len(languages)), key=languages.__getitem__)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of_gram, of_word = shared.value
        remembered: dict[str, tuple[int, ...] | None] = {}

        def score(word: str) -> tuple[int, ...] | None:
            """None for a word without a known gram."""
            if word in of_word:
                return of_word[word]
            if word not in remembered:
                if len(remembered) >= REMEMBERED_WORDS:
                    remembered.clear()
                known = [of_gram[g] for g in spell(word) if g in of_gram]
                remembered[word] = tuple(map(sum, zip(*known))) if known else None
            return remembered[word]

        def documents(texts: pa.Array) -> pa.Array:
            found = []
            for text in texts.to_pylist():
                sums = None
                for word, n in Counter(text.split(" ")).items() if text else ():
                    own = score(word)
                    if own is not None:
                        sums = [s + n * x for s, x in zip(sums or [0] * len(languages), own)]
                if sums is None:
                    found.append((None, None))
                else:
                    best = max(order, key=lambda i: sums[i])  # the first name on a tie
                    found.append((languages[best], sums[best]))
            return pa.StructArray.from_arrays(
                [pa.array([d for d, _ in found], pa.string()), pa.array([s for _, s in found], pa.int64())], ["detected", "score"])

        for batch in batches:
            yield in_slices(documents, batch)

    udf = F.arrow_udf(run, "detected string, score long").asNondeterministic()
    # The JVM finds the words, as it does when profiles are fitted.
    return lambda text: udf(F.array_join(_words(text), " "))


def detect(
    df: DataFrame, profiles: LanguageProfiles, text: str = "text", key: str = "doc_id",
    max_rows: int = settings.PROFILE_MAX_ROWS,
) -> DataFrame:
    """``(key, detected, score)`` of every row: the language with the highest score, the
    first name on a tie, NULL for a text without letters or without a known gram.

    A profile that is too large to be sent around is joined to (key, word) rows.
    """
    detector = row_detector(profiles, max_rows)
    if detector is not None:
        return df.select(key, detector(F.col(text)).alias("_found")).select(key, "_found.detected", "_found.score")
    return _detect_joined(df, profiles, text, key)


def _detect_joined(df: DataFrame, profiles: LanguageProfiles, text: str, key: str) -> DataFrame:
    # A document without words keeps its row, as a NULL word.
    words = df.select(key, F.explode_outer(word_frequencies(_words(F.col(text)))).alias("w")).select(
        key, F.col("w.word").alias("word"), F.col("w.n").alias("n")
    )
    ready = profiles.words.withColumnRenamed("scores", "word_scores")
    known = join_dimension(words, ready, ["word"], "left", salt_by=key, settled=True)
    # A word with a ready score stays one row without grams, any other is spelled out.
    spelled = known.select(key, "n", "word_scores", F.explode_outer(
        F.when(F.col("word_scores").isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(_grams(F.col("word")))
    ).alias("gram"))
    scored = join_dimension(spelled, profiles.grams, ["gram"], "left", salt_by=key, settled=True)
    score = F.coalesce("word_scores", "scores")
    # A document's words sit in one task, so partial sums leave one row per document.
    sums = scored.select(key, "n", score.alias("scores")).groupBy(key).agg(*[
        F.sum(F.col("n") * F.get("scores", F.lit(i))).alias(f"s{i}")
        for i in range(len(profiles.languages))
    ])
    ranked = F.sort_array(F.array(*[
        F.struct((-F.col(f"s{i}")).alias("cost"), F.lit(lang).alias("language"))
        for i, lang in enumerate(profiles.languages)
    ]))
    best = F.get(ranked, F.lit(0))
    named = F.when(best["cost"].isNotNull(), best["language"])
    return sums.select(key, named.alias("detected"), (-best["cost"]).alias("score"))


def detect_status(text: Column) -> Column:
    """'blank', 'no_letters' or 'ok'."""
    blank = text.isNull() | (F.length(tx.strip_edges(text)) == 0)
    return F.when(blank, F.lit("blank")).when(~text.rlike(r"\p{L}"), F.lit("no_letters")).otherwise(F.lit("ok"))


def require_detectable(df: DataFrame, text: str = "text") -> DataFrame:
    """Strict mode: raise when a text is blank or has no letters."""
    bad = df.filter(detect_status(F.col(text)) != "ok")
    if not bad.isEmpty():
        raise ValueError("cannot detect the language of a blank text or a text without letters")
    return df


def route_language(
    detected: Column,
    supported: Sequence[str] = settings.SUPPORTED_LANGUAGES,
    default: str = settings.DEFAULT_LANGUAGE,
) -> Column:
    """The language itself when it is supported, else the default; NULL is a failed detection."""
    return F.when(detected.isin(list(supported)), detected).otherwise(F.lit(default))


def with_language(
    df: DataFrame,
    profiles: LanguageProfiles | None,
    text: str = "text",
    key: str = "doc_id",
    supported: Sequence[str] = settings.SUPPORTED_LANGUAGES,
    default: str = settings.DEFAULT_LANGUAGE,
) -> DataFrame:
    """Fill ``language`` where it is not given; without profiles by the default.

    The text stays in its row, and only texts without a language are looked at. A profile
    too large to be sent around is joined by key instead, which shuffles the texts.
    """
    given = F.col("language") if "language" in df.columns else F.lit(None).cast("string")
    if profiles is None:
        return df.withColumn("language", F.coalesce(given, F.lit(default)))
    detector = row_detector(profiles)
    if detector is not None:
        found = detector(F.when(given.isNull(), F.col(text)))["detected"]
        return df.withColumn("_detected", found).withColumn(
            "language", F.coalesce(given, route_language(F.col("_detected"), supported, default))
        ).drop("_detected")
    found = detect(df.filter(given.isNull()), profiles, text, key).select(key, "detected").hint("shuffle_hash")
    return df.join(found, key, "left").withColumn(
        "language", F.coalesce(given, route_language(F.col("detected"), supported, default))
    ).drop("detected")
