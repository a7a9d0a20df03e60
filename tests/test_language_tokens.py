"""Language detection and sub-words."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from runestone.operators import language, subwords
from runestone.session import fresh_dir

TRAIN = [
    ("en", "the weather is nice today and we are going to the market to buy fresh bread"),
    ("en", "please wake me up at seven in the morning with the alarm on my phone"),
    ("en", "what is the meaning of this word and how should it be written"),
    ("sv", "vädret är fint idag och vi ska gå till torget för att köpa färskt bröd"),
    ("sv", "väck mig klockan sju på morgonen med alarmet på min telefon"),
    ("sv", "vad betyder det här ordet och hur ska det skrivas på svenska"),
    ("fi", "sää on tänään kaunis ja menemme torille ostamaan tuoretta leipää"),
    ("fi", "herätä minut seitsemältä aamulla puhelimeni herätyskellolla"),
    ("fi", "mitä tämä sana tarkoittaa ja miten se pitäisi kirjoittaa suomeksi"),
]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(TRAIN, "language string, text string").cache()


@pytest.fixture(scope="module", params=[0, 5, 50_000])
def profiles(train, request):
    """With no, some and all words scored ready-made: results must not differ."""
    return language.fit_profiles(train, common_words=request.param)


def grams(word):
    padded = f" {word} "
    return [*word, *(padded[i:i + 2] for i in range(len(padded) - 1)), *(padded[i:i + 3] for i in range(len(padded) - 2))]


def brute_profiles():
    counts = {lang: Counter() for lang, _ in TRAIN}
    for lang, text in TRAIN:
        for word in text.lower().split():
            counts[lang].update(grams(word))
    seen = set().union(*counts.values())
    return {
        lang: {g: round(math.log((c[g] + 1) / (sum(c.values()) + len(seen))) * 1e6) for g in seen}
        for lang, c in counts.items()
    }


def test_profiles_match_brute_force(profiles):
    want = {(lang, g, s) for lang, table in brute_profiles().items() for g, s in table.items()}
    assert {tuple(r) for r in language.profile_rows(profiles).collect()} == want


TEXTS = [
    (1, "Good morning, what is the weather today?", "en"),
    (2, "Hur är vädret på morgonen?", "sv"),
    (3, "Mikä on tämän päivän sää?", "fi"),
    (4, "12345 !@#", None),
    (5, "", None),
    (6, "the the the sää", "en"),
    (7, "жщ", None),
]


@pytest.mark.parametrize("max_rows", [1_000_000, -1])
def test_detect(spark, profiles, max_rows):
    """In the row, and joined where the profile may not be sent around."""
    df = spark.createDataFrame([t[:2] for t in TEXTS], "doc_id long, text string")
    got = {r.doc_id: (r.detected, r.score) for r in language.detect(df, profiles, max_rows=max_rows).collect()}
    assert set(got) == {t[0] for t in TEXTS}
    table = brute_profiles()
    for key, text, want in TEXTS:
        if want is None:
            assert got[key] == (None, None)
            continue
        letters = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        scores = {lang: sum(t.get(g, 0) for w in letters for g in grams(w)) for lang, t in table.items()}
        best = min(scores, key=lambda lang: (-scores[lang], lang))
        assert got[key] == (best, scores[best]) and best == want


def test_saved_profiles(spark, profiles):
    path = fresh_dir(spark, "profiles")
    language.save_profiles(profiles, path)
    again = language.load_profiles(spark, path)
    df = spark.createDataFrame([t[:2] for t in TEXTS], "doc_id long, text string")
    assert again.languages == profiles.languages
    assert sorted(map(str, language.detect(df, again).collect())) == sorted(map(str, language.detect(df, profiles).collect()))


def test_no_shuffle_of_texts(spark, profiles):
    df = spark.createDataFrame([t[:2] for t in TEXTS], "doc_id long, text string")
    assert "Exchange" not in language.with_language(df, profiles)._jdf.queryExecution().executedPlan().toString()


def test_with_language(spark, profiles):
    df = spark.createDataFrame(
        [(1, "vad är det här för ord", None), (2, "vad är det", "en"), (3, "??", None), (4, "mitä tämä on", None)],
        "doc_id long, text string, language string")
    got = {r.doc_id: r.language for r in language.with_language(df, profiles, supported=["en", "sv"]).collect()}
    assert got == {1: "sv", 2: "en", 3: "en", 4: "en"}
    bare = language.with_language(df.drop("language"), profiles).collect()
    assert {r.doc_id: r.language for r in bare} == {1: "sv", 2: "sv", 3: "en", 4: "fi"}


def test_status_and_strict(spark, train):
    df = spark.createDataFrame([("a",), (" \n",), (None,), ("12 ?",)], "text string")
    got = [r.s for r in df.select(language.detect_status(F.col("text")).alias("s")).collect()]
    assert got == ["ok", "blank", "blank", "no_letters"]
    with pytest.raises(ValueError):
        language.require_detectable(df)
    assert language.require_detectable(train) is train
    with pytest.raises(ValueError):
        language.fit_profiles(train.limit(0))


def test_route(spark):
    df = spark.createDataFrame([("sv",), ("es",), (None,)], "l string")
    assert [r.r for r in df.select(language.route_language(F.col("l")).alias("r")).collect()] == ["sv", "en", "en"]


@pytest.fixture(scope="module")
def finnish(spark):
    texts = ["talossa taloissa taloissani talo", "autossa autoissani auto", "issa ani talo auto kissa"]
    return spark.createDataFrame([(i, t, "fi") for i, t in enumerate(texts)], "doc_id long, text string, language string")


def brute_pieces(texts, size, max_piece=8):
    n, length = Counter(), {}
    for word in " ".join(texts).split():
        for k in range(1, max_piece + 1):
            for i in range(len(word) - k + 1):
                piece = ("##" if i else "") + word[i:i + k]
                n[piece] += 1
                length[piece] = k
    letters = {p: c for p, c in n.items() if length[p] == 1}
    longer = sorted((p for p in n if length[p] > 1), key=lambda p: (-n[p] * (length[p] - 1), p))[:size]
    return {**letters, **{p: n[p] for p in longer}}


def test_vocabulary(finnish):
    want = brute_pieces([r.text for r in finnish.collect()], 20)
    assert {r.piece: r.n for r in subwords.learn_subwords(finnish, size=20).collect()} == want


def test_encoding(spark, finnish):
    vocabulary = {"talo", "##issa", "##ni", "a", "b", "##a", "##b", ","}
    pieces = spark.createDataFrame([(p,) for p in vocabulary], "piece string")
    encoder = subwords.subword_encoder(pieces)
    df = spark.createDataFrame([(1, "taloissani, ab"), (2, "taloz ab"), (3, ""), (4, None)], "i int, t string")
    got = {r.i: r.k for r in df.select("i", subwords.subword_tokens(F.col("t"), encoder).alias("k")).collect()}
    assert got == {1: ["talo", "##issa", "##ni", ",", "a", "##b"], 2: ["[UNK]", "a", "##b"], 3: [], 4: None}


def test_learned_pieces_spell_every_word(finnish):
    encoder = subwords.subword_encoder(subwords.learn_subwords(finnish, size=10))
    rows = finnish.select("text", subwords.subword_tokens(F.col("text"), encoder).alias("k")).collect()
    for r in rows:
        words = "".join(p[2:] if p.startswith("##") else " " + p for p in r.k).split()
        assert words == r.text.split()


def test_routing(spark, finnish):
    encoder = subwords.subword_encoder(subwords.learn_subwords(finnish, size=5))
    both = finnish.limit(1).unionByName(spark.createDataFrame([(9, "talossa taloissa", "sv")], finnish.schema))
    got = {r.language: r.tokens for r in subwords.route_tokens(both, encoder).collect()}
    assert got["sv"] == ["talossa", "taloissa"] and any(p.startswith("##") for p in got["fi"])


def test_strict_text(spark, finnish):
    assert subwords.require_text(finnish) is finnish
    with pytest.raises(ValueError):
        subwords.require_text(spark.createDataFrame([(None,)], "text string"))
