"""Search over sorted lists, spelling variants and periodic runs against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from fractions import Fraction

import brute
import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from runestone.llm import periodic_runs, score_lists, spelling
from runestone.llm.oracles import ORACLES
from runestone.llm.queries import QUERIES


# Search over sorted lists.


def nearest(rows, k, asks):
    """rows: (id, components) -> (query_id, rank, vec_id, score)."""
    whole = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for query, q in {(i, tuple(v)) for i, v in whole if i is not None and asks(i)}:
        found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i is None, i or 0) for i, v in whole if i != query and len(v) == len(q))
        out += [(query, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(found[:k])]
    return Counter(out)


@pytest.fixture(scope="module")
def vectors(spark):
    """Random vectors, copies by the hundred, ties, nulls, odd lengths and no ids."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(1000 + i, [0.25, -0.5, 0.0, 1.0, 0.125, -1.0]) for i in range(200)]
    rows += [(2000 + i, [float(rng.integers(-1, 2)) for _ in range(6)]) for i in range(200)]
    rows += [(50, rows[3][1]), (100, rows[100][1]), (7, rows[7][1]), (None, rows[0][1]), (None, None), (3000, None), (3050, [])]
    rows += [(3100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (3150, [float("nan")] * 6), (3200, [float("inf")] * 6), (3250, [1.0, 2.0]), (3251, [2.0, 2.0])]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rank int, query string")


@pytest.mark.parametrize("limits", [{}, {"block_components": 40}])
@pytest.mark.parametrize("block_rows", [4096, 50])
@pytest.mark.parametrize(("rows", "k"), [("true", 5), ("true", 3), ("false", 5), ("vec_id < 52", 500)])
def test_search(vectors, monkeypatch, limits, block_rows, rows, k):
    monkeypatch.setattr(score_lists, "BLOCK_ROWS", block_rows)
    table = vectors.filter(rows).repartition(3)
    want = nearest([tuple(r) for r in table.select("vec_id", "embedding").collect()], k, lambda i: i % 50 == 0)
    got = score_lists.top_k(table, F.col("vec_id") % 50 == 0, k=k, **limits).select("query_id", "rank", "vec_id", "score").collect()
    assert Counter(tuple(r) for r in got) == want


@pytest.mark.parametrize("scale", [1.0, 3e4, 1e9, 1e17])
def test_exact_at_every_size(scale):
    rng = np.random.default_rng(5)
    table = np.floor(rng.normal(size=(80, 4)) * scale)
    table[10:30] = table[5]
    best = score_lists.Best(np.arange(9), table[:9], 5)
    for at in range(0, 80, 16):
        best.meet(np.arange(80)[at:at + 16], table[at:at + 16])
    for q in range(9):
        want = sorted((-sum(int(a) * int(b) for a, b in zip(table[q], table[j], strict=True)), j) for j in range(80) if j != q)[:5]
        assert [(-s, v) for s, v in zip(best.scores[q], best.vec_ids[q], strict=True)] == want


def test_bounds_hold_and_close():
    rng = np.random.default_rng(6)
    table, queries = rng.integers(-9, 9, (40, 5)).astype(float), rng.integers(-9, 9, (8, 5)).astype(float)
    lists = score_lists.Lists(table)
    scores = queries @ table.T
    for depth in (3, 10, 11, 30, 40):
        lists.advance(depth)
        lower, upper = lists.bounds(np.maximum(queries, 0), np.minimum(queries, 0))
        assert (lower <= scores).all() and (scores <= upper).all()
    assert (lower == scores).all() and (upper == scores).all()


# Spelling variants.


def lower(text):
    return (text or "").translate(brute.LOWER)


def spelled(rows):
    """rows: (doc_id, text) -> counts of the words that the registered query sees."""
    counts = Counter()
    for doc, text in rows:
        for word in spelling.RUN.findall(lower(text)):
            h = zlib.crc32(f"{doc}:{word}".encode())
            if doc is not None and h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}


def variants(counts):
    """word -> (form, root, n, n_near, form_n), every word compared with every other."""
    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    near_words = {w: [v for v in counts if near(w, v)] for w in counts}
    best = {w: min(v, key=lambda x: (-counts[x], x)) for w, v in near_words.items() if v}
    forms = {w: v for w, v in best.items() if counts[v] >= 5 * counts[w]}

    def root(w):
        while w in forms:
            w = forms[w]
        return w

    return Counter((w, forms.get(w), root(w), n, len(near_words[w]), counts.get(forms.get(w))) for w, n in counts.items())


@pytest.fixture(scope="module")
def dictionary(spark):
    """Families of words one or two characters apart, equal characters in a row, accents and one giant word."""
    rng = random.Random(8)
    bases = ["".join(rng.choice("aabcé") for _ in range(rng.randint(5, 9))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "a" * 5000, "a" * 4999]
    words = set(bases)
    for base in bases:
        for _ in range(8):
            at = rng.randrange(len(base))
            words |= {base[:at] + base[at + 1:], base[:at] + rng.choice("abÿ") + base[at + rng.randint(0, 1):]}
    rows = [(w, rng.choice([5, 6, 24, 25, 26, 30, 125, 200, 800])) for w in sorted(words)]
    return spark.createDataFrame(rows, "word string, n long")


@pytest.mark.parametrize("slice_words", [200_000, 40])
def test_variants(dictionary, slice_words):
    got = spelling.variants(dictionary, slice_words=slice_words).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = variants({r["word"]: r["n"] for r in dictionary.collect()})
    assert Counter(tuple(r) for r in got) == want and any(r["root"] != r["form"] for r in got if r["form"])


@pytest.mark.parametrize("slices", [1, 7])
def test_nodes_are_numbered_once(spark, dictionary, slices):
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    try:
        rows = spelling.trie_nodes(dictionary).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    number, prefix = {}, {}
    for r in rows:
        assert len(r["nodes"]) == len(r["word"]) + 1
        for depth, node in enumerate(r["nodes"]):
            assert number.setdefault(r["word"][:depth], node) == node and prefix.setdefault(node, r["word"][:depth]) == r["word"][:depth]
    assert [r["word"] for r in sorted(rows, key=lambda r: r["place"])] == sorted(r["word"] for r in rows)
    assert sorted(r["place"] for r in rows) == list(range(len(rows)))


@pytest.mark.parametrize("name", ["table", "awkward", "nothing"])
def test_spelling_of_texts(request, name):
    docs = request.getfixturevalue(name)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()] * 2
    got = spelling.group_variants(docs.union(docs)).select("word", "form", "root", "n", "n_near", "form_n").collect()
    counts = spelled(rows)
    if len(counts) > 1500:
        assert {r["word"]: r["n"] for r in got} == counts
    else:
        assert Counter(tuple(r) for r in got) == variants(counts)


# Periodic runs.


def runs(words, least_words, least_periods):
    """Every maximal stretch of every period, the smallest period of each."""
    smallest, n = {}, len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i >= p:
                smallest.setdefault((i, j + p), p)
            i = j
    return sorted((s, e - s, p) for (s, e), p in smallest.items() if e - s >= max(least_words, least_periods * p))


def sequence(rng):
    k, n, kind = rng.randint(1, 4), rng.randint(0, 90), rng.random()
    if kind < 0.4:
        return [rng.randrange(k) for _ in range(n)]
    if kind < 0.5:  # Fibonacci words hold many runs
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind < 0.6:  # no three copies in a row
        return [i.bit_count() % 2 for i in range(n)]
    out = []
    while len(out) < n:
        unit = [rng.randrange(k) for _ in range(rng.randint(1, 12))]
        out += (unit * rng.randint(1, 6))[:rng.randint(1, 50)]
    return out[:n]


@pytest.mark.parametrize("step", [1, 2, 7, 1000])
def test_catcher(step):
    rng = random.Random(step)
    for _ in range(300):
        words, times = sequence(rng), rng.choice([2, 2, 3, 4, 5])
        catcher = periodic_runs.SquareCatcher(max(1, len(words) // times), times)
        for at in range(0, len(words), step):
            catcher.append(np.array(words[at:at + step]))
            if step == 7:  # what is known on the way is right too
                seen = words[:at + step]
                assert catcher.runs() == [r for r in runs(seen, 1, times) if r[2] <= len(words) // times]
        assert catcher.runs() == runs(words, 1, times)


def test_runs_of_many(monkeypatch):
    rng = random.Random(2)
    for size in (1, 60, 1 << 15):
        monkeypatch.setattr(periodic_runs, "SEQUENCE_WORDS", size)
        every = [[str(x).encode() for x in sequence(rng)] for _ in range(200)]
        assert list(periodic_runs.runs_of(every)) == [runs(w, 6, 4) for w in every]


def test_long_texts():
    for words in ([b"a"] * 300_000, [str(i % 977).encode() for i in range(200_000)]):
        period = len(set(words))
        assert list(periodic_runs.runs_of([words])) == [[(0, len(words), period)]]
        assert periodic_runs.collapsed(words, [(0, len(words), period)]) == words[:period]


def digest(doc, text):
    words = brute.words(text)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs(words, 6, 4)
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(found, key=lambda r: (r[0], r[2])))
    milli = None if best[0] is None else int(Fraction(1000 * best[1], best[2]))
    return (doc, len(found), *best, milli, brute.sha(listed), brute.sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("name", ["table", "awkward", "nothing"])
def test_digest(request, name):
    docs = request.getfixturevalue(name).select("doc_id", "text")
    # The brute-force version takes the square of a text's words, so longer ones are compared in the tests above.
    short = docs.filter("text IS NULL OR length(text) < 6000")
    got = periodic_runs.digest_runs(short)
    assert Counter(tuple(r) for r in got.collect()) == Counter(digest(*r) for r in short.collect())
    assert periodic_runs.digest_runs(docs).count() == docs.count()


def test_find_runs(spark):
    text = "x " + "to be or not " * 5 + "y y y y y y"
    row = periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["starts"], row["lengths"], row["periods"]) == ([1, 21], [20, 6], [4, 1]) and row["collapsed"] == "x to be or not y"


@pytest.mark.parametrize("name", ["op11_sorted_list_search", "op12_spelling_variants"])
def test_equals_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    con = connect(folder)
    assert difference(QUERIES[name](spark, folder), con, ORACLES[name]) is None
    con.close()


def test_registered_runs(spark, sf):
    rows = QUERIES["op13_periodic_runs"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    assert all(tuple(r) == digest(r["doc_id"], texts[r["doc_id"]]) for r in rows if len(texts[r["doc_id"]]) < 8000)
