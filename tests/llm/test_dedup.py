"""Line, window and near dedup, and the quality rules, against brute force."""

from __future__ import annotations

import random
from collections import Counter

import brute
import numpy as np
import pytest

from runestone.llm import line_dedup, line_quality, near_dedup, substring
from runestone.llm.graph import components


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def tangled(spark):
    """Copies, near copies, shared lines and passages, a hot line and a hot passage, in many partitions."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    hot_line, passage = "The hot line that is in every third document of them all", line(60)
    base = line(120)
    rows = []
    for i in range(240):
        parts = [line(rng.randint(1, 40)) for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), ["  " + hot_line + "\t", hot_line.upper()][i % 2])
        if i % 4 == 1:
            parts.append(passage)
        if i % 5 == 2:
            own = base.split()
            for _ in range(rng.randint(0, 12)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            parts = [" ".join(own)]
        if i % 20 == 7:
            parts = rows[rng.randrange(len(rows))][1].split("\n")
        rows.append((1000 - 3 * i, "\n".join(parts)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(13)


@pytest.mark.parametrize("name", ["tangled", "table", "awkward", "nothing"])
def test_lines(request, spark, name):
    docs = request.getfixturevalue(name)
    bitmaps = line_dedup.line_bitmaps(docs)
    got = line_dedup.apply_bitmaps(docs, bitmaps).select("doc_id", "n_lines", "n_dropped", "text").collect()
    want = brute.line_dedup(rows_of(docs))
    assert Counter((r[0], r[1], r[2], r[3] or "") for r in got) == Counter(want)
    if name in ("tangled", "table"):
        assert sum(r[2] for r in got) > 0


def test_lines_of_null_and_shared_ids(spark):
    text = "A line that is long enough to have a key of its own, surely."
    rows = [(None, text), (None, text + "\nx"), *[(i, text) for i in (1, 2, 3, 4, 4)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs)).collect()
    assert Counter((r["doc_id"], r["n_dropped"], r["text"]) for r in got) == Counter(
        [(None, 1, ""), (None, 1, "x"), (1, 1, ""), (2, 1, ""), (3, 1, ""), (4, 0, text), (4, 0, text)]
    )


def test_lines_keep_columns(awkward):
    out = line_dedup.dedup_lines(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()


def test_a_key_over_many_ranges(spark):
    """One key in all documents, which spreads over every range; another straddles none or two."""
    text = "This very line stands in each document of the whole table."
    other = "This line stands in five of the documents and not in others."
    docs = spark.createDataFrame([(i, text + ("\n" + other if i % 100 == 0 else "")) for i in range(500)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["doc_id"]: r["text"] for r in line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert got[499] == text and got[400] == other and not any(got[i] for i in range(500) if i not in (499, 400))


@pytest.mark.parametrize("name", ["tangled", "table", "awkward", "nothing"])
@pytest.mark.parametrize("ranges", [1, 5])
def test_windows(request, monkeypatch, name, ranges):
    docs = request.getfixturevalue(name)
    if ranges > 1:
        if name == "awkward":
            pytest.skip("one is enough")
        size = max(1, sum(len((t or "").encode()) for _, t in rows_of(docs)))
        intervals = substring.removal_intervals(docs, range_windows=max(1, size // 6 // ranges))
    else:
        intervals = substring.removal_intervals(docs)
    got = substring.remove_intervals(docs, intervals).collect()
    assert Counter(tuple(r) for r in got) == Counter(brute.window_dedup(rows_of(docs)))


def test_window_hashes():
    numbers = np.random.default_rng(1).integers(0, 1 << 62, 300).astype(np.uint64)
    for window in (1, 2, 3, 7, 35, 64):
        base = int(substring.BASES[0])
        want = [sum(int(numbers[i + k]) * pow(base, window - 1 - k, 1 << 64) for k in range(window)) % (1 << 64) for i in range(300 - window + 1)]
        assert (substring.window_hashes(numbers, window, substring.BASES[0]) == substring._mixed(np.array(want, np.uint64))).all()
    assert len(substring.window_hashes(numbers[:3], 4, substring.BASES[0])) == 0


def test_places_and_intervals():
    places = np.array([0, 1, 5, 300, 70_000, 70_001])
    assert (substring._places(substring._starts(places)) == places).all()
    starts, ends = substring.merged(np.array([5, 6, 50, 40, 90]), 35)
    assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [(5, 85), (90, 125)]


@pytest.mark.parametrize("name", ["tangled", "table"])
@pytest.mark.parametrize("size", [2, 5])
def test_near(request, name, size):
    docs = request.getfixturevalue(name)
    got = near_dedup.near_duplicates(docs, shingle=size).drop("text_key").collect()
    want = brute.near_dedup(rows_of(docs), size)
    assert Counter(tuple(r) for r in got) == Counter(want)
    assert 0 < sum(not r[3] for r in got)


def test_near_edges(awkward, nothing):
    got = near_dedup.near_duplicates(awkward, shingle=2).collect()
    assert len(got) == awkward.count()
    assert next(r for r in got if r["doc_id"] == 6)["component_id"] == 5
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    assert all(r["component_id"] == r["doc_id"] for r in got if r["doc_id"] in (1, 2, 3))
    left = near_dedup.drop_near_duplicates(awkward, shingle=2)
    ids = Counter(r["doc_id"] for r in left.collect())
    assert left.columns == awkward.columns and ids[6] == 0 and ids[5] == 1 and ids[7] == 2 and ids[None] == 2
    assert near_dedup.near_duplicates(nothing).count() == 0 and near_dedup.drop_near_duplicates(nothing).count() == 0


def test_one_doc_id_with_several_texts(spark):
    """Classes with the same smallest doc_id have links and components of their own."""
    a, b, c = ([f"{x}{i}" for i in range(100)] for x in "abc")
    near = lambda words: " ".join([*words[:-3], "other"])
    for one, two in (("a", "b"), ("b", "a")):  # whichever set comes first by its digest
        words = {"a": a, "b": b}
        x, y = words[one], words[two]
        rows = [(0, near(x)), (1, " ".join(x)), (1, " ".join(y)), (5, " ".join(c)), (5, " ".join(y[:50])), (6, near(c)), (7, " ".join(y[:49])), (8, near(y))]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = near_dedup.near_duplicates(docs, shingle=2).drop("text_key").collect()
        assert Counter(tuple(r) for r in got) == Counter(brute.near_dedup(rows, 2))
        left = Counter(tuple(r) for r in near_dedup.drop_near_duplicates(docs, shingle=2).collect())
        assert left == Counter([(0, near(x)), (1, " ".join(y)), (5, " ".join(c)), (5, " ".join(y[:50]))])


def test_links_that_a_star_misses(spark):
    """Chains where neighbours are alike and the ends are not, so that one centre cannot reach them all."""
    rows = []
    for chain in range(12):
        tokens = [f"c{chain}t{i}" for i in range(400)]
        for step in range(6):
            rows.append((chain * 100 + step, " ".join(tokens[step * 18:step * 18 + 200])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(docs, shingle=2).drop("text_key").collect()
    assert Counter(tuple(r) for r in got) == Counter(brute.near_dedup(rows, 2))
    assert {r["component_id"] for r in got} == {100 * c for c in range(12)}


def test_bit_maps_reject_no_pair_that_is_alike(spark):
    rng = np.random.default_rng(8)
    rows, alike = [], 0
    for i in range(300):
        n = int(rng.integers(1, 3000))
        pool = np.unique(rng.integers(0, 1 << 64, 2 * n, np.uint64))
        x = rng.choice(pool, n, replace=False)
        y = np.concatenate([x[int(n * rng.random() * 0.4):], rng.integers(0, 1 << 64, int(n * rng.random() * 0.3), np.uint64)])
        both = len(np.intersect1d(x, y))
        like = 100 * both >= 80 * (len(x) + len(y) - both)
        alike += like
        rows.append((like, len(x), len(y), near_dedup.bit_map(x).tolist(), near_dedup.bit_map(y).tolist()))
    table = spark.createDataFrame(rows, "alike boolean, n_x long, n_y long, bits_x array<long>, bits_y array<long>")
    got = table.select("alike", near_dedup.may_be_alike(80, "x", "y").alias("may")).collect()
    assert alike > 30 and all(r["may"] for r in got if r["alike"]) and sum(not r["may"] for r in got) > 100


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 200)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for node in got:
        seen, todo = {node}, [node]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        assert got[node] == min(seen)


def test_densification_agrees_with_similarity():
    sketcher = near_dedup.Sketcher(32, 5)
    rng = np.random.default_rng(2)
    same = []
    for size in (3, 30, 1000):
        for _ in range(60):
            pool = rng.permutation(np.unique(rng.integers(0, 1 << 64, size * 2, np.uint64)))
            both, rest = pool[:size], pool[size:size + max(1, size // 4)]
            x, y = sketcher.bin_values(np.sort(both)), sketcher.bin_values(np.sort(np.concatenate([both, rest])))
            same.append(float((x == y).mean()) - len(both) / (len(both) + len(rest)))
    assert abs(np.mean(same)) < 0.02


@pytest.mark.parametrize("name", ["tangled", "table", "awkward", "nothing"])
def test_quality_base(request, name):
    docs = request.getfixturevalue(name)
    got = line_quality.judge(docs).collect()
    want = Counter((doc, *brute.quality_base(text)) for doc, text in rows_of(docs))
    assert Counter(tuple(r)[:7] for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)
    kept = line_quality.clean(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


@pytest.mark.parametrize(("line", "fails"), [
    ("A plain sentence with an end.", False), ("WHAT!! AN!! OFFER!!", True), ("Home | About us | Contact | Shop", True),
    ("ALL IN CAPITALS HERE TODAY", True), ("NASA is written so.", False), ("go go go go go", True), ("go go go go now", False),
    ("Licensed under the terms below.", True), ("x # y", True), ("a*** b### c%%%", True), ("Ünïcode wörds stay as they are", False),
])
def test_line_rules(line, fails):
    raw = line.encode()
    assert line_quality.line_fails(raw, raw.split()) is fails


@pytest.mark.parametrize(("line", "fails"), [
    ("They read the privacy policy once. " + " ".join(f"word{i}" for i in range(60)), False),
    ("Privacy policy and terms of use. " * 10, True),
    (" ".join(f"Wort{i}" for i in range(14)) + ". Cookie policy, terms of use, privacy policy.", True),
    ("Страны НАТО и COVID-19 обсуждали в Брюсселе", False), ("Οι χώρες του NATO και ο COVID-19 σήμερα", False),
    ("ناقشت دول NATO وباء COVID-19 في اجتماع طويل أمس", False), ("今日 の 会議 で NATO と 協議 した と 発表 された", False),
    ("КУПИТЕ СЕЙЧАС И СЕГОДНЯ", True), ("GROßE STRAßE UND WEG", True), ("ÄRGER ÜBER DIE FÄLLE", True), ("1 2 3 4 ABC", False),
])
def test_rules_spare_clean_lines(line, fails):
    raw = line.encode()
    assert line_quality.line_fails(raw, raw.split()) is fails


def test_clean_documents_of_one_line_are_kept():
    prose = " ".join(f"word{i}" for i in range(80))
    russian = " ".join(f"слово{chr(0x430 + i % 32)}{chr(0x430 + i // 32)}" for i in range(80))
    for text in (f"{prose} as its privacy policy says", f"{russian} НАТО и COVID-19 NATO"):
        figures, kept = line_quality.judge_text(text.encode())
        assert figures[6] and kept == text.encode()


def test_quality_verdict():
    bad = b"MENU | HOME | SHOP | CART"
    good = [b" ".join(b"w%d" % (10 * i + k) for k in range(10)) + b"." for i in range(10)]
    figures, kept = line_quality.judge_text(b"\n".join([*good, bad]))
    assert figures[6] and kept == b"\n".join(good)
    assert not line_quality.judge_text(b"\n".join([*good[:3], *(b"m%d | n%d | o%d" % (i, i, i) for i in range(20))]))[0][6]


def test_quality_labels(spark):
    """On the labelled documents of at least 50 words, the rules agree with the labels."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = line_quality.judge(docs).join(labels, "doc_id").filter("n_words >= 50").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) >= 0.97 * len(rows)
