"""Plain Python versions of the operators, one document after the other."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = "\x20\x09\x0a\x0b\x0c\x0d"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality_base(text):
    w = words(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            duplicates += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), duplicates, len(covered), failed


def line_dedup(rows, min_chars=40, min_docs=5):
    """rows: (doc_id, text) -> (doc_id, n_lines, n_dropped, kept text)."""
    low = -(1 << 63)
    key = lambda line: line.strip(EDGE).translate(LOWER)
    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(low if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= min_docs and max(held[key(x)]) != (low if doc is None else doc))]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def window_dedup(rows, window=35):
    """rows: (doc_id, text) -> (doc_id, n_words, n_removed, kept text)."""
    every = [words(t) for _, t in rows]
    counts = Counter(tuple(w[i:i + window]) for w in every for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, every, strict=True):
        gone = {i + k for i in range(len(w) - window + 1) if counts[tuple(w[i:i + window])] > 1 for k in range(window)}
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}


def near_dedup(rows, size, percent=80):
    """rows: (doc_id, text) -> (doc_id, n_shingles, component_id, kept); doc_ids are unique or rows equal."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        if rows[i][0] is not None:
            for x in s:
                holders[x].append(i)
    common = Counter((i, j) for h in holders.values() for n, i in enumerate(h) for j in h[n + 1:])
    for (i, j), n in common.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            root[find(i)] = find(j)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[find(i)] = min(doc, smallest.get(find(i), doc))
    return [
        (doc, len(s), None if doc is None else smallest[find(i)], doc is None or doc == smallest[find(i)])
        for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))
    ]


def targets(sizes, weights=(5, 2, 1), repeats=3):
    """sizes by source -> target by source, by filling up again and again, in exact fractions."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, rest = set(), Fraction(sum(sizes.values()))
    while True:
        open_ = [s for s in names if s not in full]
        left = rest - sum(repeats * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > repeats * sizes[s]}
        if not over:
            return {s: Fraction(repeats * sizes[s]) if s in full else share[s] for s in names}
        full |= over


def best_fit(lengths, capacity):
    """Number of sequences by the same rules, one item at a time."""
    large = sorted((n for n in lengths if 3 * n > capacity), reverse=True)
    gaps = []
    while large:
        first = large.pop(0)
        at = next((i for i, n in enumerate(large) if first + n <= capacity), None)
        gaps.append(capacity - first - (large.pop(at) if at is not None else 0))
    for n in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        fitting = [i for i, g in enumerate(gaps) if g >= n]
        if fitting:
            gaps[min(fitting, key=lambda i: gaps[i])] -= n
        else:
            gaps.append(capacity - n)
    return len(gaps)
