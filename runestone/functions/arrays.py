"""Array expressions: everything a document needs stays inside its row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for ``body``; repeating the expression would compute it again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _run_starts(items: Column, key: str) -> Column:
    """Indexes in a sorted array of structs where the field ``key`` changes."""
    marked = F.transform(
        items,
        lambda item, i: F.when(
            (i == 0) | (item[key] != F.get(items, i - 1)[key]), i
        ),
    )
    return F.filter(marked, lambda i: i.isNotNull())


def word_frequencies(words: Column, excluded: Column | None = None) -> Column:
    """``array<struct<word, n, first>>`` of one document, without a shuffle.

    Sort (word, position), cut the runs. Excluded words join the sort at position
    -1, so a run that starts there is dropped: no search per word.
    """
    seen = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("pos")))
    if excluded is not None:
        marks = F.transform(excluded, lambda w: F.struct(w.alias("word"), F.lit(-1).alias("pos")))
        seen = F.concat(seen, marks)

    def runs(items: Column) -> Column:
        return let(_run_starts(items, "word"), lambda starts: F.transform(
            starts,
            lambda start, j: F.struct(
                F.get(items, start)["word"].alias("word"),
                (F.coalesce(F.get(starts, j + 1), F.size(items)) - start).alias("n"),
                F.get(items, start)["pos"].alias("first"),
            ),
        ))

    counted = let(F.sort_array(seen), runs)
    if excluded is not None:
        counted = F.filter(counted, lambda run: run["first"] >= 0)
    return counted


def most_common(frequencies: Column, limit: int) -> Column:
    """The most frequent words, ties by first occurrence."""
    ranked = F.sort_array(F.transform(
        frequencies,
        lambda f: F.struct((-f["n"]).alias("n"), f["first"].alias("first"), f["word"].alias("word")),
    ))
    return F.transform(F.slice(ranked, 1, limit), lambda f: f["word"])


def majority_labels(mentions: Column) -> Column:
    """Mentions ``array<struct<text, label, pos>>`` -> one entry per surface form,
    ``array<struct<text, label, count>>``: the most frequent label (ties: seen
    first), by count descending and then first seen."""
    ordered = F.sort_array(F.transform(
        mentions, lambda m: F.struct(m["text"].alias("text"), m["label"].alias("label"), m["pos"].alias("pos"))
    ))

    def labelled_runs(items: Column) -> Column:
        keyed = F.transform(items, lambda m: F.struct(
            F.struct(m["text"], m["label"]).alias("key"), m["pos"].alias("pos")))
        return let(keyed, lambda rows: let(_run_starts(rows, "key"), lambda starts: F.transform(
            starts,
            lambda start, j: F.struct(
                F.get(items, start)["text"].alias("text"),
                F.get(items, start)["label"].alias("label"),
                (F.coalesce(F.get(starts, j + 1), F.size(items)) - start).alias("n"),
                F.get(items, start)["pos"].alias("first"),
            ),
        )))

    def by_surface(runs: Column) -> Column:
        def entry(runs_of_text: Column) -> Column:
            best = F.array_max(F.transform(runs_of_text, lambda r: F.struct(
                r["n"].alias("n"), (-r["first"]).alias("negated"), r["label"].alias("label"))))
            total = F.aggregate(runs_of_text, F.lit(0), lambda acc, r: acc + r["n"])
            first = F.array_min(F.transform(runs_of_text, lambda r: r["first"]))
            return F.struct(
                (-total).alias("negated"), first.alias("first"),
                F.get(runs_of_text, F.lit(0))["text"].alias("text"), best["label"].alias("label"),
            )

        return let(_run_starts(runs, "text"), lambda starts: F.transform(
            starts,
            lambda start, j: let(
                F.slice(runs, start + 1, F.coalesce(F.get(starts, j + 1), F.size(runs)) - start), entry
            ),
        ))

    surfaces = let(let(ordered, labelled_runs), by_surface)
    return F.transform(F.sort_array(surfaces), lambda e: F.struct(
        e["text"].alias("text"), e["label"].alias("label"), (-e["negated"]).alias("count")))


def softmax(logits: Column) -> Column:
    """Probabilities of one row of logits, shifted by the maximum so exp cannot overflow."""
    return let(logits.cast("array<double>"), lambda z: let(F.array_max(z), lambda top: let(
        F.transform(z, lambda x: F.exp(x - top)),
        lambda e: let(
            F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x),
            lambda total: F.transform(e, lambda x: x / total),
        ),
    )))


def argmax(probabilities: Column) -> Column:
    """Zero-based index of the largest entry, the lowest on a tie."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def top_entries(probabilities: Column, limit: int) -> Column:
    """``array<struct<category_id, probability>>``, largest first, lowest id on a tie."""
    ranked = F.sort_array(F.transform(
        probabilities, lambda p, i: F.struct((-p).alias("negated"), i.alias("category_id"))
    ))
    return F.transform(F.slice(ranked, 1, limit), lambda e: F.struct(
        e["category_id"].alias("category_id"), (-e["negated"]).alias("probability")))
