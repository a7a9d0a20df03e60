"""Spelling variants: words one character apart, found in a dictionary of trie-node pairs.

Every prefix of a word is a node of a trie, every suffix a node of the trie of reversed
words. The nodes are numbered: in the sorted words, those beyond the prefix shared
with the word before get the next numbers. A pair (prefix node, suffix node) then stands for
what is left of a word when something between the two is taken out:

* two words that differ in position i alone have the pair that *skips* i in common;
* a word without its position i is another word if the pair that skips i is one of the pairs
  that *split* the other word, with nothing between prefix and suffix.

So the join on two integers gives the exact neighbours; no string is compared or generated. A
pair is shared by one split word and by as many skipping words as there are characters at most.
The members of a pair are not paired with each other: each takes the number of the others and the best
of them from its group, so the rows that move grow with the characters of the dictionary. Of equal
characters in a row only the first is skipped when words of different lengths are matched, as all of them
leave the same word; with this rule each pair of neighbours meets once.

Numbering needs no table of nodes: slices of the sorted words number their own nodes, and of each slice
only its first and last word, with the last one's nodes, go to the driver, which joins the slices.

A word's form is its most frequent neighbour (ties: first in code-point order) if that is ``factor``
times as frequent; roots follow forms to the end. Each step multiplies the frequency, so chains are
short, and their length is halved in each round of a join.

Defined results: a null or empty text, or one without letters, has no words. Rows with a null doc_id
have no digest, so their runs are counted as they are. Repeated rows count again. A run of any length is
one word. Words too rare or short have no row. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runestone.llm.common import column_of, map_batches
from runestone.session import settle

# Fixed by the contract of the registered query.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_CHARS = 6
LEAST_COUNT = 5
FACTOR = 5
# One in so many words of a document, told by its digest, loses a character.
DAMAGED = 199
# Distinct words that a task counts before it sends them on.
HELD_WORDS = 200_000
# Words in a slice of the sorted dictionary, on average at most.
SLICE_WORDS = 200_000

NUMBERED = "word string, n long, place long, nodes array<long>, news array<boolean>, nodes_used long"


def damaged(word: str, digest: int) -> str:
    """The word without the character that its digest names."""
    at = digest % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, damage: int | None = DAMAGED) -> DataFrame:
    """word and n over all texts, of words of ``least_chars`` characters and more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), column_of(batch, "text"), strict=True):
                own = Counter(RUN.findall((text or b"").lower().decode()))  # of bytes, only A-Z are lower-cased
                # A character can be lost, so shorter words cannot become long enough.
                start = None if doc_id is None or damage is None else zlib.crc32(f"{doc_id}:".encode())
                for word, n in own.items():
                    if len(word) < least_chars:
                        continue
                    if start is not None:
                        digest = zlib.crc32(word.encode(), start)
                        if digest % damage == 0:
                            word = damaged(word, digest)
                            if len(word) < least_chars:
                                continue
                    counts[word] += n
                if len(counts) >= HELD_WORDS:
                    yield sent()
                    counts.clear()
        yield sent()

    texts = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return map_batches(docs, texts, "word string, n long", run).groupBy("word").agg(F.sum("n").alias("n"))


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:  # equal up to low, different by n
        middle = (low + n) // 2
        low, n = (middle, n) if a[:middle] == b[:middle] else (low, middle)
    return low


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trie nodes of one slice of sorted words, numbered from 0, the root first."""
    before, nodes, used, place = "", [0], 1, 0
    for batch in batches:
        rows = []
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            known = shared(before, word)
            nodes = nodes[:known + 1] + list(range(used, used + len(word) - known))
            used += len(word) - known
            rows.append((word, n, place, nodes, [i == 0 or word[i] != word[i - 1] for i in range(len(word))], used))
            before, place = word, place + 1
        if rows:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in NUMBERED.split(", ")]
            )


def trie_nodes(words: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """word, n, its place in code-point order, and the numbers of its prefixes' nodes (the root first).

    ``words`` has distinct words. ``news`` tells the characters that differ from the one before.
    """
    slices = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-words.count() // slice_words))
    sorted_ = words.select("word", "n").repartitionByRange(slices, "word").sortWithinPartitions("word")
    numbered = settle(sorted_.mapInArrow(_number, NUMBERED).withColumn("slice", F.spark_partition_id()))
    # A row for each slice: no more than a few words go to the driver.
    ends = numbered.groupBy("slice").agg(
        F.min("word").alias("first"), F.max_by(F.struct("word", "nodes"), "place").alias("last"), F.count(F.lit(1)).alias("words"), F.max("nodes_used").alias("nodes"),
    ).orderBy("first").collect()
    joined, words_before, nodes_before, before, before_nodes = [], 0, 0, "", []
    for end in ends:
        # The first word's nodes are numbered 0, 1, 2 ... by depth; those it shares with the word before it exist.
        known = before_nodes[:shared(before, end["first"]) + 1]
        joined.append((end["slice"], words_before, nodes_before, known))
        nodes = [known[n] if n < len(known) else nodes_before + n for n in end["last"]["nodes"]]
        words_before, nodes_before = words_before + end["words"], nodes_before + end["nodes"]
        before, before_nodes = end["last"]["word"], nodes
    starts = words.sparkSession.createDataFrame(joined, "slice int, words_before long, nodes_before long, known array<long>")
    return numbered.join(F.broadcast(starts), "slice").select(
        "word", "n", (F.col("words_before") + F.col("place")).alias("place"),
        F.transform("nodes", lambda node: F.coalesce(F.get("known", node.cast("int")), F.col("nodes_before") + node)).alias("nodes"), "news",
    )


def node_pairs(forward: DataFrame, backward: DataFrame) -> DataFrame:
    """A row for each pair of nodes that a word skips a position with, or is split by.

    From the nodes of the words and of the reversed words: prefix, suffix, the word's place and n;
    ``skips`` is true for a skipped position, ``first`` where it differs from the character before.
    """
    both = forward.join(backward.select(F.reverse("word").alias("word"), F.col("nodes").alias("ends")), "word")
    length = F.size("nodes") - 1
    skips = F.transform("news", lambda new, i: F.struct(
        F.get("nodes", i).alias("prefix"), F.get("ends", length - 1 - i).alias("suffix"), F.lit(True).alias("skips"), new.alias("first")))
    splits = F.transform("nodes", lambda node, i: F.struct(
        node.alias("prefix"), F.get("ends", length - i).alias("suffix"), F.lit(False).alias("skips"), F.lit(False).alias("first")))
    return both.select("place", "n", F.inline(F.concat(skips, splits)))


def neighbours(words: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """word, n, n_near, and the most frequent near word with its count (ties: the first in code-point order)."""
    words = settle(words)
    forward = settle(trie_nodes(words, slice_words))
    pairs = node_pairs(forward, trie_nodes(words.select(F.reverse("word").alias("word"), "n"), slice_words))
    mine = F.struct("n", (-F.col("place")).alias("order"))
    group = Window.partitionBy("prefix", "suffix")
    ranked = group.orderBy(F.desc("skips"), F.desc("n"), "place")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    skipping = F.when(F.col("skips"), mine)
    met = (
        pairs.withColumn("at", F.row_number().over(ranked))
        .withColumn("others", F.count_if("skips").over(group))
        .withColumn("shorter", F.max(F.when(~F.col("skips"), mine)).over(group))
        .withColumn("longer", F.count_if("first").over(group))
        .withColumn("best_longer", F.max(F.when(F.col("first"), mine)).over(group))
        .withColumn("best", F.nth_value(skipping, 1).over(whole))
        .withColumn("second", F.nth_value(skipping, 2).over(whole))
    )
    replaced = F.col("others") - 1
    with_shorter = F.col("first") & F.col("shorter").isNotNull()
    found = met.select(
        "place",
        F.when(F.col("skips"), replaced + with_shorter.cast("long")).otherwise(F.col("longer")).alias("n_near"),
        F.when(F.col("skips"), F.greatest(
            F.when(F.col("at") == 1, F.col("second")).otherwise(F.col("best")), F.when(with_shorter, F.col("shorter")),
        )).otherwise(F.col("best_longer")).alias("near"),
    ).filter(F.col("n_near") > 0)
    near = found.groupBy("place").agg(F.sum("n_near").alias("n_near"), F.max("near").alias("near"))
    named = forward.select("word", "n", "place")
    best = near.select("place", "n_near", F.col("near.n").alias("near_n"), (-F.col("near.order")).alias("near_place"))
    names = named.select(F.col("place").alias("near_place"), F.col("word").alias("near_word"))
    return (
        named.join(best, "place", "left").join(names, "near_place", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "near_word", "near_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) of words that have a form, to (word, root): forms followed to the end."""
    steps = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = settle(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if joined.filter("moved").isEmpty():
            return joined.select("word", "root")
        steps = joined.select("word", "root")


def variants(words: DataFrame, factor: int = FACTOR, slice_words: int = SLICE_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row (word, n) of a dictionary of distinct words."""
    near = neighbours(words, slice_words)
    holds = F.col("near_n") >= factor * F.col("n")
    formed = settle(near.select(
        "word", "n", "n_near", F.when(holds, F.col("near_word")).alias("form"), F.when(holds, F.col("near_n")).alias("form_n")
    ))
    ends = roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def group_variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, damage: int | None = DAMAGED) -> DataFrame:
    """The variants among the words of all texts that occur ``least_count`` times."""
    return variants(word_counts(docs, least_chars, damage).filter(F.col("n") >= least_count))
