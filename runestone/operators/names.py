"""Names of any case and length in texts: an automaton over word tokens.

The names are split into tokens and put into one Aho-Corasick automaton: a tree of their tokens, with a link from
each node to the longest other beginning of a name that ends there. It is built once, measured, and sent
to the workers; each text is then read once, from left to right, whatever the number of names. Documents stay
in their rows, so the plan has no exchange and runs on streams.

Of matches that overlap, the one that starts first counts, of those the longest.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runestone import settings
from runestone.operators.scaling import join_dimension
from runestone.operators.tagging import listed_names
from runestone.session import settle

# A token is a run of letters, digits and combining marks.
TOKEN = re.compile(r"(?:[^\W_]|[̀-ͯ])+")
FOUND = "array<struct<text:string,label:string,start:int>>"


class NameAutomaton:
    """Finds names token by token. ``names`` are (name, label); they compare in lower case."""

    def __init__(self, names: Iterable[tuple[str, str]]):
        self.tokens: dict[str, int] = {}
        # Per node: its children by token, where to go on if none fits, the name that ends here, the next node on the way back that ends one.
        self.children: list[dict[int, int]] = [{}]
        self.back, self.ends, self.shorter = [0], [-1], [0]
        # Spellings of the names that share a node differ between their tokens only: "new-york", "new york".
        self.spellings: list[dict[str, str]] = []
        self.lengths: list[int] = []
        for name, label in sorted(names):
            self._add(name.lower(), label)
        self._link()

    def _add(self, name: str, label: str) -> None:
        parts = [m.group() for m in TOKEN.finditer(name)]
        if not parts:
            return
        node = 0
        for part in parts:
            token = self.tokens.setdefault(part, len(self.tokens))
            if token not in self.children[node]:
                self.children[node][token] = len(self.children)
                self.children.append({})
                self.back.append(0)
                self.ends.append(-1)
                self.shorter.append(0)
            node = self.children[node][token]
        if self.ends[node] < 0:
            self.ends[node] = len(self.spellings)
            self.spellings.append({})
            self.lengths.append(len(parts))
        first, last = TOKEN.search(name).start(), [m.end() for m in TOKEN.finditer(name)][-1]
        self.spellings[self.ends[node]].setdefault(name[first:last], label)

    def _link(self) -> None:
        waiting = deque(self.children[0].values())
        while waiting:
            node = waiting.popleft()
            for token, child in self.children[node].items():
                at = self.back[node]
                while at and token not in self.children[at]:
                    at = self.back[at]
                self.back[child] = self.children[at].get(token, 0)
                waiting.append(child)
            back = self.back[node]
            self.shorter[node] = back if self.ends[back] >= 0 else self.shorter[back]

    def size(self) -> int:
        """Bytes of the tokens and nodes, roughly."""
        return sum(len(t) + 60 for t in self.tokens) + 300 * len(self.children)

    def find(self, text: str) -> list[tuple[str, str, int]]:
        """(text as it stands, label, start in code points) of the names, none overlapping another."""
        lowered = text.lower()
        if len(lowered) != len(text):  # a letter that becomes two: lower them one by one
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        token_of, children, back, ends, shorter = self.tokens.get, self.children, self.back, self.ends, self.shorter
        node, spans, found = 0, [], []
        for match in TOKEN.finditer(lowered):
            token = token_of(match.group())
            if token is None:
                node = 0
                spans.clear()
                continue
            while node and token not in children[node]:
                node = back[node]
            node = children[node].get(token, 0)
            spans.append(match.span())
            at = node if ends[node] >= 0 else shorter[node]
            while at:
                start = spans[-self.lengths[ends[at]]][0]
                label = self.spellings[ends[at]].get(lowered[start:match.end()])
                if label is not None:
                    found.append((start, -match.end(), label))
                at = shorter[at]
        kept, free = [], 0
        for start, end, label in sorted(found):
            if start >= free:
                kept.append((text[start:-end], label, start))
                free = -end
        return kept


def name_finder(gazetteer: DataFrame, max_rows: int = settings.GAZETTEER_MAX_ROWS, max_bytes: int = settings.BROADCAST_MAX_BYTES) -> Callable[[Column], Column]:
    """A function on columns, text -> array of (text, label, start); NULL for NULL.

    ``gazetteer`` is (name, label); of two labels of a name the first in order counts. One beyond the bounds raises
    ``OverflowError``: use ``find_names``, which first reduces it to the names that can occur.
    """
    names = settle(listed_names(gazetteer))
    size = names.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("name") + F.octet_length("label")).alias("bytes")).first()
    if size.rows > max_rows or (size.bytes or 0) > max_bytes:
        raise OverflowError(f"a gazetteer of {size.rows} names and {size.bytes} bytes is not sent around")
    shared = names.sparkSession.sparkContext.broadcast(NameAutomaton((r.name, r.label) for r in names.collect()))

    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.Series:
        automaton = shared.value
        return texts.map(lambda text: None if text is None else [{"text": t, "label": label, "start": s} for t, label, s in automaton.find(text)])

    return find


def find_names(df: DataFrame, gazetteer: DataFrame, text: str = "text", into: str = "names", max_rows: int = settings.GAZETTEER_MAX_ROWS,
               max_bytes: int = settings.BROADCAST_MAX_BYTES) -> DataFrame:
    """Add the names of a text, in their order.

    A gazetteer too large to be sent around is first reduced, in a batch, to names whose rarest token occurs in the texts at
    all; one that is still too large raises ``OverflowError``.
    """
    try:
        find = name_finder(gazetteer, max_rows, max_bytes)
    except OverflowError:
        if df.isStreaming:
            raise
        find = name_finder(occurring(df, gazetteer, text), max_rows, max_bytes)
    return df.withColumn(into, find(F.col(text)))


def occurring(df: DataFrame, gazetteer: DataFrame, text: str = "text") -> DataFrame:
    """The names all of whose tokens occur somewhere in the texts."""
    pattern = F.lit(r"(?:[\p{L}\p{N}]|[\x{0300}-\x{036F}])+")
    tokens = lambda column: F.regexp_extract_all(F.lower(column), pattern, F.lit(0))
    names = listed_names(gazetteer)
    each = settle(names.select("name", "label", F.explode(F.array_distinct(tokens(F.col("name")))).alias("token")))
    wanted = settle(each.select("token").distinct())
    seen = join_dimension(df.select(F.explode(F.array_distinct(tokens(F.col(text)))).alias("token")), wanted, ["token"], "left_semi", settled=True).distinct()
    missing = wanted.join(settle(seen), "token", "left_anti")
    lost = each.join(missing, "token").select("name").distinct()
    return names.join(lost, "name", "left_anti")
