"""Benchmark passages in documents, found by a generalised suffix automaton of the benchmark items.

The words of an item set are put into one automaton that accepts every run of words of any item.
Document words are streamed through it; the length of the longest run that ends at a word tells at
once whether one of the windows of the items ends there. Runs of words that no item can contain are
skipped with numpy before, by the pairs of neighbouring words that the items have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.tables import others, with_text
from lamina.llm.words import ALNUM, Texts, slices

_MAP_BITS = 20
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_FOUND = "n_words long, spans array<struct<first:int,last:int>>, items array<string>"


class SuffixAutomaton:
    """All runs of words of the items. Windows are runs of ``window`` words, or a whole shorter item."""

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int):
        self.window = window
        self._next: list[dict[int, int]] = [{}]
        self._link = [-1]
        self._length = [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        order = sorted(range(1, len(self._length)), key=self._length.__getitem__)
        # The state of the run of ``window`` words that ends where a state's runs end.
        self._top = [0] * len(self._length)
        for state in order:
            if self._length[state] >= window:
                up = self._link[state]
                self._top[state] = self._top[up] if self._length[up] >= window else state
        self._items: dict[int, set[str]] = {}
        whole: dict[int, list[tuple[int, str | None]]] = {}
        for name, words in items:
            state = 0
            for at, word in enumerate(words, 1):
                state = self._next[state][word]
                if at >= window and name is not None:
                    self._items.setdefault(self._top[state], set()).add(name)
            if words and len(words) < window:
                whole.setdefault(state, []).append((len(words), name))
        # Short items that end where a state's runs end: its own and those of its suffixes.
        self._short: list[tuple[tuple[int, str | None], ...]] = [()] * len(self._length)
        for state in order if whole else ():
            self._short[state] = (*whole.get(state, ()), *self._short[self._link[state]])

    def _extend(self, last: int, word: int) -> int:
        """Add a word behind the run that ``last`` stands for; returns the state of the longer run."""
        known = self._next[last].get(word)
        if known is not None:
            if self._length[known] == self._length[last] + 1:
                return known
            return self._split(last, word, known)
        state = self._new({}, self._length[last] + 1)
        at = last
        while at != -1 and word not in self._next[at]:
            self._next[at][word] = state
            at = self._link[at]
        if at == -1:
            self._link[state] = 0
        else:
            known = self._next[at][word]
            shorter = self._length[known] == self._length[at] + 1
            self._link[state] = known if shorter else self._split(at, word, known)
        return state

    def _new(self, following: dict[int, int], length: int) -> int:
        self._next.append(following)
        self._length.append(length)
        self._link.append(0)
        return len(self._length) - 1

    def _split(self, at: int, word: int, known: int) -> int:
        """Part the runs of a state that end behind ``at`` from its longer ones."""
        part = self._new(dict(self._next[known]), self._length[at] + 1)
        self._link[part] = self._link[known]
        self._link[known] = part
        while at != -1 and self._next[at].get(word) == known:
            self._next[at][word] = part
            at = self._link[at]
        return part

    def scan(self, words: list[int], hit: np.ndarray, found: set[str]) -> None:
        """Mark in ``hit`` the words inside windows, and collect the items that have those windows."""
        state = length = 0
        for at, word in enumerate(words):
            while state and word not in self._next[state]:
                state = self._link[state]
                length = self._length[state]
            after = self._next[state].get(word)
            if after is None:
                continue
            state, length = after, length + 1
            if length >= self.window:
                # Earlier windows of a longer run are marked already.
                hit[at + 1 - self.window : at + 1] = True
                found |= self._items.get(self._top[state], set())
            for size, name in self._short[state]:
                if size <= length:
                    hit[at + 1 - size : at + 1] = True
                    if name is not None:
                        found.add(name)


class Matcher:
    """The automaton of some items, behind filters on the hashes of words and of word pairs."""

    def __init__(self, names: list[str | None], texts: list[str], window: int):
        column = Texts(pa.array(texts, pa.string()), ALNUM)
        vocabulary, codes = np.unique(column.hashes, return_inverse=True)
        self._codes = {int(h): i for i, h in enumerate(vocabulary)}
        items = [
            (name, codes[column.bounds[i] : column.bounds[i + 1]].tolist()) for i, name in enumerate(names)
        ]
        self._automaton = SuffixAutomaton(items, window)
        lengths = [min(len(words), window) for _, words in items if words]
        self._shortest = min(lengths, default=0)
        self._words = np.zeros(1 << _MAP_BITS, bool)
        self._words[_slot(vocabulary)] = True
        self._pairs = np.zeros(1 << _MAP_BITS, bool)
        for i in range(len(column)):
            self._pairs[_slot(_paired(column.words(i)))] = True

    def match(self, texts: Texts, i: int) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of hit words of a text (last exclusive, apart from each other), and the items found."""
        words = texts.words(i)
        found: set[str] = set()
        if not self._shortest or len(words) < self._shortest:
            return [], found
        if self._shortest == 1:
            near, more = self._words[_slot(words)], 0
        else:
            near, more = self._pairs[_slot(_paired(words))], 1
        firsts, lasts = _runs(near)
        long_enough = lasts - firsts + more >= self._shortest
        hit = None
        for first, last in zip(firsts[long_enough], lasts[long_enough] + more):
            if hit is None:
                hit = np.zeros(len(words), bool)
            run = [self._codes.get(h, -1) for h in words[first:last].tolist()]
            self._automaton.scan(run, hit[first:last], found)
        if hit is None:
            return [], found
        firsts, lasts = _runs(hit)
        return list(zip(firsts.tolist(), lasts.tolist())), found


def _slot(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - _MAP_BITS)


def _paired(hashes: np.ndarray) -> np.ndarray:
    return (hashes[:-1] ^ (hashes[1:] >> np.uint64(7))) * _PAIR + hashes[1:]


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) of each run of True."""
    padded = np.concatenate(([False], mask, [False]))
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    return edges[::2], edges[1::2]


# The matcher of the items last used in this process; tasks of one stage share it.
_LAST: dict[tuple, Matcher] = {}


def _matcher(names: list[str | None], texts: list[str], window: int) -> Matcher:
    key = (window, hash(tuple(names)), hash(tuple(texts)))
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = Matcher(names, texts, window)
    return _LAST[key]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    group_bytes: int = 2 << 20,
) -> DataFrame:
    """Every row with ``n_words``, ``spans`` (ranges of hit words, last exclusive) and ``items``.

    Words are runs of letters, digits and characters beyond ASCII, in lower case. A window is
    ``window`` neighbouring words of an item, or a whole item of fewer; an item without words, or a
    null one, has none. Null and empty texts have no words. Items are listed once each, by id as
    text, in text order; an item without an id marks words but is not listed. Input columns that are
    called like an added one are replaced.

    Items go to the tasks in groups of about ``group_bytes`` of text, chosen by a hash, and the rows
    pass through one automaton after the other without a shuffle, so memory does not grow with the
    benchmark; a single item is never parted.
    """
    added = T._parse_datatype_string(_FOUND).names
    kept = others(docs, added)
    rows, text = with_text(docs, kept, text_column)
    found = _searched(rows, items, window, text, item_id, item_text, group_bytes)
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *added)


def _searched(
    rows: DataFrame, items: DataFrame, window: int, text: str, item_id: str, item_text: str, group_bytes: int,
    finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
) -> DataFrame:
    """Rows with what all groups of items find in them; ``finish`` gives the rows their last form, without what was added."""
    schema = T._parse_datatype_string(_FOUND)
    found = rows.withColumns(
        {
            "n_words": F.lit(None).cast("long"),
            "spans": F.array().cast(schema["spans"].dataType),
            "items": F.array().cast(schema["items"].dataType),
        }
    )
    texts = items.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("body"))
    texts = texts.where("body is not null")
    total = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n_groups = max(1, -(-total // group_bytes))
    for group in range(n_groups):
        own = texts.where(F.pmod(F.xxhash64("name", "body"), F.lit(n_groups)) == group).collect()
        names, bodies, last = [r.name for r in own], [r.body for r in own], group == n_groups - 1
        out = rows.schema if last and finish is not None else found.schema
        found = _pass(found, out, names, bodies, window, text, finish if last else None)
    return found


def _pass(
    docs: DataFrame, out: T.StructType, names: list[str | None], bodies: list[str], window: int, text_column: str,
    finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None,
) -> DataFrame:
    """Add what one group of items finds to the spans and items of the groups before it."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(names, bodies, window)
        for batch in batches:
            for part in slices(batch, text_column):
                found = _matched(part, matcher, text_column)
                yield found if finish is None else finish(found)

    return docs.mapInArrow(match, out)


def _matched(batch: pa.RecordBatch, matcher: Matcher, text_column: str) -> pa.RecordBatch:
    texts = Texts(batch.column(text_column), ALNUM)
    columns = {name: batch.column(name) for name in batch.schema.names}
    spans, items = columns["spans"].to_pylist(), columns["items"].to_pylist()
    for i in range(len(texts)):
        new_spans, new_items = matcher.match(texts, i)
        if new_spans:
            spans[i] = _merged([(s["first"], s["last"]) for s in spans[i]] + new_spans)
            items[i] = sorted(new_items.union(items[i]))
    columns["n_words"] = pa.array(np.diff(texts.bounds), pa.int64())
    columns["spans"] = pa.array(spans, batch.schema.field("spans").type)
    columns["items"] = pa.array(items, batch.schema.field("items").type)
    return pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1]["last"]:
            out[-1]["last"] = max(last, out[-1]["last"])
        else:
            out.append({"first": first, "last": last})
    return out


def hit_words(spans: str = "spans") -> F.Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def remove_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    max_coverage: float = 0.5,
    text_column: str = "text",
    length_column: str | None = None,
    item_id: str = "item_id",
    item_text: str = "text",
    group_bytes: int = 2 << 20,
) -> DataFrame:
    """Documents without the passages they share with benchmark items; columns stay the same.

    Every hit span is cut out of the text, from its first to its last word. A document more than
    ``max_coverage`` of whose words are hit goes as a whole. Documents without a hit are not touched,
    null and empty texts among them. ``length_column`` is set anew to the characters of a text that
    was cut.
    """
    # Columns by number: input columns may be called like the added ones, or have dots in their names.
    text = f"c{docs.columns.index(text_column)}"
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    clean = _searched(
        renamed, items, window, text, item_id, item_text, group_bytes, lambda batch: _cut(batch, text, max_coverage)
    )
    columns = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}
    if length_column is not None:
        length = F.length(text).cast(docs.schema[length_column].dataType)
        columns[length_column] = F.coalesce(length, columns[length_column])
    return clean.select(*[column.alias(name) for name, column in columns.items()])


def _cut(batch: pa.RecordBatch, text_column: str, max_coverage: float) -> pa.RecordBatch:
    """The rows that are hit no more than they may be, without their spans."""
    n_words, spans = batch.column("n_words").to_pylist(), batch.column("spans").to_pylist()
    hit = [sum(s["last"] - s["first"] for s in own) for own in spans]
    kept = [i for i, n in enumerate(n_words) if hit[i] <= max_coverage * n]
    if len(kept) < batch.num_rows:
        batch, spans = batch.take(pa.array(kept, pa.int64())), [spans[i] for i in kept]
    names = [n for n in batch.schema.names if n not in ("n_words", "spans", "items")]
    columns = {name: batch.column(name) for name in names}
    rows = [i for i, s in enumerate(spans) if s]
    if rows:
        texts = Texts(batch.column(text_column), ALNUM)
        out = list(texts.texts)
        for i in rows:
            raw = texts.texts[i].encode()
            starts, ends = texts.spans(i)
            keep, at = [], 0
            for span in spans[i]:
                keep.append(raw[at : int(starts[span["first"]])])
                at = int(ends[span["last"] - 1])
            out[i] = b"".join([*keep, raw[at:]]).decode()
        columns[text_column] = pa.array(out, batch.schema.field(text_column).type)
    return pa.RecordBatch.from_arrays(list(columns.values()), names=names)
