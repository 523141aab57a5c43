"""Runs of repeated words in texts, found in a grammar of the word ids.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are the same) and a length of at
least ``2 * q`` that neither neighbour extends. Runs of a text are found in four steps:

1. Words become ids. A run of twelve words or more consists of words that lie in six-word windows
   that the text has twice, so everything else is left out at once, and the stretches that stay are treated alike
   until nothing more goes.
2. Re-Pair: the most frequent pairs of neighbouring symbols become new symbols, round by round, each round
   replacing all pairs that are more frequent than the pairs they overlap with. When no pair occurs twice,
   neighbours are paired until every stretch is one symbol, so that the whole stretch has a derivation.
3. A run lies inside the words of some symbol and crosses the boundary between its two parts. The runs across
   the boundary of each symbol are found once, from how far the words before and behind the boundary
   agree with those one period on.
4. They are translated to every place where the symbol is derived. A run that a neighbouring word extends
   there is dropped: a symbol further up has all of it. Equal intervals keep the smallest period.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.tables import others, with_text
from lamina.llm.words import mix, slices

_WINDOW = 6  # words that a run of twelve words or more has twice, one period apart
_PIECE = 1 << 20  # bytes of a text that are split into words at once
_REMEMBERED = 500_000
_ROUNDS = 8  # of leaving out words that no run has
_PAIRS = 1 << 20  # periods of symbols that are looked at together
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_ADDED = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class _Ids(dict):
    """A number for every different word."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, those of about a megabyte at a time; words are parted by ASCII white space."""
    first = 0
    while len(raw) - first > _PIECE:
        last = first + _PIECE
        # On to the end of the word at the border.
        while last < len(raw) and raw[last] not in b" \t\n\v\f\r":
            last += 1
        yield raw[first:last].split()
        first = last
    yield raw[first:].split()


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def _stretches(ids: np.ndarray, owner: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) of the stretches of words in windows that their text has twice.

    ``owner`` tells the texts apart. Stretches are the texts of the next round, so that windows go which only other
    parts of a text repeat. Windows are told apart by hashes: two that share one only keep a stretch that
    might have gone, and so does an end of the rounds before the last stretch has settled.
    """
    place, group = np.arange(len(ids)), owner
    for _ in range(_ROUNDS):
        starts = max(0, len(place) - _WINDOW + 1)
        words = ids[place].astype(np.uint64) + np.uint64(1)
        total = np.zeros(starts, np.uint64)
        for i in range(_WINDOW):
            total = mix(total * _FACTOR + words[i : starts + i])
        # Windows of neighbouring words of one text or stretch only.
        whole = (group[_WINDOW - 1 :] == group[:starts]) & (place[_WINDOW - 1 :] - place[:starts] == _WINDOW - 1)
        at = np.flatnonzero(whole)
        at = at[_repeated(mix(total[at] ^ (group[at].astype(np.uint64) * _FACTOR)))]
        n = len(place) + 1
        covered = np.cumsum(np.bincount(at, minlength=n) - np.bincount(at + _WINDOW, minlength=n))[:-1] > 0
        held, texts = place[covered], group[covered]
        number = np.cumsum((np.diff(held, prepend=-2) != 1) | (np.diff(texts, prepend=-1) != 0)) - 1
        long_enough = (np.bincount(number) >= least)[number] if len(held) else covered[:0]
        settled = bool(long_enough.all()) and len(held) == len(place)
        place, group = held[long_enough], number[long_enough]
        if settled or not len(place):
            break
    fresh = np.flatnonzero(np.diff(group, prepend=-1))
    return place[fresh], place[np.append(fresh[1:], len(place)) - 1] + 1 if len(fresh) else place


class Grammar:
    """A Re-Pair grammar of several stretches of ids; ``first`` and ``last`` (exclusive) bound them in ``text``.

    ``text`` has an id of its own, which occurs nowhere else, before and behind every stretch. Symbols below
    ``terminals`` are ids; a larger symbol derives ``left`` and ``right``, of ``size`` words in all, for the first time
    at ``place``. ``roots`` are the symbols of the stretches.
    """

    def __init__(self, text: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.terminals = int(text.max()) + 1
        place = np.concatenate([np.arange(a, b) for a, b in zip(first, last)])
        symbols = text[place]
        stretch = np.repeat(np.arange(len(first)), last - first)
        tables: list[tuple[np.ndarray, ...]] = []
        n_symbols, sizes = self.terminals, np.ones(self.terminals, np.int64)
        self.rounds = [n_symbols]
        frequent = True
        while len(symbols) > len(first):
            inside = stretch[1:] == stretch[:-1]
            keys = np.where(inside, symbols[:-1] * np.int64(n_symbols) + symbols[1:], -1)
            if frequent:
                known, code, counts = np.unique(keys, return_inverse=True, return_counts=True)
                taken = _more_frequent(keys, code, counts, inside)
                frequent = taken is not None
            if not frequent:
                # No pair occurs twice: neighbours, from the start of each stretch.
                begin = np.flatnonzero(np.concatenate(([True], ~inside)))
                offset = np.arange(len(symbols)) - np.repeat(begin, np.diff(np.append(begin, len(symbols))))
                taken = np.flatnonzero(inside & (offset[:-1] % 2 == 0))
            pairs, index, code = np.unique(keys[taken], return_index=True, return_inverse=True)
            left, right = pairs // n_symbols, pairs % n_symbols
            tables.append((left, right, sizes[left] + sizes[right], place[taken[index]]))
            sizes = np.concatenate((sizes, tables[-1][2]))
            symbols[taken] = n_symbols + code
            n_symbols += len(pairs)
            self.rounds.append(n_symbols)
            stays = np.ones(len(symbols), bool)
            stays[taken + 1] = False
            symbols, place, stretch = symbols[stays], place[stays], stretch[stays]
        self.roots = symbols
        self.size = sizes
        empty = np.zeros(self.terminals, np.int64)
        self.left, self.right, self.place = (
            np.concatenate([empty, *[t[i] for t in tables]]) for i in (0, 1, 3)
        )


def _more_frequent(keys: np.ndarray, code: np.ndarray, counts: np.ndarray, inside: np.ndarray) -> np.ndarray | None:
    """Where the pairs begin that one round replaces, None if no pair occurs twice.

    Pairs that occur more often than those they overlap with; of equally frequent ones that of the larger hash.
    In a row of one symbol every second pair counts.
    """
    often = inside & (counts[code] > 1)
    if not often.any():
        return None
    hashed = mix(keys.astype(np.uint64) * _FACTOR) >> np.uint64(24)
    rank = np.where(often, (np.minimum(counts[code], (1 << 22) - 1) << 40) + hashed.astype(np.int64), -1)
    # Rows of one symbol are one group of overlapping equal pairs.
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    length = np.diff(np.append(begin, len(keys)))
    ranks = rank[begin]
    before = np.concatenate(([-1], ranks[:-1]))
    behind = np.concatenate((ranks[1:], [-1]))
    best = (ranks >= 0) & (ranks > before) & (ranks > behind)
    # Different pairs of one rank: the first of them, so that every round replaces something.
    best |= (ranks >= 0) & (ranks > before) & (ranks == behind)
    offset = np.arange(len(keys)) - np.repeat(begin, length)
    return np.flatnonzero(np.repeat(best, length) & (offset % 2 == 0))


class _Agreement:
    """How many ids agree behind or before two places: names of all stretches of 1, 2, 4, ... ids."""

    def __init__(self, text: np.ndarray, longest: int):
        self.names = [text]
        span = 1
        while 2 * span <= min(longest, len(text)):
            name = self.names[-1]
            both = name[: len(name) - span].astype(np.int64) * (int(name.max()) + 1) + name[span:]
            self.names.append(np.unique(both, return_inverse=True)[1])
            span *= 2

    def same(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the ``2 ** level`` ids from ``i`` and ``j`` on are equal; False where they leave the text."""
        if level >= len(self.names):
            return np.zeros(len(i), bool)
        names = self.names[level]
        known = (i >= 0) & (j >= 0) & (i < len(names)) & (j < len(names))
        return known & (names[np.where(known, i, 0)] == names[np.where(known, j, 0)])

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        found = np.zeros(len(i), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            found += self.same(level, i + found, j + found).astype(np.int64) << level
        return found

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        found = np.zeros(len(i), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            step = 1 << level
            found += self.same(level, i - found - step, j - found - step).astype(np.int64) << level
        return found


def _least_period(columns: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Of rows that agree on all but the last column, the period, the one of the smallest."""
    if not len(columns[0]):
        return columns
    order = np.lexsort(columns[::-1])
    columns = tuple(c[order] for c in columns)
    fresh = np.zeros(len(order), bool)
    fresh[0] = True
    for c in columns[:-1]:
        fresh[1:] |= c[1:] != c[:-1]
    return tuple(c[fresh] for c in columns)


def _crossing(grammar: Grammar, agreement: _Agreement, least: int) -> tuple[np.ndarray, ...]:
    """Symbol, first and last (exclusive) word inside it and period of the runs across its boundary."""
    symbols = np.flatnonzero(grammar.size >= least)
    symbols = symbols[symbols >= grammar.terminals]
    size, start = grammar.size[symbols], grammar.place[symbols]
    left = grammar.size[grammar.left[symbols]]
    found: list[tuple[np.ndarray, ...]] = []
    for forward, part in ((True, size - left), (False, left)):
        periods = np.minimum(part, size // 2)
        total = np.cumsum(periods)
        first = 0
        while first < len(symbols):
            done = total[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(total, done + _PAIRS, side="right")))
            own = np.repeat(np.arange(first, last), periods[first:last])
            q = np.arange(len(own)) - np.repeat(total[first:last] - periods[first:last] - done, periods[first:last]) + 1
            first = last
            # Words before and behind the boundary, and those a period further on.
            i = start[own] + left[own] - (0 if forward else q)
            j = i + q
            # Six words at least agree around the boundary: two before it or four behind it do.
            near = agreement.same(1, i - 2, j - 2) | agreement.same(2, i, j)
            own, q, i, j = own[near], q[near], i[near], j[near]
            a = np.maximum(i - agreement.before(i, j), start[own])
            b = np.minimum(j + agreement.behind(i, j), start[own] + size[own])
            border = start[own] + left[own]
            run = (b - a >= np.maximum(2 * q, least)) & (a < border) & (b > border)
            own, q, a, b = own[run], q[run], a[run], b[run]
            found.append((symbols[own], a - start[own], b - start[own], q))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return _least_period(tuple(np.concatenate(c) for c in zip(*found)))


def _derived(grammar: Grammar, first: np.ndarray, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Symbols with their places, level by level of the derivations; parts without any of ``symbols`` are left out."""
    wanted = np.zeros(len(grammar.size), bool)
    wanted[symbols] = True
    for a, b in zip(grammar.rounds, grammar.rounds[1:]):
        wanted[a:b] |= wanted[grammar.left[a:b]] | wanted[grammar.right[a:b]]
    symbol, place = grammar.roots, first
    while True:
        keep = wanted[symbol]
        symbol, place = symbol[keep], place[keep]
        if not len(symbol):
            return
        yield symbol, place
        left = grammar.left[symbol]
        symbol, place = (
            np.concatenate((left, grammar.right[symbol])),
            np.concatenate((place, place + grammar.size[left])),
        )


def runs_of(ids: np.ndarray, owner: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, last word (exclusive) and period of all runs, by first word and period.

    ``ids`` are the words of several texts behind each other and ``owner`` the number of the text of each word.
    """
    none = (np.zeros(0, np.int64),) * 3
    firsts, lasts = _stretches(ids, owner, least)
    if not len(firsts):
        return none
    length = lasts - firsts
    # The stretches behind each other, with a number of its own before each and behind the last.
    at = np.cumsum(length + 1) - length
    words = np.concatenate([ids[a:b] for a, b in zip(firsts, lasts)])
    known, code = np.unique(words, return_inverse=True)
    text = np.empty(int(at[-1] + length[-1]) + 1, np.int64)
    borders = np.append(at - 1, len(text) - 1)
    text[borders] = len(known) + np.arange(len(borders))
    inside = np.ones(len(text), bool)
    inside[borders] = False
    text[inside] = code
    grammar = Grammar(text, at, at + length)
    agreement = _Agreement(text, int(length.max()))
    symbol, a, b, q = _crossing(grammar, agreement, least)
    if not len(symbol):
        return none
    begin = np.searchsorted(symbol, np.arange(len(grammar.size) + 1))
    found = []
    for derived, place in _derived(grammar, at, symbol):
        own = begin[derived + 1] - begin[derived]
        row = np.repeat(begin[derived], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        x, y, period = a[row] + np.repeat(place, own), b[row] + np.repeat(place, own), q[row]
        whole = (text[x - 1] != text[x - 1 + period]) & (text[y] != text[y - period])
        found.append((x[whole], y[whole], period[whole]))
    x, y, period = _least_period(tuple(np.concatenate(c) for c in zip(*found)))
    # Back to the words of the texts.
    back = np.searchsorted(at, x, side="right") - 1
    x, y = x - at[back] + firsts[back], y - at[back] + firsts[back]
    order = np.lexsort((period, x))
    return x[order], y[order], period[order]


def find_runs(docs: DataFrame, least: int = 12, text_column: str = "text") -> DataFrame:
    """Every row with ``n_words``, its ``runs`` (start, length and period in words) and the text without them.

    Words are runs of characters other than ASCII white space, told apart by their bytes. A run has ``least``
    words or more (12 at least) and two periods or more; ``runs`` are sorted by start and period. ``collapsed`` has
    one space between the words that no run contains behind its first period. Null and empty texts have no
    words and no runs and collapse to an empty text; repeated rows are texts of their own; a text of any length is taken
    whole, and its ids and grammar have to fit one task. An empty table gives no rows. Other columns stay as they are;
    those that are called like an added one, in any case of letters, are replaced.
    """
    if least < 2 * _WINDOW:
        raise ValueError(f"runs have {2 * _WINDOW} words at least, not {least}")
    added = T._parse_datatype_string(_ADDED)
    kept = others(docs, added.names)
    schema = T.StructType([docs.schema[c] for c in kept] + added.fields)
    texts, name = with_text(docs, kept, text_column)
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Ids()
        for batch in batches:
            for part in slices(batch, name):
                if len(memo) > _REMEMBERED:
                    memo.clear()
                columns = [part.column(i) for i in range(len(kept))] + _found(part.column(name), memo, least)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.mapInArrow(find, schema)


def _found(column: pa.Array, memo: _Ids, least: int) -> list[pa.Array]:
    """The added columns of one batch of texts."""
    texts = [(t or "").encode() for t in column.to_pylist()]
    held, counts, plain = [], [], []
    for raw in texts:
        n, joined = 0, []
        for words in _pieces(raw):
            held.append(np.fromiter(map(memo.__getitem__, words), np.int64, len(words)))
            n += len(words)
            joined.append(b" ".join(words))
        counts.append(n)
        plain.append(b" ".join(filter(None, joined)))
    n_words = np.array(counts, np.int64)
    ends = np.cumsum(n_words)
    ids = np.concatenate([np.zeros(0, np.int64), *held])
    x, y, q = runs_of(ids, np.repeat(np.arange(len(texts)), n_words), least)
    text_of = np.searchsorted(ends, x, side="right")
    if len(x):
        edge = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edge, x + q, 1)
        np.add.at(edge, y, -1)
        stays = np.cumsum(edge[:-1]) == 0
        for i in np.unique(text_of).tolist():
            at, joined = int(ends[i] - n_words[i]), []
            for words in _pieces(texts[i]):
                joined.append(b" ".join(compress(words, stays[at : at + len(words)].tolist())))
                at += len(words)
            plain[i] = b" ".join(filter(None, joined))
    offsets = np.searchsorted(text_of, np.arange(len(texts) + 1)).astype(np.int32)
    start = x - (ends - n_words)[text_of]
    run = pa.StructArray.from_arrays(
        [pa.array(start), pa.array(y - x), pa.array(q)], names=["start", "length", "period"]
    )
    return [
        pa.array(n_words),
        pa.ListArray.from_arrays(pa.array(offsets), run),
        pa.array([p.decode() for p in plain], pa.string()),
    ]


def longest(runs: str = "runs") -> F.Column:
    """The run of the greatest length, of these of the smallest start and then period; null without any."""
    # Structs compare field by field.
    keyed = F.transform(
        runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))
    )
    best = F.array_max(keyed)
    return F.struct((-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period"))


def repeat_tails(docs: DataFrame, number: F.Column, text_column: str = "text") -> DataFrame:
    """Texts whose words from some word on repeat with some period, both chosen by ``number`` (null: left alone).

    Word ``number % n`` of ``n`` begins the period of ``1 + (n - a) div (3 + number % 8)`` words; the words
    are joined by one space. Texts without words are left alone.
    """
    words = F.filter(F.split(text_column, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = F.pmod(number, n)
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(number, F.lit(8))))).cast("int")
    period = F.slice(words, (a + 1).cast("int"), p)
    whole = F.flatten(F.array_repeat(period, F.floor((n - a) / p).cast("int")))
    rest = F.slice(period, F.lit(1), F.pmod(n - a, p).cast("int"))
    tail = F.concat(F.slice(words, F.lit(1), a.cast("int")), whole, rest)
    # The words of texts that are left alone are never split.
    made = F.when(n > 0, F.array_join(tail, " ")).otherwise(F.col(text_column))
    return docs.withColumn(text_column, F.when(number.isNull(), F.col(text_column)).otherwise(made))
