"""Runs of words against brute force, on odd tables and through the query."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lamina.llm import queries, runs
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, `Runs` string, `a.b` int, collapsed string"


def brute_runs(words, least=12):
    """(start, length, period) of all runs, by looking at every period and start."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((a, length, q) for (a, length), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    dropped = {i for a, length, q in found for i in range(a + q, a + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def found_in(texts, least=12):
    ids = np.array([w for t in texts for w in t], np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    ends = np.cumsum([len(t) for t in texts])
    out = [[] for _ in texts]
    for a, b, q in zip(*(c.tolist() for c in runs.runs_of(ids, owner, least))):
        i = int(np.searchsorted(ends, a, side="right"))
        before = int(ends[i]) - len(texts[i])
        assert b <= ends[i]
        out[i].append((a - before, b - a, q))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), max_size=4))
def test_runs_of_few_words(texts):
    assert found_in(texts) == [brute_runs(t) for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_nested_repeats(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(40):
        parts = [[draw.randrange(30) for _ in range(draw.randint(1, 9))] for _ in range(3)]
        text = [w for _ in range(draw.randint(1, 25)) for w in draw.choice(parts)]
        tail = text[len(text) // 2 :]
        texts.append([*text, *tail, *tail, *(tail[:3] if draw.random() < 0.5 else [])])
    for least in (12, 20):
        assert found_in(texts, least) == [brute_runs(t, least) for t in texts]


def test_symbols_derive_their_text():
    text = np.array([9, 1, 2, 1, 2, 3, 1, 2, 8, 3, 1, 2, 3, 1, 2, 7])
    first, last = np.array([1, 9]), np.array([8, 15])
    grammar = runs.Grammar(text, first, last)

    def derive(symbol):
        if symbol < grammar.terminals:
            return [symbol]
        return derive(grammar.left[symbol]) + derive(grammar.right[symbol])

    for root, a, b in zip(grammar.roots, first, last):
        assert derive(root) == text[a:b].tolist()
    for symbol in range(grammar.terminals, len(grammar.size)):
        place = grammar.place[symbol]
        assert derive(symbol) == text[place : place + grammar.size[symbol]].tolist()


def cases():
    line = " ".join(f"w{i}" for i in range(9))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a " * 11), (6, "a b " * 12), (7, "A a " * 6),
        (8, f"{line}\n" * 4 + "end"), (9, f"x {line} {line}"), (9, f"x {line} {line}"), (None, "é\x0bè " * 7),
        (10, "go " * 40_000), (11, " ".join(str(i % 7919) for i in range(60_000))),
        (12, "ab " * 20 + "c " * 15 + "ab " * 20), (13, "word" * 400_000 + " b" * 13),
    ]


def test_find_runs_on_odd_rows(spark):
    rows = [(i, t, "mine", 7, "mine") for i, t in cases()]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = runs.find_runs(docs).collect()
    assert runs.find_runs(docs).columns == ["doc_id", "text", "a.b", "n_words", "runs", "collapsed"]
    expected = []
    for i, text in cases():
        words = words_of(text)
        # Long texts of known runs: too long for brute force.
        found = {10: [(0, 40_000, 1)], 11: [(0, 60_000, 7919)]}.get(i) or brute_runs(words)
        expected.append((i, len(words), found, brute_collapsed(words, found)))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=key) == sorted(
        expected, key=key
    )
    assert {r["a.b"] for r in got} == {7} and {r.text for r in got} == {t for _, t in cases()}
    nothing = spark.createDataFrame([], SCHEMA)
    assert runs.find_runs(nothing).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(docs, least=5)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_by_brute_force(spark, folder):
    draw = random.Random(5)
    rows = [(i, t) for i, t in cases() if i not in (10, 11, 13)]
    rows += [(i, " ".join(f"t{draw.randint(0, 300)}" for _ in range(draw.randint(1, 200)))) for i in range(100, 200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = queries.QUERIES["op13_grammar_runs"](spark, folder).collect()
    expected, changed = [], 0
    for i, text in rows:
        words, h = words_of(text), None if i is None else zlib.crc32(str(i).encode())
        n = len(words)
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            changed += 1
        found = brute_runs(words)
        best = min(((-length, a, q) for a, length, q in found), default=None)
        longest = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        listed = "".join(f"{a},{length},{q}\n" for a, length, q in found)
        expected.append((i, len(found), *longest, sha(listed), sha(brute_collapsed(words, found))))
    assert changed > 3
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_query_on_the_tables_has_runs(spark):
    found = queries.QUERIES["op13_grammar_runs"](spark, SMALL).collect()
    assert len(found) == 200 and sum(r.n_runs > 0 for r in found) >= 10
