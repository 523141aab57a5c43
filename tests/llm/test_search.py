"""Ranked search against brute force, on odd tables."""

import math
import random
import re
from collections import Counter

import pytest

from lamina.llm import search
from tests.llm.test_operators import BYTES

PATTERN = rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(PATTERN, (text or "").encode().translate(BYTES))


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in held), sum(n for _, _, n in held)
    df = Counter(t for _, tf, _ in held for t in tf)
    out = []
    for item, text in items:
        scores = []
        for i, tf, n in held:
            score = 0
            for t in terms(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * (25 + (75 * n * n_docs) // n_terms)))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=repr)


def tables():
    draw = random.Random(3)
    words = ["Alpha", "beta", "Straße", "İx", "x1", "δelta", "gamma"] + [f"w{i}" for i in range(60)]
    joint = [" ", ", ", "\n", "--", "_", "\x00", " "]
    text = lambda n: "".join(draw.choice(words) + draw.choice(joint) for _ in range(n))
    docs = [(i, text(draw.randint(1, 60))) for i in range(150)]
    docs += [(200 + i, docs[0][1]) for i in range(30)]  # more ties than ranks
    docs += [(3, docs[3][1]), (None, docs[5][1]), (7, None), (8, ""), (9, "...--"), (400, text(40_000)), (401, "beta " * 9)]
    items = [(i, text(draw.randint(1, 12))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "?!"), (33, "unheard words"), (34, "beta beta BETA"), (2, items[2][1]), (None, "x1 δelta")]
    return docs, items


@pytest.mark.parametrize("group_bytes", [1 << 20, 300])
def test_search_by_brute_force(spark, group_bytes):
    docs, items = tables()
    table = spark.createDataFrame([(i, t, 5, "s") for i, t in docs], "doc_id long, text string, score int, `terms` string")
    wanted = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, doc_id int")
    found = search.search(table.repartition(5), wanted, group_bytes=group_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, items)


def test_sums_beyond_doubles_are_exact(spark, monkeypatch):
    docs, items = tables()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    wanted = spark.createDataFrame(items, "item_id long, text string")
    whole = search._summed
    import numpy as np

    first, last = np.array([0, 1]), np.array([1, 2])
    big = np.array([2**53, 1], np.int64)
    got = whole(np.array([0, 0]), big, first, last, np.array([0, 0]), np.array([1, 1]), 1, 1, False)
    assert got.tolist() == [[2**53 + 1]]
    monkeypatch.setattr(search, "_SCORES", 64)
    monkeypatch.setattr(search, "_PARTS", 16)
    assert sorted(map(tuple, search.search(table, wanted, k=3).collect()), key=repr) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = tables()
    table, wanted = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert search.search(table.limit(0), wanted).count() == 0
    assert search.search(table, wanted.limit(0)).count() == 0
    assert search.search(table.where("doc_id in (7, 8, 9) AND (text IS NULL OR text IN ('', '...--'))"), wanted).count() == 0
