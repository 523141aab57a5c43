"""Ranked search of whole texts for items, by an automaton of the terms of all items and without an index.

1. The terms of the items become one Aho-Corasick automaton; every term has a guard on both sides, so that it is found
   as a whole term only. Each document runs through it once and gives its number of terms and how often it has
   each item term.
2. Document counts of the terms come from these rows by one aggregate, and with them the weights.
3. Each task adds up the parts of the terms of a document by the items that have them, and keeps the best
   documents of each item; the best of all tasks are the answer.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.words import ALNUM, slices
from lamina.runtime import materialize

_GUARD = b" "
# Bytes of terms in lower case, all others as guards.
_GUARDED = bytes(
    (b + 0x20 if 0x41 <= b <= 0x5A else b) if ALNUM[b] else _GUARD[0] for b in range(256)
)
_SCORES = 1 << 19  # scores of documents by items that are held at once
_PARTS = 1 << 20  # parts that are added at once
_SPREAD = 32  # groups in which the best of the tasks are brought together first
_COUNTED = "doc_id long, n_terms long, terms array<int>, counts array<long>"
_BEST = "item int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII; A-Z in lower case."""
    return (text or "").encode().translate(_GUARDED).split(_GUARD) if text else []


def _guarded(term: bytes) -> str:
    # Bytes as characters: the automaton takes texts, and these keep one byte a character.
    return (_GUARD + term + _GUARD).decode("latin-1")


# The automaton last used in this process; tasks of one stage share it.
_LAST: dict[int, ahocorasick.Automaton] = {}


def _automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    key = hash(tuple(terms))
    if key not in _LAST:
        _LAST.clear()
        made = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            made.add_word(_guarded(term), number)
        made.make_automaton()
        _LAST[key] = made
    return _LAST[key]


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    group_bytes: int = 4 << 20,
) -> DataFrame:
    """The ``k`` best documents of each item: the item's id, ``rank`` (from 1), ``doc_id`` and ``score``.

    Scores are integers above 0: with N documents that have terms, L terms in all, n terms in a document and df
    documents that have a term, the weight of a term is ``floor(1000 ln((2N + 2) / (2df + 1)))``, the length of a document
    ``m = 25 + 75 n N div L``, and the part of a term that it has tf times ``weight * (10**9 tf div (1000 tf + 8 m))``;
    a term counts as often as the item has it. Equal scores go by ascending id, a null id last.

    Null and empty texts have no terms: such documents are never found, such items find nothing. Rows of ``docs`` are
    documents of their own, whatever their ids; rows of ``items`` are items of their own, and those of one text
    get the same documents. Empty tables give no rows. Other columns are not read.

    What is sent to the tasks is bounded: different item texts are dealt by a hash into groups of about
    ``group_bytes``, a single text is never parted, and the documents are scanned once for each group.
    """
    keyed = items.select(
        F.col(f"`{item_id}`").alias(item_id), F.sha2(F.col(f"`{item_text}`"), 256).alias("__key"),
        F.col(f"`{item_text}`").alias("__text"),
    ).where(F.length("__text") > 0)
    texts = materialize(keyed.select("__key", "__text").distinct(), "search-texts")
    total = texts.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    n_groups = max(1, -(-total // group_bytes))
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    best = None
    for group in range(n_groups):
        own = texts.where(F.pmod(F.xxhash64("__key"), F.lit(n_groups)) == group).orderBy("__key").collect()
        found = _search_group(rows, [r["__text"] for r in own], [r["__key"] for r in own], k)
        best = found if best is None else best.unionByName(found)
    joined = keyed.drop("__text").join(best, "__key")
    return joined.select(item_id, "rank", "doc_id", "score")


def _search_group(rows: DataFrame, texts: list[str], keys: list[str], k: int) -> DataFrame:
    """``__key``, ``rank``, ``doc_id`` and ``score`` of the best documents of some item texts."""
    spark = rows.sparkSession
    held = [Counter(t for t in terms_of(text) if t) for text in texts]
    terms = sorted(set().union(*held))
    number = {t: i for i, t in enumerate(terms)}
    counted = materialize(rows.mapInArrow(_counter(terms), _COUNTED), "search-counts")
    n_docs, n_terms = counted.agg(F.count_if(F.col("n_terms") > 0), F.sum("n_terms")).first()
    # At most one row for each term of the items.
    having = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(terms), np.int64)
    for term, df in having.collect():
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    # Which items have a term, and how often: rows of terms behind each other.
    cells = sorted((number[t], i, n) for i, terms_held in enumerate(held) for t, n in terms_held.items())
    by_term = np.array(cells, np.int64).reshape(-1, 3)
    scored = counted.where(F.size("terms") > 0).mapInArrow(
        _scorer(by_term, weights, len(texts), n_docs, n_terms or 0, k), _BEST
    )

    def top(frame: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    # Each task gives at most k rows an item; these are brought together in two steps, so that no
    # task gets the rows of all tasks.
    spread = scored.withColumn("spread", F.pmod(F.xxhash64("doc_id"), F.lit(_SPREAD)))
    best = top(top(spread, "item", "spread").drop("rank", "spread"), "item")
    names = spark.createDataFrame(list(enumerate(keys)), "item int, __key string")
    return best.join(F.broadcast(names), "item").select("__key", "rank", "doc_id", "score")


def _counter(terms: list[bytes]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(terms)
        for batch in batches:
            for part in slices(batch, "text"):
                lengths, ends, found, times = [], [0], [], []
                for text in part.column("text").to_pylist():
                    guarded = (text or "").encode().translate(_GUARDED)
                    lengths.append(len(guarded.split()))
                    if terms and lengths[-1]:
                        tf = Counter([v for _, v in automaton.iter(_guarded(guarded))])
                        found.extend(tf)
                        times.extend(tf.values())
                    ends.append(len(found))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                    ],
                    names=["doc_id", "n_terms", "terms", "counts"],
                )

    return count


def _scorer(by_term: np.ndarray, weights: np.ndarray, n_items: int, n_docs: int, n_terms: int, k: int):
    first = np.searchsorted(by_term[:, 0], np.arange(len(weights) + 1))
    of, times = by_term[:, 1], by_term[:, 2]
    # Sums of doubles are exact up to 2**53; beyond, integers are added one by one.
    most = np.bincount(of, times, minlength=n_items).max(initial=0) * int(weights.max(initial=0)) * 10**6
    exact = most < 2**53

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(n_items, k)
        for batch in batches:
            step = max(1, _SCORES // max(1, n_items))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = part.column("doc_id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
                m = 25 + (75 * part.column("n_terms").to_numpy() * n_docs) // n_terms
                lists = part.column("terms")
                doc = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy(zero_copy_only=False))
                term = lists.flatten().to_numpy()
                tf = part.column("counts").flatten().to_numpy()
                value = weights[term] * ((10**9 * tf) // (1000 * tf + 8 * m[doc]))
                best.add(_summed(doc, value, first[term], first[term + 1], of, times, len(ids), n_items, exact), ids, null)
        item, ids, null, scores = best.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=null), pa.array(scores, pa.int64())],
            names=["item", "doc_id", "score"],
        )

    return score


def _summed(
    doc: np.ndarray, value: np.ndarray, first: np.ndarray, last: np.ndarray, of: np.ndarray, times: np.ndarray,
    n_docs: int, n_items: int, exact: bool,
) -> np.ndarray:
    """Scores of documents by items: each value goes to all items that have its term."""
    total = np.zeros(n_docs * n_items, np.int64)
    many = last - first
    reach = np.cumsum(many)
    at = 0
    while at < len(doc):
        done = reach[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(reach, done + _PARTS, side="right")))
        n = many[at:to]
        cell = np.arange(n.sum()) + np.repeat(first[at:to] - (reach[at:to] - n - done), n)
        key = np.repeat(doc[at:to] * n_items, n) + of[cell]
        part = np.repeat(value[at:to], n) * times[cell]
        if exact:
            total += np.bincount(key, part, minlength=len(total)).astype(np.int64)
        else:
            np.add.at(total, key, part)
        at = to
    return total.reshape(n_docs, n_items)


class _Best:
    """The best documents of each item so far, ``k`` of an item at most."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.ones(n_items, np.int64)  # scores from which a document may be among the best
        self.item, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        item = np.concatenate((self.item, item))
        scores = np.concatenate((self.scores, scores[doc, item[len(self.item) :]]))
        ids = np.concatenate((self.ids, ids[doc]))
        null = np.concatenate((self.null, null[doc]))
        order = np.lexsort((ids, null, -scores, item))
        item = item[order]
        begin = np.searchsorted(item, item)
        rank = np.arange(len(item)) - begin
        stays = rank < self.k
        order = order[stays]
        self.item, self.scores, self.ids, self.null = item[stays], scores[order], ids[order], null[order]
        full = rank[stays] == self.k - 1
        self.least[self.item[full]] = self.scores[full]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return self.item, self.ids, self.null, self.scores
