"""Language of whole texts: known words first, then shorter and shorter character n-grams.

The model holds the log frequency, per language, of words and of character n-grams. A known word adds
its log frequencies; an unseen word is looked up by its n-grams of the longest length of which one is
known, and adds the mean of those; one without any known n-gram adds nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.tables import others, with_text

_WORD = re.compile(r"[^\W\d_]+")  # letters, and numerals that are no digits; what has no letter is left out
_ADDED = "lang_pred string, score double"
_KNOWN = 2  # occurrences in the sample that make a word known
_REMEMBERED = 400_000
UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Languages in ascending order, and rows of log frequencies by word and by n-gram."""

    languages: list[str]
    words: dict[str, np.ndarray]
    grams: list[dict[str, np.ndarray]]  # by length, the longest first

    def word_scores(self, word: str) -> np.ndarray | None:
        known = self.words.get(word)
        if known is not None:
            return known
        padded = f" {word} "
        for longest, grams in zip(range(len(self.grams), 0, -1), self.grams):
            found = [grams[g] for g in _grams(padded, longest) if g in grams]
            if found:
                return reduce(np.add, found) / np.float32(len(found))
        return None


def _grams(padded: str, n: int) -> list[str]:
    # The edge of a word alone says nothing of its language.
    return [g for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " "]


def _log_rows(counts: list[Counter], least: int) -> dict[str, np.ndarray]:
    """Log frequency per language of everything counted, half an occurrence added to each."""
    total = sum(counts, Counter())
    kept = [key for key, n in total.items() if n >= least]
    table = np.array([[c[key] for c in counts] for key in kept], np.float64).reshape(len(kept), len(counts))
    sums = np.array([sum(c.values()) + 0.5 * (len(kept) + 1) for c in counts])
    return dict(zip(kept, np.log((table + 0.5) / sums).astype(np.float32)))


def fit_language(
    docs: DataFrame,
    longest: int = 5,
    sample_per_language: int = 600,
    text_column: str = "text",
    lang_column: str = "lang",
    id_column: str = "doc_id",
    max_languages: int = 1000,
) -> LanguageModel | None:
    """Learn from at most ``sample_per_language`` labelled rows of each language, whole texts.

    The sample is the different rows of the smallest hashes of id and text, so it is the same in every run; a row
    counts once, however often it is there. Rows with a null language or text do not take part; without any row there is no
    model (None). The labels may be noisy: a text of several languages counts for the one it is labelled with.
    More than ``max_languages`` languages raise an error, as the model has a number per language for each word.

    The table is read twice, whatever the number of languages; words are counted by the tasks that hold the texts of
    the sample, and the driver gets the counts of different words only.
    """
    labelled = docs.select(
        F.col(lang_column).alias("lang"), F.col(text_column).alias("text"),
        F.xxhash64(F.lit("language"), id_column, text_column).alias("draw"),
    ).where("lang is not null and text is not null")
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("draw", 0.02).alias("n"))
    counts = counts.limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    # Rows are thinned by hash to about twice the sample of different rows before the smallest hashes are sorted out.
    share = F.lit(1.0)
    for row in counts:
        share = F.when(F.col("lang") == row.lang, F.lit(min(1.0, 2 * sample_per_language / max(row.n, 1)))).otherwise(share)
    thinned = labelled.where(F.pmod(F.col("draw"), F.lit(1 << 20)) < share * F.lit(1 << 20))
    # Copies combine in each task; then about twice the sample of each language is ordered.
    order = Window.partitionBy("lang").orderBy("draw", "text")
    own = thinned.groupBy("lang", "draw", "text").agg(F.count(F.lit(1)).alias("copies"))
    own = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_per_language)
    counted = own.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()
    words: dict[str, Counter] = {row.lang: Counter() for row in counts}
    for row in sorted(counted):
        words[row.lang][row.word] = row.n
    grams: dict[str, list[Counter]] = {}
    for lang, known in words.items():
        grams[lang] = [Counter() for _ in range(longest)]
        for word, n in known.items():
            for counter, length in zip(grams[lang], range(longest, 0, -1)):
                for gram in _grams(f" {word} ", length):
                    counter[gram] += n
    if not words:
        return None
    languages = sorted(words)
    by_length = [[grams[x][i] for x in languages] for i in range(longest)]
    return LanguageModel(
        languages,
        _log_rows([words[x] for x in languages], _KNOWN),
        [_log_rows(counters, _KNOWN if i < longest - 1 else 1) for i, counters in enumerate(by_length)],
    )


def _words(text: str) -> list[str]:
    """The words of a text in lower case."""
    words = _WORD.findall(text.lower())
    # Numerals such as a raised two are no letters; only what is not ASCII can hold them.
    return words if text.isascii() else [w for w in words if w.isalpha() or any(map(str.isalpha, w))]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each language has each word, for the rows of a task."""
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            counts.setdefault(lang, Counter()).update(_words(text))
    for lang, own in counts.items():
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([lang] * len(own), pa.string()), "word": pa.array(own.keys(), pa.string()),
             "n": pa.array(own.values(), pa.int64())}
        )


def predict_language(docs: DataFrame, model: LanguageModel | None, text_column: str = "text") -> DataFrame:
    """Every row with ``lang_pred`` and ``score``, the probability of that language.

    ``und`` with score 0 where the text is null or has no letter, or there is no model. A text whose
    words share no n-gram with the model gets the first language at equal chances. Ties go to the
    first language in ascending order. Input columns called like the added ones are replaced; rows
    keep their number.
    """
    added = T._parse_datatype_string(_ADDED)
    kept = others(docs, added.names)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    schema = T.StructType([docs.schema[c] for c in kept] + added.fields)
    texts, name = with_text(docs, kept, text_column)
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.predict(text.as_py()) for text in batch.column(name)]
            columns = [batch.column(i) for i in range(len(kept))]
            columns.append(pa.array([lang for lang, _ in found], pa.string()))
            columns.append(pa.array([score for _, score in found], pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.mapInArrow(predict, schema)


class Scorer:
    """Predictions of one task; remembers the scores of a bounded number of words."""

    def __init__(self, model: LanguageModel | None):
        self._model = model
        self._rows: dict[str, int] = {}
        self._table = np.zeros((0, 0), np.float32)

    def _restart(self) -> None:
        self._rows = {}
        self._table = np.zeros((1024, len(self._model.languages)), np.float32)

    def _row(self, word: str) -> int:
        scores = self._model.word_scores(word)
        row = self._rows[word] = len(self._rows)
        if row >= len(self._table):
            self._table = np.concatenate((self._table, np.zeros_like(self._table)))
        # What the model knows nothing of counts alike for all languages.
        self._table[row] = 0 if scores is None else scores
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _words(text) if text else []
        if not words or self._model is None:
            return UNDETERMINED, 0.0
        if not self._rows or len(self._rows) > _REMEMBERED:
            self._restart()
        rows = self._rows
        at = list(map(rows.get, words))
        if None in at:
            at = [self._row(w) if k is None and w not in rows else rows[w] for w, k in zip(words, at)]
        total = self._table[at].sum(axis=0, dtype=np.float64)
        best = int(np.argmax(total))
        return self._model.languages[best], float(1 / np.exp(total - total[best]).sum())
