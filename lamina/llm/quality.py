"""Quality of whole texts by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded by what its words look like, a small network
turns it into a hidden vector, gated attention learned from the labels of documents alone weighs the
passages, and the weighted sum is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.tables import others, with_text
from lamina.llm.words import SPACED, Texts, slices

PASSAGE = 64  # words
_KINDS = np.zeros((4, 256), bool)  # letters, digits, upper case, beyond ASCII
_KINDS[0, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_KINDS[1, 0x30:0x3A] = True
_KINDS[2, 0x41:0x5B] = True
_KINDS[3, 0x80:] = True
FEATURES = 12


def passage_features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a batch, and the first passage of each text and their end.

    A passage is 64 neighbouring words, the last of a text fewer; a text without words is one
    passage of zeros.
    """
    n_words = np.diff(texts.bounds)
    n_passages = np.maximum(-(-n_words // PASSAGE), 1)
    ends = np.concatenate(([0], np.cumsum(n_passages)))
    out = np.zeros((ends[-1], FEATURES), np.float32)
    if not len(texts.hashes):
        return out, ends
    # The passage of every word.
    text_of = np.repeat(np.arange(len(n_words)), n_words)
    place = np.arange(len(text_of)) - texts.bounds[text_of]
    passage = ends[text_of] + place // PASSAGE
    used = np.flatnonzero(np.diff(passage, prepend=-1))
    rows = passage[used]
    count = np.diff(np.append(used, len(passage))).astype(np.float32)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values.astype(np.float32), used) / count

    starts, stops = texts.starts, texts.ends
    length = (stops - starts).astype(np.float32)
    kinds = []
    for kind in _KINDS:
        total = np.concatenate(([0], np.cumsum(kind[texts.data], dtype=np.int32)))
        kinds.append((total[stops] - total[starts]).astype(np.float32))
    letters, digits, upper, beyond = kinds
    marks = length - letters - digits
    order = np.lexsort((texts.hashes, passage))
    sorted_words, sorted_passages = texts.hashes[order], passage[order]
    fresh = np.ones(len(order), np.float32)
    fresh[1:] = (sorted_words[1:] != sorted_words[:-1]) | (sorted_passages[1:] != sorted_passages[:-1])
    again = np.zeros(len(passage), np.float32)
    again[1:] = (texts.hashes[1:] == texts.hashes[:-1]) & (passage[1:] == passage[:-1])
    total_length = np.maximum(mean(length), 1e-6)
    out[rows] = np.stack(
        [
            mean(fresh), mean(again), np.log1p(total_length), mean(length > 20),
            mean(marks) / total_length, mean(marks > 1), mean(marks > 2), mean(letters == 0),
            mean(digits) / total_length, mean(upper) / total_length, mean(beyond) / total_length,
            np.log1p(count),
        ],
        axis=1,
    )
    return out, ends


@dataclass
class AttentionModel:
    """Weights of the network, and the scale of its features. Without training, one score for all."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray] | None
    constant: float = 0.5

    def score(self, features: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(ends) - 1, self.constant)
        x = (features - self.mean) / self.scale
        return _forward(self.weights, x, ends)["score"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    starts, sizes = ends[:-1], np.diff(ends)
    bag = np.repeat(np.arange(len(starts)), sizes)
    hidden = np.tanh(x @ w["encode"] + w["encode0"])
    tanh, gate = np.tanh(hidden @ w["value"]), 1 / (1 + np.exp(-(hidden @ w["gate"])))
    energy = (tanh * gate) @ w["attend"]
    raised = np.exp(energy - np.maximum.reduceat(energy, starts)[bag])
    attention = raised / np.add.reduceat(raised, starts)[bag]
    pooled = np.add.reduceat(hidden * attention[:, None], starts, axis=0)
    logit = np.clip(pooled @ w["out"] + w["out0"], -30, 30)
    return {
        "bag": bag, "hidden": hidden, "tanh": tanh, "gate": gate, "attention": attention,
        "pooled": pooled, "score": 1 / (1 + np.exp(-logit)),
    }


def _gradients(
    w: dict[str, np.ndarray], x: np.ndarray, ends: np.ndarray, labels: np.ndarray
) -> dict[str, np.ndarray]:
    """Of the mean cross entropy."""
    f = _forward(w, x, ends)
    d_logit = (f["score"] - labels) / len(labels)
    d_pooled = np.outer(d_logit, w["out"])[f["bag"]]
    d_attention = (f["hidden"] * d_pooled).sum(axis=1)
    within = np.add.reduceat(f["attention"] * d_attention, ends[:-1])[f["bag"]]
    d_energy = f["attention"] * (d_attention - within)
    d_gated = np.outer(d_energy, w["attend"])
    d_tanh = d_gated * f["gate"] * (1 - f["tanh"] ** 2)
    d_gate = d_gated * f["tanh"] * f["gate"] * (1 - f["gate"])
    d_hidden = f["attention"][:, None] * d_pooled + d_tanh @ w["value"].T + d_gate @ w["gate"].T
    d_inner = d_hidden * (1 - f["hidden"] ** 2)
    return {
        "encode": x.T @ d_inner, "encode0": d_inner.sum(axis=0),
        "value": f["hidden"].T @ d_tanh, "gate": f["hidden"].T @ d_gate,
        "attend": (f["tanh"] * f["gate"]).T @ d_energy,
        "out": f["pooled"].T @ d_logit, "out0": d_logit.sum(),
    }


def train(
    features: np.ndarray, ends: np.ndarray, labels: np.ndarray, hidden: int = 16, steps: int = 300,
    rate: float = 0.03, decay: float = 1e-4, seed: int = 5,
) -> AttentionModel:
    """Full-batch gradient steps with adapted rates; the same input gives the same model."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = (features - mean) / scale
    draw = np.random.default_rng(seed)
    shapes = {
        "encode": (x.shape[1], hidden), "encode0": (hidden,), "value": (hidden, hidden),
        "gate": (hidden, hidden), "attend": (hidden,), "out": (hidden,), "out0": (),
    }
    w = {k: draw.standard_normal(s) / np.sqrt(s[0]) if s and k != "encode0" else np.zeros(s) for k, s in shapes.items()}
    first = {k: np.zeros(s) for k, s in shapes.items()}
    second = {k: np.zeros(s) for k, s in shapes.items()}
    for step in range(1, steps + 1):
        for k, g in _gradients(w, x, ends, labels).items():
            g = g + decay * w[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] = w[k] - rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return AttentionModel(mean, scale, w)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 3000,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> AttentionModel:
    """Learn from at most ``sample`` labelled rows, of the smallest hashes of their ids; whole texts.

    Labels that are null or have no document do not count; an equal label given again counts once, however often, and
    a document of two different labels counts for both. Of
    several documents with one id the text of the smallest hash counts for each of its labels.
    With one kind of label only there is nothing to learn, and the model gives the share of label 1
    (0.5 without any label).
    """
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("__id"), F.col(label_column).cast("double").alias("__label")
    )
    chosen = known.distinct().orderBy(F.xxhash64("__id"), "__label").limit(sample)
    # One row per sampled id, combined in each task before it is shuffled; then each of its labels.
    plain = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("text"))
    ids = chosen.select("__id").distinct()
    plain = plain.join(F.broadcast(ids), "__id")
    one = plain.groupBy("__id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    joined = one.join(F.broadcast(chosen), "__id")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                features, ends = passage_features(Texts(part.column("text"), SPACED))
                bags = [features[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_pydict(
                    {"id": part.column("__id"), "label": part.column("__label"), "bag": pa.array(bags, pa.binary())}
                )

    # Numbers of at most ``sample`` documents come to the driver, in an order that does not depend on tasks.
    rows = joined.mapInArrow(encode, "id long, label double, bag binary").toArrow()
    rows = rows.sort_by([("id", "ascending"), ("label", "ascending")]).to_pydict()
    target = np.array(rows["label"], float)
    if not len(target) or target.min() == target.max():
        constant = float(target[0]) if len(target) else 0.5
        return AttentionModel(np.zeros(FEATURES), np.ones(FEATURES), None, constant)
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in rows["bag"]]
    ends = np.concatenate(([0], np.cumsum([len(b) for b in bags])))
    return train(np.concatenate(bags).astype(float), ends, target)


def score_quality(docs: DataFrame, model: AttentionModel, text_column: str = "text") -> DataFrame:
    """Every row with ``score``, the chance that the document's label is 1.

    Null and empty texts are one passage without words and get the score of such. An input column
    called ``score`` is replaced; rows keep their number.
    """
    kept = others(docs, ["score"])
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("score", T.DoubleType())])

    texts, name = with_text(docs, kept, text_column)
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, name):
                scores = model.score(*passage_features(Texts(part.column(name), SPACED)))
                columns = [part.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=schema.names)

    return texts.mapInArrow(score, schema)
