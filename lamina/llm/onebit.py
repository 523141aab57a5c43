"""Nearest neighbours by randomly rotated one-bit codes, estimated with error bounds and reranked.

Every vector is moved to the centre of the data, scaled to length 1 and turned by one random rotation;
its code keeps the sign of each coordinate in a bit. With ``o`` the unit vector, ``x`` the vector of signs
over the square root of the dimension, and ``q`` the turned unit query, ``<x, q> / <x, o>`` estimates the
inner product ``<o, q>`` without bias, and its error stays below ``bound * sqrt((1 - <x, o>^2) / <x, o>^2 /
(D - 1))`` but with a chance that falls with ``exp(-bound^2)``. A vector is measured exactly only where the
distance at the lower end of its estimate could still be among the nearest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.runtime import materialize

_CODED = "id long, vector array<double>, code binary, length double, quality double"
_FOUND = "query_id long, vec_id long, score double"
_QUERY_BYTES = 1 << 19  # of the queries that one pass sends to all tasks
_ROWS = 4096


@dataclass(frozen=True)
class Rotation:
    """The centre and the rotation that codes of one table share."""

    centre: np.ndarray
    turn: np.ndarray

    @classmethod
    def random(cls, centre: np.ndarray, seed: int) -> Rotation:
        draws = np.random.default_rng(seed).standard_normal((len(centre), len(centre)))
        turn, upper = np.linalg.qr(draws)
        return cls(centre, turn * np.sign(np.diag(upper)))

    def turned(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Turned unit vectors from the centre, and the lengths they had; a vector at the centre stays 0."""
        moved = vectors - self.centre
        lengths = np.sqrt((moved * moved).sum(axis=1))
        return moved @ self.turn.T / np.where(lengths > 0, lengths, 1)[:, None], lengths


def encode(vectors: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, lengths, and the inner product of each unit vector with its code."""
    unit, lengths = rotation.turned(vectors)
    return np.packbits(unit > 0, axis=1), lengths, np.abs(unit).sum(axis=1) / np.sqrt(unit.shape[1])


def estimate(
    codes: np.ndarray, lengths: np.ndarray, quality: np.ndarray, queries: np.ndarray, rotation: Rotation, bound: float
) -> np.ndarray:
    """Lower bounds of the squared distances of queries (rows) to coded vectors (columns)."""
    unit, query_lengths = rotation.turned(queries)
    d = unit.shape[1]
    signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32)
    # <x, q> = (2 * sum of q where the bit is set - sum of q) / sqrt(D)
    inner = (2 * (unit.astype(np.float32) @ signs.T) - unit.sum(axis=1)[:, None]) / np.sqrt(d)
    safe = np.where(quality > 0, quality, 1)
    error = bound * np.sqrt(np.maximum(1 - safe**2, 0) / safe**2 / max(d - 1, 1))
    most = np.minimum(inner / safe + error, 1.0)
    low = query_lengths[:, None] ** 2 + lengths**2 - 2 * query_lengths[:, None] * lengths * most
    # Room for the rounding of the estimate itself.
    return np.maximum(low - 1e-5 * (query_lengths[:, None] + lengths) ** 2, 0)


def distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, added up in the order of the components."""
    if vectors.shape[1] == 0:
        return np.zeros(len(vectors))
    return np.sqrt(np.cumsum((vectors - query) ** 2, axis=1)[:, -1])


def coded_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", seed: int = 7
) -> tuple[DataFrame, Rotation | None]:
    """The written table of codes of every usable vector, and its rotation (None without vectors).

    Vectors that are null, all zero, or hold a null, infinite or not-a-number component take no
    part, and neither do those without an id or of another length than most (of several such lengths, the smallest).
    """
    wide = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = wide.where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0)
    )
    # One row for each length that occurs.
    lengths = usable.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return vectors.sparkSession.createDataFrame([], _CODED), None
    d = lengths[0].d
    usable = usable.where(F.size("vector") == d)
    centre = usable.agg(*[F.avg(F.col("vector")[i]).alias(f"c{i}") for i in range(d)]).first()
    rotation = Rotation.random(np.array(centre, float), seed)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                held = batch.column("vector")
                bits, sizes, quality = encode(held.flatten().to_numpy().reshape(-1, d), rotation)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column("id"),
                        "vector": held,
                        "code": pa.array([b.tobytes() for b in bits], pa.binary()),
                        "length": sizes,
                        "quality": quality,
                    }
                )

    return materialize(usable.mapInArrow(code, _CODED), "onebit-codes"), rotation


def nearest(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    bound: float = 4.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest other rows of each row whose id is divisible by ``every``.

    Nearest first by Euclidean distance, ties to the smaller id. Rows that cannot take part (see
    ``coded_vectors``) are neither queries nor found; with fewer others, all are returned; an empty
    table gives no rows. A query does not find rows of its own id; queries of one id share their ``k`` rows.

    The queries go to all tasks in blocks of a fixed number of bytes, one pass over the codes each.
    A task keeps ``k`` rows per query; the result is the best of those.
    """
    spark = vectors.sparkSession
    coded, rotation = coded_vectors(vectors, id_column, vector_column, seed)
    found = spark.createDataFrame([], _FOUND)
    if rotation is not None:
        queries = coded.where(F.col("id") % every == 0).select("id", "vector").distinct()
        size = 8 * (len(rotation.centre) + 1)
        blocks = max(1, -(-queries.count() * size // _QUERY_BYTES))
        block = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks))
        passes = []
        for number in range(blocks):
            own = queries.where(block == number).toArrow()
            if own.num_rows:
                ids = own.column("id").to_numpy()
                wanted = own.column("vector").combine_chunks().flatten().to_numpy()
                search = _searcher(ids, wanted.reshape(len(ids), -1), rotation, k, bound)
                passes.append(coded.mapInArrow(search, T._parse_datatype_string(_FOUND)))
        for one in passes:
            found = found.unionByName(one)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _searcher(ids: np.ndarray, queries: np.ndarray, rotation: Rotation, k: int, bound: float):
    d = queries.shape[1]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The k nearest so far of every query.
        best_score = np.full((len(ids), k), np.inf)
        best_id = np.full((len(ids), k), np.iinfo(np.int64).max)
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                own = part.column("id").to_numpy()
                vectors = part.column("vector").flatten().to_numpy().reshape(-1, d)
                codes = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8)
                low = estimate(
                    codes.reshape(len(own), -1),
                    part.column("length").to_numpy(),
                    part.column("quality").to_numpy(),
                    queries, rotation, bound,
                )
                for q in range(len(ids)):
                    _rerank(q, ids, queries, own, vectors, low[q], best_score, best_id, k)
        rows, ranks = np.nonzero(np.isfinite(best_score))
        yield pa.RecordBatch.from_pydict(
            {"query_id": ids[rows], "vec_id": best_id[rows, ranks], "score": best_score[rows, ranks]}
        )

    return search


def _rerank(
    q: int, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, low: np.ndarray,
    best_score: np.ndarray, best_id: np.ndarray, k: int,
) -> None:
    """Measure what may be among the ``k`` nearest, most promising first, and keep the best."""
    chosen = np.flatnonzero((low <= best_score[q, -1] ** 2) & (own != ids[q]))
    step = 4 * k
    if len(chosen) > step:
        chosen = chosen[np.argsort(low[chosen], kind="stable")]
    first = 0
    while first < len(chosen):
        some = chosen[first : first + step]
        if first and low[some[0]] > best_score[q, -1] ** 2:
            break
        scores = np.concatenate((best_score[q], distances(queries[q], vectors[some])))
        found = np.concatenate((best_id[q], own[some]))
        order = np.lexsort((found, scores))[:k]
        best_score[q], best_id[q] = scores[order], found[order]
        first, step = first + step, 2 * step
