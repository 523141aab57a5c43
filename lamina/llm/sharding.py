"""Contiguous shards whose largest is as small as it can be, with groups kept whole.

Rows with the same text form one atomic group; groups are ordered by the digest of their text. The
smallest capacity for which the groups fit into the shards in that order is found by binary search,
each candidate checked greedily, and the order is cut there. The search runs on the driver over the
total sizes of at most 2**20 ranges of digests; single groups are fetched only for the ranges in which
a cut can fall, so what reaches the driver does not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.runtime import materialize

_KEY, _SIZE, _ROW, _PART = "__shard_key", "__shard_size", "__shard_row", "__shard_part"
_DIGITS = 5  # leading hexadecimal digits of a digest that can name its range
_MOST_BITS = 4 * _DIGITS


def minimax_shards(
    docs: DataFrame,
    n_shards: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
    columns: list[str] | None = None,
) -> DataFrame:
    """Every row with ``size`` (bytes of its text plus 1), ``shard`` and ``slot``.

    ``slot`` numbers the rows of a shard from 0 without gaps, by text digest, then id (nulls first).
    Rows of the same text are never parted; null texts are a group of their own, with size 1. No
    contiguous placement has a smaller largest shard; within that limit each cut is put where it
    evens out what is left. With fewer groups than shards some shards stay empty, an empty table
    gives an empty result, and repeated rows keep a slot each. ``columns`` are the input columns to
    keep, all by default; those called size, shard or slot are replaced.
    """
    names = [c for c in (columns or docs.columns) if c.lower() not in ("size", "shard", "slot")]
    kept = [f"`{c}`" for c in names]
    size = F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long") + 1
    rows = docs.withColumns({_KEY: F.coalesce(F.md5(text_column), F.lit("")), _SIZE: size})
    groups = materialize(rows.groupBy(_KEY).agg(F.sum(_SIZE).alias(_SIZE)), "shard-groups")
    starts = _start_keys(groups, n_shards)

    # Ranges of digest and id: a text with very many copies is spread over several tasks.
    order = [F.col(_KEY), F.col(id_column).asc_nulls_first()]
    light = rows.select(*kept, *({id_column} - set(names)), _KEY, _SIZE)
    ranked = light.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    ranked = ranked.select(
        *kept,
        F.col(_SIZE).alias("size"),
        _shard_of(starts).alias("shard"),
        F.shiftright(place, 33).cast("int").alias(_PART),
        place.bitwiseAND(F.lit((1 << 33) - 1)).alias(_ROW),
    )
    ranked = materialize(ranked, "shard-rows")

    # One number per task and shard: rows of the shard in earlier tasks. Within a task the rows of a
    # shard are neighbours, so the first one's number is what to subtract.
    counted = sorted(
        ranked.groupBy(_PART, "shard").agg(F.count(F.lit(1)).alias("n"), F.min(_ROW).alias("first")).collect()
    )
    before: dict[int, int] = {}
    shift = []
    for part, shard, n, first in counted:
        shift.append((part, shard, before.get(shard, 0) - first))
        before[shard] = before.get(shard, 0) + n
    offsets = docs.sparkSession.createDataFrame(shift, f"{_PART} int, shard int, __shift long")
    return ranked.join(F.broadcast(offsets), [_PART, "shard"]).select(
        *kept, "size", "shard", (F.col(_ROW) + F.col("__shift")).alias("slot")
    )


def _shard_of(starts: list[str]) -> Column:
    """Shard of a digest: the number of later shards that begin at or before it."""
    shard = F.lit(0)
    for start in starts:
        shard = shard + (F.col(_KEY) >= F.lit(start)).cast("int")
    return shard


def _start_keys(groups: DataFrame, n_shards: int) -> list[str]:
    """Digest at which each shard but the first begins, in ascending order."""
    n_groups = groups.count()
    bits = min(_MOST_BITS, max(0, (n_groups // 16).bit_length()))
    digits = F.when(F.col(_KEY) == "", F.lit("0")).otherwise(F.substring(_KEY, 1, _DIGITS))
    span = F.shiftright(F.conv(digits, 16, 10).cast("long"), _MOST_BITS - bits)
    ranged = groups.withColumn("span", span)
    # At most 2**20 rows of three numbers.
    totals = (
        ranged.groupBy("span").agg(F.sum(_SIZE).alias("total"), F.max(_SIZE).alias("most")).toArrow()
    )
    by_span = np.argsort(totals["span"].to_numpy())
    spans = totals["span"].to_numpy()[by_span]
    ends = np.cumsum(totals["total"].to_numpy()[by_span])
    if not len(spans):
        return []

    def fetch(wanted: list[int]) -> dict[int, tuple[np.ndarray, list[str]]]:
        found = ranged.where(F.col("span").isin([int(spans[i]) for i in wanted])).toArrow().to_pydict()
        per: dict[int, list[tuple[str, int]]] = {int(spans[i]): [] for i in wanted}
        for span_, key, size in zip(found["span"], found[_KEY], found[_SIZE]):
            per[span_].append((key, size))
        return {i: _cumulated(per[int(spans[i])], int(ends[i - 1]) if i else 0) for i in wanted}

    edges = Edges(ends, fetch)
    cuts = minimax_cuts(edges, n_shards, int(totals["most"].to_numpy().max()))
    return [edges.key_after(cut) for cut in cuts if cut < edges.total]


def _cumulated(groups: list[tuple[str, int]], before: int) -> tuple[np.ndarray, list[str]]:
    groups.sort()
    return before + np.cumsum([size for _, size in groups]), [key for key, _ in groups]


class Edges:
    """Positions, in bytes of the ordered groups, where one group ends and the next begins."""

    def __init__(self, ends: np.ndarray, fetch: Callable[[list[int]], dict]):
        self.ends = ends
        self.total = int(ends[-1])
        self._fetch = fetch
        self._known: dict[int, tuple[np.ndarray, list[str]]] = {}

    def prefetch(self, first: int, last: int) -> list[int]:
        """Ranges with an edge between two positions that are not known yet."""
        a = int(np.searchsorted(self.ends, min(max(first, 0), self.total)))
        b = int(np.searchsorted(self.ends, min(max(last, 0), self.total)))
        return [i for i in range(a, b + 1) if i not in self._known]

    def load(self, ranges: list[int]) -> None:
        wanted = sorted(set(ranges))
        if wanted:
            self._known.update(self._fetch(wanted))

    def _range(self, position: int) -> tuple[int, np.ndarray, list[str]]:
        i = int(np.searchsorted(self.ends, position))
        if i not in self._known:
            self.load([i])
        return (i, *self._known[i])

    def floor(self, position: int) -> int:
        """The last edge at or before a position."""
        if position >= self.total:
            return self.total
        if position <= 0:
            return 0
        i, inner, _ = self._range(position)
        k = int(np.searchsorted(inner, position, side="right"))
        return int(inner[k - 1]) if k else int(self.ends[i - 1]) if i else 0

    def ceil(self, position: int) -> int:
        """The first edge at or after a position."""
        if position >= self.total:
            return self.total
        if position <= 0:
            return 0
        _, inner, _ = self._range(position)
        return int(inner[np.searchsorted(inner, position)])

    def key_after(self, edge: int) -> str:
        """Key of the group that begins at an edge."""
        _, inner, keys = self._range(edge + 1)
        return keys[int(np.searchsorted(inner, edge + 1))]


def minimax_cuts(edges: Edges, n_shards: int, largest: int) -> list[int]:
    """The ends of all shards but the last, at the smallest capacity that is feasible."""
    total = edges.total
    low = max(-(-total // n_shards), largest)
    high = low + largest  # shards filled beyond total / n_shards each: always feasible
    low, high = _narrowed(edges.ends, n_shards, low, high)
    # Cuts of every capacity left lie between these positions; their ranges come in one job.
    wanted = []
    for first, last in zip(_coarse(edges.ends, n_shards, low, up=False), _coarse(edges.ends, n_shards, high, up=True)):
        wanted += edges.prefetch(first, last)
    edges.load(wanted)
    while low < high:
        middle = (low + high) // 2
        at = 0
        for _ in range(n_shards):
            at = edges.floor(at + middle)
        low, high = (low, middle) if at >= total else (middle + 1, high)
    # Positions before which a cut leaves too much for the shards behind it.
    least = [total]
    for _ in range(n_shards - 1):
        least.append(edges.ceil(least[-1] - low))
    least.reverse()
    cuts, at = [], 0
    for shard in range(n_shards - 1):
        even = at + (total - at) // (n_shards - shard)
        below, above = edges.floor(even), edges.ceil(even)
        best = below if even - below <= above - even else above
        at = min(max(best, least[shard]), edges.floor(at + low))
        cuts.append(at)
    return cuts


def _coarse(ends: np.ndarray, n_shards: int, capacity: int, up: bool) -> list[int]:
    """Greedy cuts at ends of ranges: no later (``up`` False) or no earlier than those of the groups."""
    at, cuts = 0, []
    for _ in range(n_shards):
        if up:
            i = min(int(np.searchsorted(ends, at + capacity)), len(ends) - 1)
            at = int(ends[i])
        else:
            i = int(np.searchsorted(ends, at + capacity, side="right"))
            at = int(ends[i - 1]) if i else 0
        cuts.append(at)
    return cuts


def _narrowed(ends: np.ndarray, n_shards: int, low: int, high: int) -> tuple[int, int]:
    """Capacities between which the answer lies, as far as the totals of the ranges can tell."""
    total = int(ends[-1])
    a, b = low, high
    while a < b:  # feasible even if every cut moves back to the end of a range
        middle = (a + b) // 2
        a, b = (a, middle) if _coarse(ends, n_shards, middle, up=False)[-1] >= total else (middle + 1, b)
    most = b
    a, b = low, most
    while a < b:  # infeasible even if every cut moves on to the end of its range
        middle = (a + b) // 2
        a, b = (a, middle) if _coarse(ends, n_shards, middle, up=True)[-1] >= total else (middle + 1, b)
    return a, most
