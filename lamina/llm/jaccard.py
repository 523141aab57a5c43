"""Documents linked by the Jaccard similarity of their word n-grams, as components; no link is lost.

The similarity join is a sparse matrix product of the document by n-gram incidence with itself, done
in blocks of rows that can have links at all:

1. Each document becomes its set of n-gram hashes. Documents with equal sets are one row of the matrix.
2. Two sets of similarity ``t`` differ in at most ``k = (a + b) (1 - t) / (1 + t)`` elements, ``a`` and
   ``b`` being their sizes. Cutting the hash space into ``m > k`` segments leaves at least ``m - k`` of
   them equal in both sets. Rows that share no segment of a band of sizes are never compared, and
   the rows that do, directly or over others, are gathered by connected components.
   Below a similarity of 0.87 segments would be too short to say anything. There a set of ``a`` elements
   names the first ``a - ceil(t a) + l`` of them in an order common to all sets; the first ``l`` elements that two
   linked sets share are among those of both. The order of hashes with ``l = a / 16`` leaves out the sets that
   share a passage only, and of the others the order by rarity leaves out all elements that no second set has.
3. A gathered group is cut into blocks by size band and hash, and pairs of blocks whose sizes allow a
   link are multiplied, panel by panel of n-grams. Pairs whose overlap so far plus what is left
   cannot reach the bound of their sizes are discarded, and a product stops when none is alive.
4. Each product gives one row per matrix row, its links as a spanning forest, never as pairs;
   components of the forests are the answer.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.components import connected_components
from lamina.llm.words import SPACED, Texts, mix, slices
from lamina.runtime import materialize

_FACTORS = tuple(np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
_SEGMENT, _NODE = np.uint64(0x589965CC75374CC3), np.uint64(0x1D8E4E27C47D124F)
_BLOCK = 256  # rows of a block of the product
_PANEL = 4096  # n-grams multiplied at once
_TOGETHER = 512  # rows of small groups that one call multiplies, group by group
_WEAK = 3  # segments of fewer elements say little
_BROADCAST_BYTES = 32 << 20
_SEGMENTS_FROM = 87  # per cent of similarity from which segments hold about six elements or more
_MET = 16  # a set must share one in so many of its elements among the first of them
_CELLS = 1 << 18  # elements of sets in one batch, about


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of all runs of ``n`` words, sorted; of a shorter text the whole run is the one."""
    if not len(words):
        return words
    size = min(n, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        total = mix(total * _FACTORS[1] + words[i : len(words) - size + 1 + i] * _FACTORS[0])
    return np.unique(total)


class Bands:
    """Size bands for similarities of ``num`` / ``den``: linked sets are in the same or the next one."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.first = [1]

    def _reach(self, size: int) -> None:
        while self.first[-1] <= size:
            self.first.append(self.first[-1] * self.den // self.num + 1)

    def band(self, size: int) -> int:
        self._reach(size)
        return bisect_right(self.first, size) - 1

    def differing(self, band: int) -> int:
        """The most elements in which two linked sets differ, the smaller one being of this band."""
        self._reach(self.first[band])
        largest = self.first[band + 1] - 1
        both = largest + largest * self.den // self.num
        return both * (self.den - self.num) // (self.den + self.num)

    def linked(self, a: np.ndarray, b: np.ndarray, overlap: np.ndarray) -> np.ndarray:
        # Counts come as float32; their products with the bound are exact as integers only.
        return (self.den + self.num) * overlap.astype(np.int64) >= self.num * (a + b)


@lru_cache(maxsize=4096)
def _edges(m: int) -> np.ndarray:
    return np.array([(j << 64) // m for j in range(1, m)], np.uint64)


def signatures(hashes: np.ndarray, bands: Bands) -> np.ndarray:
    """Hashes of the segments that a linked set must share one of.

    A set takes part in its own band and, as the larger one, in the band before. Segments of fewer
    than three elements are left out unless a set has so many that all equal segments might be such;
    they are the same in both sets, so both sets decide alike.
    """
    own = bands.band(len(hashes))
    out = []
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ _SEGMENT))))
    for band in (own, own - 1):
        k = bands.differing(band) if band >= 0 else 0
        if k == 0:  # linked sets are equal there
            continue
        spare = 1 + k // 8
        m = k + spare
        at = np.concatenate(([0], np.searchsorted(hashes, _edges(m)), [len(hashes)]))
        counts = np.diff(at)
        named = mix(np.arange(m, dtype=np.uint64) + np.uint64(band << 32)) + counts.astype(np.uint64)
        values = mix((sums[at[1:]] - sums[at[:-1]]) ^ named)
        strong = counts >= _WEAK
        out.append(values if m - int(strong.sum()) >= spare else values[strong])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def by_prefix(bands: Bands) -> bool:
    return 100 * bands.num < _SEGMENTS_FROM * bands.den


def prefix_length(size: int, bands: Bands) -> int:
    """Of how many first elements, in any one order, two linked sets share ``met_at_least`` of both their sizes."""
    return size - -(-bands.num * size // bands.den) + max(1, size // _MET)


def met_at_least(size: str, bands: Bands) -> F.Column:
    """How many of its first elements a set of some size shares with a linked one, which may be smaller."""
    smallest = F.expr(f"({size} * {bands.num} + {bands.den - 1}) div {bands.den}")
    return F.greatest(F.lit(1), F.floor(smallest / _MET)).cast("long")


def jaccard_components(
    docs: DataFrame,
    n: int = 3,
    num: int = 90,
    den: int = 100,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id`` and ``n_links``.

    Words are lower-cased (A-Z) runs of characters other than ASCII white space. Two documents link
    when ``den`` times the overlap of their n-gram sets is at least ``num`` times the union.
    ``component_id`` is the smallest id reachable by links, the own one included; ``n_links`` counts
    the documents a document links with, its copies among them. Null and empty texts have no n-grams,
    no links and their own id. Rows with the same id are documents of their own; a null id never is
    the smallest unless there is no other. An empty table gives no rows; other columns are not read.
    """
    bands = Bands(num, den)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    rows = materialize(texts.mapInArrow(_signer(n, num, den), _SIGNED), "jaccard-sets")
    with_words = rows.where("n_shingles > 0")
    classes = materialize(
        with_words.groupBy("node").agg(
            F.min("row").alias("row"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")
        ),
        "jaccard-classes",
    )
    signed = with_words.where(F.size("signatures") > 0).join(
        classes.select("row"), "row", "left_semi"
    )
    cells = signed.select("node", F.explode("signatures").alias("segment"))
    if by_prefix(bands):
        cells = _rarest(texts, signed, cells, n, bands)
    shared = cells.groupBy("segment").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    shared = shared.where("least != most").select("segment", "least")
    stars = cells.join(shared, "segment").where("node != least").select("node", "least").distinct()
    groups = materialize(connected_components(stars, "node", "least"), "jaccard-groups")

    products = _products(texts, rows, classes, groups, n, bands)
    forest = products.where("node != parent").select("node", "parent")
    roots = connected_components(forest, "node", "parent")
    links = products.groupBy("node").agg(F.sum("n_links").alias("others"))
    placed = classes.join(roots, "node", "left").join(links, "node", "left").select(
        "node",
        "least",
        F.coalesce("root", "node").alias("root"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
    )
    placed = materialize(placed, "jaccard-placed")
    component = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(component, "root").select("node", "component_id", "n_links")
    columns = ["doc_id", "n_shingles", "component_id", "n_links"]
    linked = with_words.select("doc_id", "n_shingles", "node").join(placed, "node").select(*columns)
    alone = rows.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")
    )
    return linked.unionByName(alone)


_SIGNED = "doc_id long, row long, n_shingles long, node long, signatures array<long>"


def _node(hashes: np.ndarray) -> int:
    """Name of a set: a hash of it, as a signed 64-bit integer."""
    with np.errstate(over="ignore"):
        total = mix(hashes ^ _NODE).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _signer(n: int, num: int, den: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Texts(part.column("text"), SPACED)
                sizes, nodes, signed = [], [], []
                for i in range(len(texts)):
                    hashes = shingles(texts.words(i), n)
                    sizes.append(len(hashes))
                    nodes.append(_node(hashes) if len(hashes) else None)
                    first = hashes[: prefix_length(len(hashes), bands)] if by_prefix(bands) else None
                    signed.append(hashes if not len(hashes) else signatures(hashes, bands) if first is None else first)
                ends = np.concatenate(([0], np.cumsum([len(s) for s in signed]))).astype(np.int32)
                flat = np.concatenate(signed).view(np.int64) if signed else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "row": np.arange(row, row + len(texts)),
                        "n_shingles": pa.array(sizes, pa.int64()),
                        "node": pa.array(nodes, pa.int64()),
                        "signatures": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    }
                )
                row += len(texts)

    return sign


def _sets(texts: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """``node`` and ``grams`` of the rows that have the ids of ``members``, read from their texts again."""
    wanted = members.select("doc_id").distinct()
    if members.count() * 16 <= _BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")
    sets = found.mapInArrow(_set_maker(n), "node long, grams binary")
    # Copies have the same set; one of each class in a task goes on.
    return sets.groupBy("node").agg(F.first("grams").alias("grams"))


def _rarest(texts: DataFrame, signed: DataFrame, cells: DataFrame, n: int, bands: Bands) -> DataFrame:
    """``node`` and ``segment``: the first elements of the sets that may have links, the rarest first.

    ``cells`` are the first elements by hash. A set that shares too few of these with others has no links.
    Elements that one set alone has come first and are not returned, as they meet nothing.
    """
    met = cells.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("segment")
    nodes = cells.join(met, "segment", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("n_met"))
    chosen = signed.select("node", "doc_id", "n_shingles").join(nodes, "node")
    chosen = chosen.where(F.col("n_met") >= met_at_least("n_shingles", bands)).select("node", "doc_id")
    chosen = materialize(chosen, "jaccard-candidates")
    sets = _sets(texts, chosen, n).join(chosen.select("node"), "node", "left_semi")
    sets = materialize(sets, "jaccard-candidate-sets")
    elements = sets.mapInArrow(_elements, "node long, segment long")
    counts = elements.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # At most the elements of one set are collected.
    common = elements.join(counts, "segment").groupBy("node").agg(
        F.collect_list(F.struct("n", "segment")).alias("common")
    )
    size = (F.octet_length("grams") / 8).cast("long")
    common = common.join(sets.select("node", size.alias("size")), "node")
    least = F.expr(f"(size * {bands.num} + {bands.den - 1}) div {bands.den}")
    # By rarity one shared element will do: the first size - least + 1. The elements of this set alone are
    # size - size(common); what is left of those first ones is common.
    rest = F.greatest(F.size("common") - least + 1, F.lit(0)).cast("int")
    first = common.select("node", F.slice(F.array_sort("common"), F.lit(1), rest).alias("first"))
    return materialize(first.select("node", F.explode("first.segment").alias("segment")), "jaccard-rarest")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each element of a set."""
    for batch in batches:
        nodes, held, size = [], [], 0
        for node, grams in zip(batch.column("node").to_pylist(), batch.column("grams")):
            grams = np.frombuffer(grams.as_buffer(), np.int64)
            nodes.append(np.full(len(grams), node, np.int64))
            held.append(grams)
            size += len(grams)
            if size >= _CELLS:
                yield pa.RecordBatch.from_arrays([np.concatenate(nodes), np.concatenate(held)], names=["node", "segment"])
                nodes, held, size = [], [], 0
        if size:
            yield pa.RecordBatch.from_arrays([np.concatenate(nodes), np.concatenate(held)], names=["node", "segment"])


def _products(
    texts: DataFrame, rows: DataFrame, classes: DataFrame, groups: DataFrame, n: int, bands: Bands
) -> DataFrame:
    """One row per matrix row and pair of blocks it takes part in: node, parent, n_links."""
    num, den = bands.num, bands.den
    # The band of a size, in SQL: the bands of all sizes that there are, as one literal.
    largest = rows.agg(F.max("n_shingles")).first()[0] or 1
    bands.band(largest)
    band = F.size(F.filter(F.array(*map(F.lit, bands.first)), lambda x: x <= F.col("n_shingles"))) - 1

    members = groups.join(classes, "node").select("node", "root", "row", "copies")
    members = members.join(rows.select("row", "doc_id", "n_shingles"), "row")
    members = materialize(
        members.select("node", "root", "doc_id", "copies", "n_shingles", band.alias("band")),
        "jaccard-members",
    )
    counted = members.groupBy("root", "band").agg(F.count(F.lit(1)).alias("rows"))
    counted = counted.withColumn("blocks", F.ceil(F.col("rows") / _BLOCK).cast("long"))
    # Small groups are one block whatever their sizes; the product itself tells who can link.
    totals = counted.groupBy("root").agg(F.sum("rows").alias("group_rows"))
    small = members.join(totals.where(F.col("group_rows") <= _BLOCK), "root")
    n_small = totals.where(F.col("group_rows") <= _BLOCK).agg(F.sum("group_rows")).first()[0] or 0
    bins = max(1, n_small // _TOGETHER)
    plain = ["node", "root", "doc_id", "copies", "n_shingles"]
    small = small.select(
        *plain, F.pmod(F.xxhash64("root"), F.lit(bins)).alias("bin"),
        F.lit(0).cast("long").alias("side"), F.lit(False).alias("crossed"),
    )
    # Large ones: a row goes to every pair of its block with a block of its own band or the next.
    large = members.join(totals.where(F.col("group_rows") > _BLOCK).select("root"), "root", "left_semi")
    own = large.join(counted.select("root", "band", "blocks"), ["root", "band"], "left")
    around = counted.select("root", F.col("band").alias("b"), F.col("blocks").alias("n"))
    for name, step in (("above", 1), ("below", -1)):
        beside = around.select("root", (F.col("b") - step).alias("band"), F.col("n").alias(name))
        own = own.join(beside, ["root", "band"], "left")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))

    def others(count: str, band_step: int) -> F.Column:
        each = F.sequence(F.lit(0).cast("long"), F.col(count) - 1)
        return F.when(
            F.col(count) > 0,
            F.transform(each, lambda j: F.struct((F.col("band") + band_step).alias("band"), j.alias("block"))),
        ).otherwise(F.array().cast("array<struct<band:int,block:bigint>>"))

    mine = F.struct("band", F.col("block").alias("block"))
    own = own.withColumn("block", block)
    own = own.withColumn(
        "other", F.explode(F.concat(others("blocks", 0), others("above", 1), others("below", -1)))
    )
    first, second = F.least(mine, F.col("other")), F.greatest(mine, F.col("other"))
    large = own.select(
        *plain, F.xxhash64("root", first, second).alias("bin"),
        (mine == second).cast("long").alias("side"), (first != second).alias("crossed"),
    )
    work = small.unionByName(large)

    # The sets again, from the texts of these rows only.
    sets = _sets(texts, members, n)
    work = work.join(sets, "node").select("bin", "root", "node", "copies", "side", "crossed", "grams")
    return materialize(work.groupBy("bin").applyInArrow(_multiplier(num, den), _LINKED), "jaccard-links")


_LINKED = "node long, parent long, n_links long"


def _set_maker(n: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Texts(part.column("text"), SPACED)
                sets = [shingles(texts.words(i), n) for i in range(len(texts))]
                sets = {_node(s): s.tobytes() for s in sets if len(s)}
                yield pa.RecordBatch.from_pydict(
                    {"node": pa.array(sets.keys(), pa.int64()), "grams": pa.array(sets.values(), pa.binary())}
                )

    return make


def _multiplier(num: int, den: int):
    def multiply(table: pa.Table) -> pa.Table:
        bands = Bands(num, den)
        roots = table.column("root").to_numpy()
        order = np.argsort(roots, kind="stable")
        cuts = np.flatnonzero(np.diff(roots[order])) + 1
        table = table.take(pa.array(order))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for first, last in zip([0, *cuts], [*cuts, len(order)]):
            part = table.slice(int(first), int(last - first))
            nodes = part.column("node").to_numpy()
            copies = part.column("copies").to_numpy()
            sets = [np.frombuffer(g, np.uint64) for g in part.column("grams").to_pylist()]
            side = part.column("side").to_numpy() if part.column("crossed")[0].as_py() else None
            linked = linked_rows(sets, bands, side)
            out.append((nodes, nodes[_parents(linked)], linked @ copies))
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
        return pa.table(dict(zip(("node", "parent", "n_links"), columns)))

    return multiply


def linked_rows(sets: list[np.ndarray], bands: Bands, side: np.ndarray | None = None) -> np.ndarray:
    """Which rows link: the overlap counts of the incidence matrix with its transpose, panel by panel.

    With ``side``, only pairs of rows from both sides are asked for.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    a, b = sizes[:, None], sizes[None, :]
    alive = bands.num * np.maximum(a, b) <= bands.den * np.minimum(a, b)
    np.fill_diagonal(alive, False)
    if side is not None:
        alive &= side[:, None] != side[None, :]
    grams, columns, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(sets)), sizes)
    # N-grams of one row overlap with nothing; they only take from what is left to overlap.
    common = counts > 1
    rows, columns = rows[common[columns]], (np.cumsum(common) - 1)[columns[common[columns]]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    left = np.bincount(rows, minlength=len(sets))
    overlap = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(common.sum()), _PANEL):
        reach = overlap + np.minimum(left[:, None], left[None, :])
        alive &= bands.linked(a, b, reach)
        if not alive.any():
            return alive
        x, y = np.searchsorted(columns, (first, first + _PANEL))
        panel = np.zeros((len(sets), min(_PANEL, int(common.sum()) - first)), np.float32)
        panel[rows[x:y], columns[x:y] - first] = 1
        overlap += panel @ panel.T
        left -= np.bincount(rows[x:y], minlength=len(sets))
    return alive & bands.linked(a, b, overlap)


def _parents(linked: np.ndarray) -> np.ndarray:
    """For each row, the first row of its component."""
    parent = np.arange(len(linked))
    seen = np.zeros(len(linked), bool)
    for start in range(len(linked)):
        if seen[start]:
            continue
        todo = [start]
        seen[start] = True
        while todo:
            fresh = np.flatnonzero(linked[todo.pop()] & ~seen)
            seen[fresh] = True
            parent[fresh] = start
            todo.extend(fresh.tolist())
    return parent
