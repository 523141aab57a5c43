"""Token ids in binary files: every id in the fewest bits the vocabulary needs.

A file holds the documents of one id range, one after the other, as blocks of a fixed number of ids:

    header   magic, bits per id, ids per block
    blocks   bit-packed ids, lowest bit first, each block padded to whole bytes
    footer   uint64 offset of every block and of their end, uint64 end of every document in ids,
             int64 document ids, one byte per document that is 1 where the id is null
    trailer  number of blocks, documents and ids, offset of the footer, magic

Any range of ids is read by the offsets of its first and last block and unpacked with numpy.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.llm.encoder import TOGETHER, shared_encoder
from lamina.llm.files import Input, Output
from lamina.llm.words import slices

MAGIC = b"LFWB"
_HEADER = struct.Struct("<4sII")
_TRAILER = struct.Struct("<QQQQ4s")
_MANIFEST = "file string, part int, n_docs long, n_tokens long"
_ROWS = 4096


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive fields of ``bits`` bits, lowest bit first; eight ids fill ``bits`` bytes."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    n = len(ids)
    rows = np.zeros((-(-n // 8), 8), np.uint64)
    rows.reshape(-1)[:n] = ids
    out = np.zeros((len(rows), bits), np.uint8)
    for i in range(8):
        first = i * bits
        for byte in range(first // 8, (first + bits - 1) // 8 + 1):
            shift = byte * 8 - first
            field = rows[:, i] >> np.uint64(shift) if shift >= 0 else rows[:, i] << np.uint64(-shift)
            out[:, byte] |= (field & np.uint64(255)).astype(np.uint8)
    return out.reshape(-1)[: -(-n * bits // 8)].tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed data, as unsigned 32-bit integers."""
    if bits == 16:
        return np.frombuffer(data, "<u2", n).astype(np.uint32)
    groups = -(-n // 8)
    raw = np.zeros(groups * bits, np.uint8)
    held = np.frombuffer(data, np.uint8)[: groups * bits]
    raw[: len(held)] = held
    raw = raw.reshape(groups, bits).astype(np.uint64)
    out = np.zeros((groups, 8), np.uint64)
    for i in range(8):
        first = i * bits
        for byte in range(first // 8, (first + bits - 1) // 8 + 1):
            shift = byte * 8 - first
            out[:, i] |= raw[:, byte] << np.uint64(shift) if shift >= 0 else raw[:, byte] >> np.uint64(-shift)
    out &= np.uint64((1 << bits) - 1)
    return out.reshape(-1)[:n].astype(np.uint32)


class TokenWriter:
    """Appends documents to one file; holds one block of ids and the footer's numbers in memory."""

    def __init__(self, folder: str, prefix: str, bits: int, block_ids: int):
        if block_ids % 8:
            raise ValueError("a block holds a multiple of eight ids")
        self._out = Output(folder, prefix, ".tokens")
        self._bits, self._block = bits, block_ids
        self._out.write(_HEADER.pack(MAGIC, bits, block_ids))
        self._offsets: list[int] = []
        self._held: list[np.ndarray] = []
        self._n_held = 0
        self.n_tokens = 0
        self._ends: list[int] = []
        self._doc_ids: list[int | None] = []

    @property
    def name(self) -> str:
        return self._out.name

    @property
    def n_docs(self) -> int:
        return len(self._ends)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self._bits:
            raise ValueError(f"id {int(ids.max())} needs more than {self._bits} bits")
        self.n_tokens += len(ids)
        self._ends.append(self.n_tokens)
        self._doc_ids.append(doc_id)
        self._held.append(ids)
        self._n_held += len(ids)
        if self._n_held >= self._block:
            held = np.concatenate(self._held)
            whole = len(held) // self._block * self._block
            for first in range(0, whole, self._block):
                self._flush(held[first : first + self._block])
            self._held, self._n_held = [held[whole:].copy()], len(held) - whole

    def _flush(self, ids: np.ndarray) -> None:
        self._offsets.append(self._out.size)
        self._out.write(pack(ids, self._bits))

    def close(self) -> None:
        if self._n_held:
            self._flush(np.concatenate(self._held))
        footer = self._out.size
        self._out.write(np.array([*self._offsets, footer], "<u8").tobytes())
        self._out.write(np.array(self._ends, "<u8").tobytes())
        self._out.write(np.array([d or 0 for d in self._doc_ids], "<i8").tobytes())
        self._out.write(np.array([d is None for d in self._doc_ids], np.uint8).tobytes())
        counts = (len(self._offsets), len(self._ends), self.n_tokens, footer)
        self._out.write(_TRAILER.pack(*counts, MAGIC))
        self._out.close()


class TokenFile:
    """Random access to a file of ``TokenWriter``."""

    def __init__(self, folder: str, name: str):
        self._file = Input(folder, name)
        magic, self.bits, self.block_ids = _HEADER.unpack(self._file.read(0, _HEADER.size))
        tail = self._file.read(self._file.size - _TRAILER.size, _TRAILER.size)
        n_blocks, n_docs, self.n_tokens, footer, end = _TRAILER.unpack(tail)
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"{name} is not a whole token file")
        raw = self._file.read(footer, self._file.size - _TRAILER.size - footer)
        parts = np.frombuffer(raw[: 8 * (n_blocks + 1 + 2 * n_docs)], "<u8")
        self._offsets = parts[: n_blocks + 1]
        self.doc_ends = parts[n_blocks + 1 : n_blocks + 1 + n_docs].astype(np.int64)
        null = np.frombuffer(raw[len(raw) - n_docs :], np.uint8) if n_docs else np.zeros(0, np.uint8)
        ids = parts[n_blocks + 1 + n_docs :].view("<i8")
        self.doc_ids = [None if z else int(x) for x, z in zip(ids, null)]

    @property
    def n_blocks(self) -> int:
        return len(self._offsets) - 1

    def block(self, k: int) -> np.ndarray:
        start, end = int(self._offsets[k]), int(self._offsets[k + 1])
        n = min(self.block_ids, self.n_tokens - k * self.block_ids)
        return unpack(self._file.read(start, end - start), self.bits, n)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` (exclusive), from the blocks that hold them only."""
        if first >= last:
            return np.zeros(0, np.uint32)
        blocks = range(first // self.block_ids, (last - 1) // self.block_ids + 1)
        found = np.concatenate([self.block(k) for k in blocks])
        return found[first - blocks[0] * self.block_ids : last - blocks[0] * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.doc_ends[k - 1]) if k else 0, int(self.doc_ends[k]))

    def close(self) -> None:
        self._file.close()


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    vocabulary: int,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_ids: int = 1 << 16,
) -> DataFrame:
    """Encode whole texts, end each document with ``end_id``, and write them in ascending id order.

    The rows are dealt out by range of the id, equal ids by the text, so that one id (or null, which
    comes first) with many rows is spread; each task encodes and writes its range as one file. A null
    text is an empty one, whose document is the end id alone; rows with the same id stay several
    documents; an empty table gives no file. Other columns are not read.

    Returns the manifest: file, part (the order of files), n_docs, n_tokens, first_token.
    """
    bits = bits_for(max(vocabulary, end_id + 1))
    chosen = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    dealt = chosen.repartitionByRange(*order[:2]).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = None
        part = TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows and writer is None:
                encoder = shared_encoder(tokenizer)
                writer = TokenWriter(folder, f"part-{part:06d}", bits, block_ids)
            for part_of in slices(batch, "text", TOGETHER):
                ids, ends = encoder.encode_column(part_of.column("text"))
                ids = np.insert(ids, ends, end_id)
                ends = (ends + np.arange(1, len(ends) + 1)).tolist()
                for doc_id, first, last in zip(part_of.column("doc_id").to_pylist(), [0, *ends], ends):
                    writer.add(doc_id, ids[first:last])
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "file": [writer.name],
                    "part": pa.array([part], pa.int32()),
                    "n_docs": [writer.n_docs],
                    "n_tokens": [writer.n_tokens],
                }
            )

    dealt.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a written folder, with the ids before each; one row per file, so one task numbers them."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").withColumn(
        "first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids before it in all files), n_tokens and
    ids_crc32 (crc32 of its ids as little-endian unsigned 32-bit integers).

    A task reads a file block by block, so a document longer than memory is no trouble.
    """
    manifest = read_manifest(spark, folder).select("file", "first_token")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(*(batch.column(c).to_pylist() for c in ("file", "first_token"))):
                file = TokenFile(folder, name)
                yield from _digests(file, first)
                file.close()

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return manifest.repartition(n).mapInArrow(read, schema)


def _digests(file: TokenFile, first_token: int) -> Iterator[pa.RecordBatch]:
    crcs: list[int] = []
    crc, at = 0, 0
    for k in range(file.n_blocks):
        ids = file.block(k).astype("<u4")
        view, base = memoryview(ids).cast("B"), at
        last = base + len(ids)
        while len(crcs) < len(file.doc_ends):
            end = int(file.doc_ends[len(crcs)])
            crc = zlib.crc32(view[(at - base) * 4 : (min(end, last) - base) * 4], crc)
            at = min(end, last)
            if end > last:
                break
            crcs.append(crc)
            crc = 0
    starts = np.concatenate(([0], file.doc_ends[:-1])).astype(np.int64)
    for a in range(0, len(crcs), _ROWS):
        b = min(a + _ROWS, len(crcs))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(file.doc_ids[a:b], pa.int64()),
                "start": starts[a:b] + first_token,
                "n_tokens": file.doc_ends[a:b] - starts[a:b],
                "ids_crc32": pa.array(crcs[a:b], pa.int64()),
            }
        )
