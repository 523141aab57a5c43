"""Token counts of documents in flat files of token ids, which hold nothing but ids and separators.

A file is cut into blocks of a fixed number of ids, whatever documents they belong to. Every block is
searched for separators on its own; a prefix scan over the blocks of a file then tells each block how
many documents ended before it and where the last one did, which stitches documents across blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.llm.encoder import TOGETHER, shared_encoder
from lamina.llm.files import Input, Output
from lamina.llm.words import slices
from lamina.runtime import materialize

_WRITTEN = "file string, part int, ordinal long, doc_id long"
_SCANNED = "file string, block long, n_ends long, last_end long, size long, ends array<long>"
_ROWS = 4096


def write_flat(
    docs: DataFrame, folder: str, tokenizer: str, separator: int, width: int = 2,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Write whole texts as ids of ``width`` bytes (little endian), a separator behind each document.

    Each task writes the rows it reads as one file. Strings of special tokens in a text are ordinary
    text, so that the separator stands for the end of a document alone. A null text is empty. Returns
    which document is the how-manieth of which file, and nothing about its length.
    """
    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                encoder, out = shared_encoder(tokenizer, literal=True), Output(folder, f"part-{part:06d}", ".ids")
            for part_of in slices(batch, "text", TOGETHER):
                ids, ends = encoder.encode_column(part_of.column("text"))
                if len(ids) and int(ids.max()) >> (8 * width):
                    raise ValueError(f"an id does not fit into {width} bytes")
                out.write(np.insert(ids.astype(f"<u{width}"), ends, separator).tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_pydict(
                {
                    "file": [out.name] * n,
                    "part": pa.array([part] * n, pa.int32()),
                    "ordinal": np.arange(done, done + n),
                    "doc_id": batch.column("doc_id"),
                }
            )
            done += n
        if out is not None:
            out.close()

    return materialize(chosen.mapInArrow(write, _WRITTEN), "flat-documents")


def count_tokens(files: DataFrame, folder: str, separator: int, width: int = 2, block: int = 1 << 20) -> DataFrame:
    """One row per document of the flat files: file, ordinal, start, n_tokens, ended.

    ``files`` names files in its column ``file``; ``start`` is in ids from the beginning of the file and
    ``n_tokens`` leaves the separator out. Ids behind the last separator of a file are a document
    that was not ended; a separator at the beginning or behind another ends an empty document; an
    empty file has none. A file whose size is no multiple of the width is an error.
    """
    spark = files.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("file").to_pylist()
            sizes = []
            for name in names:
                file = Input(folder, name)
                if file.size % width:
                    raise ValueError(f"{name} does not hold whole ids")
                sizes.append(file.size // width)
                file.close()
            yield pa.RecordBatch.from_pydict({"file": pa.array(names, pa.string()), "size": pa.array(sizes, pa.int64())})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file, first = Input(folder, row["file"]), row["block"] * block
                ids = np.frombuffer(file.read(first * width, block * width), f"<u{width}")
                file.close()
                ends = np.flatnonzero(ids == separator) + first
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": [row["file"]],
                        "block": [row["block"]],
                        "n_ends": [len(ends)],
                        "last_end": pa.array([int(ends[-1]) + 1 if len(ends) else None], pa.int64()),
                        "size": [row["size"]],
                        "ends": pa.array([ends], pa.list_(pa.int64())),
                    }
                )

    sized = files.select("file").distinct().mapInArrow(measure, "file string, size long").where("size > 0")
    last = F.floor((F.col("size") - 1) / block).cast("long")
    blocks = sized.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition(n)
    scanned = materialize(blocks.mapInArrow(scan, _SCANNED), "separator-blocks")

    # Only the summaries of blocks are scanned, not the positions.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = scanned.select(
        "file", "block",
        F.coalesce(F.sum("n_ends").over(earlier), F.lit(0)).alias("done"),
        F.coalesce(F.max("last_end").over(earlier), F.lit(0)).alias("since"),
    )
    joined = scanned.join(stitched, ["file", "block"])
    inner = F.transform(F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))), lambda x: x + 1)
    starts = F.concat(F.array("since"), inner)
    ended = joined.where("n_ends > 0").select(
        "file", "done", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end")))
    )
    ended = ended.select(
        "file", (F.col("done") + F.col("pos")).alias("ordinal"), F.col("col.start").alias("start"),
        (F.col("col.end") - F.col("col.start")).alias("n_tokens"), F.lit(True).alias("ended"),
    )
    rest = scanned.groupBy("file").agg(
        F.sum("n_ends").alias("ordinal"), F.coalesce(F.max("last_end"), F.lit(0)).alias("start"), F.max("size").alias("size")
    ).where("size > start")
    open_ends = rest.select("file", "ordinal", "start", (F.col("size") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(open_ends)


def count_document_tokens(spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, separator: int, width: int = 2) -> DataFrame:
    """doc_id, n_tokens, part, ordinal and start of every document, counted in the flat files written here."""
    written = write_flat(docs, folder, tokenizer, separator, width)
    counted = count_tokens(written, folder, separator, width)
    return written.join(counted, ["file", "ordinal"], "left").select("doc_id", "n_tokens", "part", "ordinal", "start")
