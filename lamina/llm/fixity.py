"""WARC files of pages, and a fixity audit that compares replicas by Merkle trees.

The records of a file cut it into ordered ranges of offsets: each from the end of the record before to its own end, the
last to the end of the file, so that no byte of a file is outside of them. Every range is hashed with its offset and
length in it into a leaf; sixteen neighbours by file and offset are hashed into a node of the level above,
and so on to one root. Replicas with equal roots are equal. Otherwise only the children of nodes that
differ are compared, level by level, down to the ranges that are corrupt.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.files import Input, Output, opened_if_there
from lamina.runtime import materialize

_BITS = 4  # sixteen children to a node
_RECORD = "page_id long, file string, part int, ordinal long, offset long, length long"
_LEAF = "part int, idx long, hash string, sha256 string"
_MISSING = "missing"
_CHUNK = 1 << 22  # bytes of a range in memory
_DATE = "2024-01-01T00:00:00Z"


def warc_record(page_id: int | None, url: str | None, body: str | None) -> bytes:
    """A WARC/1.1 resource record as a gzip member of its own. Null values: no target, no content."""
    content = (body or "").encode()
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url}")
    target = [] if url is None else [f"WARC-Target-URI: {url}"]
    head = [
        "WARC/1.1", "WARC-Type: resource", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {_DATE}",
        *target, "Content-Type: text/html", f"Content-Length: {len(content)}",
    ]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + content + b"\r\n\r\n", 6, mtime=0)


def write_warc(
    pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", body_column: str = "html"
) -> DataFrame:
    """Write every row as a record, one file per task; returns where each record is.

    Repeated rows become records of their own; an empty table writes no file.
    """
    chosen = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.col(body_column).alias("body")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or Output(folder, f"part-{part:06d}", ".warc.gz")
            offsets, lengths = [], []
            for page_id, url, body in zip(*(batch.column(c) for c in ("page_id", "url", "body"))):
                record = warc_record(page_id.as_py(), url.as_py(), body.as_py())
                offsets.append(out.size)
                lengths.append(len(record))
                out.write(record)
            n = batch.num_rows
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column("page_id"),
                    "file": [out.name] * n,
                    "part": pa.array([part] * n, pa.int32()),
                    "ordinal": pa.array(range(done, done + n), pa.int64()),
                    "offset": pa.array(offsets, pa.int64()),
                    "length": pa.array(lengths, pa.int64()),
                }
            )
            done += n
        if out is not None:
            out.close()

    return materialize(chosen.mapInArrow(write, _RECORD), "warc-records")


def _by_file(records: DataFrame) -> DataFrame:
    """The places of the records and where their ranges begin, in order of file and offset, spread by ranges of both.

    ``last`` marks the last record of a file. A window holds the numbers of one file's records.
    """
    within = Window.partitionBy("part", "file").orderBy("ordinal")
    places = records.select("part", "ordinal", "file", "offset", "length").withColumns(
        {
            "since": F.coalesce(F.lag(F.col("offset") + F.col("length")).over(within), F.lit(0)),
            "last": F.lead("ordinal").over(within).isNull(),
        }
    )
    return places.repartitionByRange("part", "ordinal").sortWithinPartitions("part", "ordinal")


def copy_replica(records: DataFrame, source: str, target: str, damaged: Column | None = None) -> DataFrame:
    """Copy the files record by record into another folder; returns the places in the copy.

    ``damaged`` marks records of which one bit is turned over on the way, for drills of the audit.
    """
    marked = records.select(*records.columns, (F.lit(False) if damaged is None else damaged).alias("damaged"))
    files = marked.repartition(F.col("file")).sortWithinPartitions("file", "offset")

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = reader = out = None
        for batch in batches:
            names, offsets = [], []
            for row in batch.to_pylist():
                if row["file"] != name:
                    if out is not None:
                        reader.close()
                        out.close()
                    name, reader = row["file"], Input(source, row["file"])
                    out = Output(target, row["file"].split("-")[0] + f"-{row['part']:06d}", ".warc.gz")
                data = reader.read(row["offset"], row["length"])
                if row["damaged"]:
                    data = data[:-1] + bytes([data[-1] ^ 1])
                offsets.append(out.size)
                out.write(data)
                names.append(out.name)
            columns = {c: batch.column(c) for c in batch.schema.names if c != "damaged"}
            columns["file"] = pa.array(names, pa.string())
            columns["offset"] = pa.array(offsets, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        if out is not None:
            reader.close()
            out.close()

    return materialize(files.mapInArrow(copy, records.schema), "warc-replica")


def _range(file: Input | None, row: dict) -> tuple[str, str | None]:
    """The hash of a record's range, and of the record itself; of what is not there, none."""
    if file is None:
        return _MISSING, None
    since, end = min(row["since"], row["offset"]), row["offset"] + row["length"]
    stop = max(end, file.size) if row["last"] else end
    # Offsets within the range, so that records behind one that is missing are not taken for damaged.
    whole = hashlib.sha256(f"{row['offset'] - since} {row['length']} {stop - since}\n".encode())
    inside = hashlib.sha256()
    for at in range(since, stop, _CHUNK):
        data = file.read(at, min(_CHUNK, stop - at))
        whole.update(data)
        inside.update(data[max(0, row["offset"] - at) : max(0, end - at)])
    # A file that ends inside of the record has only part of it.
    return whole.hexdigest(), inside.hexdigest() if end <= file.size else None


def merkle_levels(records: DataFrame, folder: str) -> list[DataFrame]:
    """The nodes of every level, leaves first: part, idx, hash; leaves have ``sha256`` of the record too.

    A leaf hashes where its record lies in its range and the bytes there, those between records among them; the range of a file's last
    record goes to the end of the file. A file that is missing has leaves of one hash of its own. Within a file sixteen neighbours make a node; when every file is
    one node, sixteen neighbouring files do, up to one root. No rows, no levels.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = file = None
        for batch in batches:
            hashes = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    if file is not None:
                        file.close()
                    name, file = row["file"], opened_if_there(folder, row["file"])
                hashes.append(_range(file, row))
            yield pa.RecordBatch.from_pydict(
                {
                    "part": batch.column("part"),
                    "idx": batch.column("ordinal"),
                    "hash": pa.array([h for h, _ in hashes], pa.string()),
                    "sha256": pa.array([h for _, h in hashes], pa.string()),
                }
            )
        if file is not None:
            file.close()

    leaves = materialize(_by_file(records).mapInArrow(read, _LEAF), "merkle-leaves")
    most = leaves.agg(F.max("idx"), F.max("part")).first()
    if most[0] is None:
        return []
    levels = [leaves]
    within, across = most[0], most[1]
    while within > 0 or across > 0:
        part, idx = (F.col("part"), F.shiftright("idx", _BITS)) if within > 0 else (F.shiftright("part", _BITS), F.col("idx"))
        child = F.col("idx") if within > 0 else F.col("part").cast("long")
        parents = levels[-1].select(part.alias("part"), idx.alias("idx"), F.struct(child.alias("at"), "hash").alias("child"))
        # At most sixteen children are collected.
        hashed = F.sha2(F.concat_ws("", F.transform(F.array_sort(F.collect_list("child")), lambda c: c["hash"])), 256)
        levels.append(materialize(parents.groupBy("part", "idx").agg(hashed.alias("hash")), "merkle-nodes"))
        if within > 0:
            within >>= _BITS
        else:
            across >>= _BITS
    return levels


def differing_leaves(ours: list[DataFrame], theirs: list[DataFrame], within: int) -> DataFrame | None:
    """part, idx, our and their hash of the records that differ; None where the roots are equal.

    ``within`` is the largest place of a record in a file, which tells the levels inside files.
    """
    inner, left = 0, within
    while left > 0:
        inner, left = inner + 1, left >> _BITS
    wrong = None
    for level in range(len(ours) - 1, -1, -1):
        a = ours[level].select("part", "idx", F.col("hash").alias("ours"))
        b = theirs[level].select("part", "idx", F.col("hash").alias("theirs"))
        if wrong is not None:
            inside = level < inner
            parent_part = F.col("part") if inside else F.shiftright("part", _BITS)
            parent_idx = F.shiftright("idx", _BITS) if inside else F.col("idx")
            branch = wrong.select(F.col("part").alias("up_part"), F.col("idx").alias("up_idx"))
            a = a.join(branch, (parent_part == F.col("up_part")) & (parent_idx == F.col("up_idx")), "left_semi")
            b = b.join(branch, (parent_part == F.col("up_part")) & (parent_idx == F.col("up_idx")), "left_semi")
        both = a.join(b, ["part", "idx"], "full_outer")
        wrong = materialize(both.where(~F.col("ours").eqNullSafe(F.col("theirs"))), "merkle-wrong")
        if wrong.isEmpty():
            return None
    return wrong


def audit(records: DataFrame, folder: str, replica: DataFrame, replica_folder: str) -> DataFrame:
    """Every record of either archive with ``sha256``, its replica's ``replica_sha256``, ``intact`` and ``damage``.

    Both trees are built from the bytes that the folders hold now. ``damage`` is null for an intact record, else
    ``record`` where its bytes differ, ``around`` where these are the same but not what stands before it or, for the last
    one of a file, behind it, or its offset, ``missing`` where the replica does not have it, its file or all of it, and
    ``extra`` for a record that only the replica has, which has no ``sha256``. A folder without a file that
    its records name has missing records. Without records in either there are no rows.
    """
    spark = records.sparkSession
    ours, theirs = merkle_levels(records, folder), merkle_levels(replica, replica_folder)
    wrong = None
    if ours and len(ours) == len(theirs):
        wrong = differing_leaves(ours, theirs, records.agg(F.max("ordinal")).first()[0])
    elif ours or theirs:  # trees of other shapes: compare the leaves
        nothing = (ours or theirs)[0].limit(0)
        a, b = (levels[0] if levels else nothing for levels in (ours, theirs))
        both = a.select("part", "idx", F.col("hash").alias("ours")).join(
            b.select("part", "idx", F.col("hash").alias("theirs")), ["part", "idx"], "full_outer"
        )
        wrong = both.where(~F.col("ours").eqNullSafe(F.col("theirs")))
    empty = spark.createDataFrame([], _LEAF)
    at = ["part", "ordinal"]
    mine = (ours[0] if ours else empty).select("part", F.col("idx").alias("ordinal"), "sha256")
    other = (theirs[0] if theirs else empty).select("part", F.col("idx").alias("ordinal"), F.col("sha256").alias("there"))
    placed = records.join(mine, at)
    if wrong is None:
        return placed.select(
            *records.columns, "sha256", F.col("sha256").alias("replica_sha256"), F.lit(True).alias("intact"),
            F.lit(None).cast("string").alias("damage"),
        )
    found = wrong.select("part", F.col("idx").alias("ordinal"), "ours", "theirs").join(other, at, "left")
    found = found.withColumn("damaged", F.lit(True))
    marked = placed.join(found, at, "left")
    damage = (
        F.when(F.col("damaged").isNull(), None)
        .when(F.col("theirs").isNull() | F.col("there").isNull(), "missing")
        .when(F.col("there") != F.col("sha256"), "record").otherwise("around")
    )
    held = marked.select(
        *records.columns, "sha256", F.when(F.col("damaged"), F.col("there")).otherwise(F.col("sha256")).alias("replica_sha256"),
        F.col("damaged").isNull().alias("intact"), damage.alias("damage"),
    )
    extra = replica.join(found.where("ours IS NULL"), at).select(
        *replica.columns, F.lit(None).cast("string").alias("sha256"), F.col("there").alias("replica_sha256"),
        F.lit(False).alias("intact"), F.lit("extra").alias("damage"),
    )
    return held.unionByName(extra)
