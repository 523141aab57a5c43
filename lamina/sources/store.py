"""Layer tables on a shared file system: replaced as a whole, or appended to by batch."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.curve import curve
from lamina.runtime import delete_folder, folder_bytes, read_note, write_note

_SLOT = "_slot"
_SCHEMA = "schema"
_PLACE = "__place"


class TableStore:
    """Tables under one root folder, in Parquet by default.

    Spark must not overwrite a folder its plan reads: the old files are gone before the new ones
    are complete. A table is therefore replaced by writing a new version folder beside the old
    ones, and readers take the latest folder whose write was committed (it holds ``_SUCCESS``).
    A job that fails half way leaves the previous version in force, and an upsert may read the
    table it replaces. With ``fmt="delta"`` the format does this itself and tables are plain paths.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    # -- whole tables ------------------------------------------------------------------------

    def write(
        self,
        df: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
        gather: bool = True,
        along_curve: bool = False,
    ) -> str:
        """Replace a table; its schema may change. Returns the folder written.

        Rows are brought together by partition value first, so that each partition gets a few
        large files and not one per task; the rebalance splits a partition value that holds too
        much. ``gather=False`` leaves the rows where they are, for partition columns that have one value
        in all rows. ``cluster_by`` sorts the files by range for readers that filter on those columns;
        a hash of the row breaks ties, so that rows of one value fill several files. The first column is served best;
        ``along_curve`` orders by the ranks of all of them together instead, so that a filter on any one skips most row
        groups.
        """
        columns = df.columns
        if cluster_by:
            hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
            ties = F.xxhash64(*[F.col(f"`{c}`") for c in hashed])
            if along_curve:
                df = df.withColumn(_PLACE, curve(df, cluster_by))
            order = [_PLACE] if along_curve else cluster_by
            df = df.repartitionByRange(*partition_by, *order, ties)
            df = df.sortWithinPartitions(*partition_by, *order).select(*[F.col(f"`{c}`") for c in columns])
        elif partition_by and gather:
            df = df.hint("rebalance", *partition_by)
        path = f"{self.root}/{name}"
        writer = df.write.format(self.fmt)
        if self.fmt == "delta":
            writer = writer.mode("overwrite").option("overwriteSchema", "true")
        else:
            path = f"{path}/{_version(self.path(name))}"
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(path)
        if self.fmt != "delta":
            self.set_note(path, _SCHEMA, df.schema.json())
        return path

    def merge(self, source: DataFrame, name: str, keys: Sequence[str]) -> None:
        """Upsert into a table whose format merges in place, rewriting only the files it must.

        ``source`` has one row per key.
        """
        view = f"merge_{uuid.uuid4().hex}"
        source.createOrReplaceTempView(view)
        try:
            self.spark.sql(merge_statement(f"{self.fmt}.`{self.root}/{name}`", view, keys))
        finally:
            self.spark.catalog.dropTempView(view)

    def exists(self, name: str) -> bool:
        return self.path(name) is not None

    def path(self, name: str) -> str | None:
        """Folder of the table's current version, None when there is none."""
        if self.fmt == "delta":
            return f"{self.root}/{name}" if self._glob(f"{name}/_delta_log") else None
        done = self._glob(f"{name}/version=*/_SUCCESS")
        return max(done).rsplit("/", 1)[0] if done else None

    def read(self, name: str) -> DataFrame:
        path = self.path(name)
        if path is None:
            raise FileNotFoundError(f"no table {name!r} under {self.root}")
        return self.open(path)

    def open(self, path: str) -> DataFrame:
        """What was written to a folder, by the schema noted there: nothing is read to find it, and a partitioned
        table without rows, which has no files, is a table without rows."""
        reader = self.spark.read.format(self.fmt)
        noted = self.note(path, _SCHEMA) if self.fmt != "delta" else None
        return (reader if noted is None else reader.schema(T.StructType.fromJson(json.loads(noted)))).load(path)

    def prune(self, name: str, keep: int = 2) -> list[str]:
        """Delete all but the last ``keep`` committed versions; returns the folders deleted.

        Keep enough for readers that opened a former version. What failed writes left behind
        before the oldest version kept goes too.
        """
        if self.fmt == "delta" or keep < 1:
            raise ValueError("only versions of this store are pruned, and the current one stays")
        done = sorted(p.rsplit("/", 1)[0] for p in self._glob(f"{name}/version=*/_SUCCESS"))
        if not done:
            return []
        oldest = done[-keep:][0]
        gone = [p for p in self._glob(f"{name}/version=*") if p < oldest]
        for path in gone:
            delete_folder(self.spark, path)
        return gone

    # -- append-only tables ------------------------------------------------------------------

    def append(self, df: DataFrame, name: str, *slot: str) -> str:
        """Add the rows of one batch, identified by ``slot``; returns the folder written.

        The same slot written again, by a batch that is run again, replaces its own rows only, so
        a repeated run adds no copies; its former rows stay in force until the new ones are committed.
        Batches may have different columns. The parts of a slot are escaped, so that different slots
        never share a folder.
        """
        folder = _folder_of(slot)
        before = {p.rsplit("/", 2)[1]: p for p in self.slots(name)}
        path = f"{self.root}/{name}/{folder}/{_version(before.get(folder))}"
        df.write.format("parquet").save(path)
        self.set_note(path, _SCHEMA, df.schema.json())
        return path

    def slots(self, name: str) -> list[str]:
        """Folders of the batches whose write was committed."""
        latest: dict[str, str] = {}
        for path in sorted(p.rsplit("/", 1)[0] for p in self._glob(f"{name}/{_SLOT}=*/version=*/_SUCCESS")):
            latest[path.rsplit("/", 1)[0]] = path
        return sorted(latest.values())

    def read_all(self, name: str, *slot: str) -> DataFrame:
        """Every committed batch of an append-only table, with the union of their columns.

        With the first parts of a ``slot``, only the batches whose slots begin with them are opened.
        """
        folders = self.slots(name)
        if slot:
            wanted = _folder_of(slot)
            named = {f: f.rsplit("/", 2)[1] for f in folders}
            folders = [f for f in folders if named[f] == wanted or named[f].startswith(f"{wanted}+")]
        if not folders:
            raise FileNotFoundError(f"no table {name!r} under {self.root}")
        return self.spark.read.option("mergeSchema", "true").parquet(*folders)

    def delete_appended(self, name: str) -> None:
        """Delete an append-only table with all of its batches."""
        delete_folder(self.spark, f"{self.root}/{name}")

    def slot_folder(self, name: str, *slot: str) -> str | None:
        """Folder of one batch, None where it was never committed."""
        return next((f for f in self.slots(name) if f.rsplit("/", 2)[1] == _folder_of(slot)), None)

    # -- notes beside what was written --------------------------------------------------------

    def note(self, path: str, key: str) -> str | None:
        """What was noted on a committed folder; readers of the table do not see it."""
        return read_note(self.spark, f"{path}/_{key}.json")

    def set_note(self, path: str, key: str, text: str) -> None:
        write_note(self.spark, f"{path}/_{key}.json", text)

    def bytes_of(self, path: str) -> int:
        return folder_bytes(self.spark, path)

    # -- SQL ---------------------------------------------------------------------------------

    def register(self, *names: str) -> dict[str, str]:
        """Make current versions queryable in SQL as temporary views; returns their folders."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)
        return {name: self.path(name) for name in names}

    def create_table(self, name: str, table: str | None = None) -> None:
        """Point an external catalog table to the current version; call it after every write.

        A table that the catalog manages itself is not replaced, since its rows would be lost.
        """
        table = table or name
        catalog = self.spark.catalog
        if catalog.tableExists(table):
            if catalog.getTable(table).tableType != "EXTERNAL":
                raise ValueError(f"{table} exists and is not an external table")
            self.spark.sql(f"DROP TABLE {table}")
        self.spark.sql(f"CREATE TABLE {table} USING {self.fmt} LOCATION '{self.path(name)}'")

    def _glob(self, pattern: str) -> list[str]:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        found = path.getFileSystem(conf).globStatus(path)
        return [str(s.getPath()) for s in found or []]


def _folder_of(slot: Sequence[str]) -> str:
    return f"{_SLOT}=s-{'+'.join(quote(part, safe='') for part in slot)}"


def _version(before: str | None = None) -> str:
    """Name of a version behind ``before``, even where the clock that named that one was ahead."""
    stamp = int(datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f"))
    if before:
        stamp = max(stamp, int(before.rsplit("version=", 1)[1].split("-")[0]) + 1)
    return f"version={stamp}-{uuid.uuid4().hex[:8]}"


def merge_statement(table: str, source: str, keys: Sequence[str]) -> str:
    """MERGE that replaces matching rows and inserts the others; a NULL key matches nothing."""
    same = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    return (
        f"MERGE INTO {table} t USING {source} s ON {same} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def log_frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """Rows known on the driver (one per table, check or run) as a frame with a declared schema."""
    return spark.createDataFrame(rows, schema)
