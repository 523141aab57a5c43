"""Session settings the plans rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on. Those the user gave when building the session win.
_WANTED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows of long texts sent to Python at once: the buffers of both sides hold a batch or more.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# Scratch tables written in the current scope, None outside of any.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)

# Temporary folders of local-mode sessions, by application.
_LOCAL_SCRATCH: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the wanted runtime settings, leaving alone what the session was built with."""
    given = spark.sparkContext.getConf()
    for key, value in _WANTED.items():
        if not given.contains(key) and spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session, or the
    checkpoint folder its context was given.

    Only a local-mode session without that setting gets a temporary folder; on a cluster a
    missing setting is an error, since a machine-local folder is not visible to other machines.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="lamina-")
    return _LOCAL_SCRATCH[context.applicationId]


def materialize(df: DataFrame, name: str = "step", lasting: bool = False) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Cuts the lineage where several sinks share one plan. A parquet table instead of a checkpoint
    file keeps column pruning and filter pushdown for its readers, and survives lost executors.
    A ``lasting`` table outlives the scratch scope it is written in.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{scratch_dir(spark)}/{app}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    written = _WRITTEN.get()
    if written is not None and not lasting:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


# Operators that a frame read more than once should not repeat.
_DEAR = (
    "Join", "Aggregate", "Window", "Sort", "Generate", "Repartition", "RebalancePartitions", "MapIn", "FlatMap", "Distinct",
    "Expand", "GlobalLimit", "LocalLimit", "Sample", "Offset", "Intersect", "Except",
)


def is_plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` is read, filtered and computed row by row only.

    Reading it again then costs one more scan and gives the same rows.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    names = {line.lstrip(" :+-").split(" ")[0] for line in plan.toString().split("\n")}
    return plan.deterministic() and not any(name.startswith(_DEAR) for name in names)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """A block that executes all it plans: what it wrote to the scratch folder is deleted behind it.

    After a failure the tables stay for inspection.
    """
    token = _WRITTEN.set([])
    try:
        yield
        for path in _WRITTEN.get():
            delete_folder(spark, path)
    finally:
        _WRITTEN.reset(token)


def _file(spark: SparkSession, path: str):
    """A path and its file system, whatever store it is in."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file, file.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, store = _file(spark, path)
    store.delete(folder, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    folder, store = _file(spark, path)
    return store.getContentSummary(folder).getLength()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small text file written from the driver, replacing an earlier one."""
    file, store = _file(spark, path)
    out = store.create(file, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of such a file, None if there is none."""
    file, store = _file(spark, path)
    if not store.exists(file):
        return None
    into = store.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(into, "UTF-8")
    finally:
        into.close()
