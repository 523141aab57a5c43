"""Flat binary files that tasks write beside each other in a shared folder.

Every attempt of a task writes files of its own name and reports them as rows of its result; the
result is written as a table by Spark, whose committer keeps one attempt per task. Readers open only
files of that table, so what a lost or repeated attempt left behind is never read.
Folders are URIs of any store that ``pyarrow.fs`` opens (``file:``, ``hdfs:``, ``s3:``, ``gs:``).
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from lamina.runtime import scratch_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused folder below the shared scratch folder."""
    return f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    # Spark spells local URIs file:/path; the other reader wants file:///path.
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


class Output:
    """A new file of a task attempt."""

    def __init__(self, folder: str, prefix: str, suffix: str):
        store, path = opened(folder)
        store.create_dir(path, recursive=True)
        self.name = f"{prefix}-{uuid.uuid4().hex}{suffix}"
        self.size = 0
        # The bytes as they are, whatever the suffix says.
        self._stream = store.open_output_stream(f"{path}/{self.name}", compression=None)

    def write(self, data: bytes) -> None:
        self._stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._stream.close()


class Input:
    """Ranges of one file."""

    def __init__(self, folder: str, name: str):
        store, path = opened(folder)
        self._file = store.open_input_file(f"{path}/{name}")
        self.size = self._file.size()

    def read(self, start: int, length: int) -> bytes:
        return self._file.read_at(length, start)

    def close(self) -> None:
        self._file.close()


def opened_if_there(folder: str, name: str) -> Input | None:
    try:
        return Input(folder, name)
    except FileNotFoundError:
        return None
