"""Columns of tables that pass through Python, whatever they are called."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.runtime import is_plain_scan, materialize


def others(docs: DataFrame, added: Iterable[str]) -> list[str]:
    """Columns that are not called like an added one, in any case of letters."""
    names = {c.lower() for c in added}
    return [c for c in docs.columns if c.lower() not in names]


def with_text(docs: DataFrame, kept: list[str], text_column: str) -> tuple[DataFrame, str]:
    """The columns ``kept``, named by their numbers since names with dots do not pass ``mapInArrow``, and the text.

    Returns the name of the text's column too: one of those kept, if it is among them.
    """
    columns = {f"c{i}": F.col(f"`{c}`") for i, c in enumerate(kept)}
    name = f"c{kept.index(text_column)}" if text_column in kept else "__text"
    columns[name] = F.col(f"`{text_column}`")
    return docs.select(*[column.alias(c) for c, column in columns.items()]), name


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number of its own for every row, the same however often ``docs`` is read.

    A Parquet table as it is read has such numbers: that of the file and the row's place in it. Other frames are written
    to the scratch folder with numbers.
    """
    try:
        # A frame that is not a table has no such columns.
        placed = docs.withColumns({"__file": F.col("_metadata.file_path"), "__at": F.col("_metadata.row_index")})
        files = placed.select("__file").distinct() if is_plain_scan(docs) else None
    except AnalysisException:
        files = None
    if files is None:
        return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "numbered-rows")
    # One row per file.
    order = Window.orderBy("__file")
    files = materialize(files.withColumn("__number", F.row_number().over(order).cast("long")), "numbered-files")
    number = F.shiftleft("__number", 40).bitwiseOR(F.col("__at"))
    return placed.join(F.broadcast(files), "__file").withColumn(name, number).drop("__file", "__at", "__number")
