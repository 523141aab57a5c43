"""Type and text standardisation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAST_ERROR = "_cast_error"


def standardize(df: DataFrame, types: Mapping[str, str], flag: bool = False) -> DataFrame:
    """Cast columns to the types of a spec; a value that does not fit becomes NULL.

    With ``flag`` the column ``_cast_error`` names the first column whose non-NULL value was
    lost, so that a validation rule can route the row instead of losing the value silently.
    Columns that already have their type are passed through untouched.
    """
    current = {f.name: f.dataType for f in df.schema.fields}
    todo = {}
    for name, type_name in types.items():
        target = T._parse_datatype_string(type_name) if isinstance(type_name, str) else type_name
        if current[name] != target:
            todo[name] = F.col(name).try_cast(target)
    if flag:
        lost = [F.when(F.col(n).isNotNull() & c.isNull(), F.lit(n)) for n, c in todo.items()]
        df = df.withColumn(CAST_ERROR, F.coalesce(*lost, F.lit(None).cast("string")))
    return df.withColumns(todo) if todo else df


def normalized(col: Column | str) -> Column:
    return F.upper(F.trim(col))


def normalize_text(df: DataFrame, upper: Iterable[str] = (), trim: Iterable[str] = ()) -> DataFrame:
    """Trim and upper-case some columns, only trim others."""
    exprs = {c: normalized(c) for c in upper} | {c: F.trim(c) for c in trim}
    return df.withColumns(exprs) if exprs else df
