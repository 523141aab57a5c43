"""Clustering of a table by several columns at once, along a space-filling curve over their ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _code(df: DataFrame, col: str) -> Column:
    """A number in the order of the column's values; texts by their first seven bytes."""
    kind, value = df.schema[col].dataType, F.col(f"`{col}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return value.cast("double") if isinstance(kind, (T.DecimalType, T.FractionalType)) else value.cast("long")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        first = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0")
        return F.conv(first, 16, 10).cast("long")
    raise ValueError(f"{col} has no order to cluster by: {kind.simpleString()}")


def rank_bounds(df: DataFrame, cols: Sequence[str], bits: int = 8) -> dict[str, list]:
    """For each column the values that part its rows into ``2**bits`` about equal ranks, by one aggregate."""
    parts = 1 << bits
    shares = [i / parts for i in range(1, parts)]
    told = df.agg(*[F.percentile_approx(_code(df, c), shares, F.lit(10 * parts)).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    return {c: told[f"b{i}"] or [] for i, c in enumerate(cols)}


def _rank(code: Column, bounds: list, bits: int) -> Column:
    """How many bounds are at most the code, found bit by bit; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    held = F.array(*map(F.lit, bounds))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    # The bound with the number r + step is the least value of the ranks from there on.
    return F.aggregate(
        steps, F.lit(0), lambda r, step: r + F.when(F.get(held, r + step - 1) <= code, step).otherwise(F.lit(0))
    )


def curve(df: DataFrame, cols: Sequence[str], bits: int = 8, bounds: dict[str, list] | None = None) -> Column:
    """The place of a row on the curve: the bits of its ranks in all columns, in turn, the highest first.

    Rows near each other on the curve are near in every column, so that a range of it, a file or a row group, has a
    narrow range of each. Ranks are about equally frequent, whatever the values are; NULL has the first one.
    """
    if bits * len(cols) > 62:
        raise ValueError(f"{len(cols)} columns of {bits} bits do not fit into a number")
    bounds = rank_bounds(df, cols, bits) if bounds is None else bounds
    ranks = [_rank(_code(df, c), bounds[c], bits).cast("long") for c in cols]
    place = F.lit(0).cast("long")
    for b in range(bits):
        for i, rank in enumerate(ranks):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1))
            place = place.bitwiseOR(F.shiftleft(bit, b * len(cols) + len(cols) - 1 - i))
    return place
