"""Deterministic deduplication in two phases: digests of the keys first, whole rows only where a digest repeats."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.operators.joins import DEFAULT_SKEW, SkewPolicy, lookup_join
from lamina.runtime import is_plain_scan, materialize

# Share of rows with repeated keys from which all rows are compared at once.
_SEVERAL = 0.25

AUDIT_COLUMNS = (
    "_ingestion_timestamp",
    "_source_system",
    "_batch_id",
    "ingestion_year",
    "ingestion_month",
    "ingestion_day",
)


def business_columns(df: DataFrame, key: str | Sequence[str] = ()) -> list[str]:
    """Columns carrying business content: neither audit columns nor the given key."""
    skip = {key} if isinstance(key, str) else set(key)
    return [
        c for c in df.columns if c not in skip and c not in AUDIT_COLUMNS and not c.startswith("_")
    ]


def _order(order: Sequence[str], rest: Sequence[str], last: bool) -> list[Column]:
    """The least row by ``order`` with NULL behind every value, then by the other columns; or the greatest row."""
    cols = [F.col(f"`{c}`") for c in (*order, *rest)]
    if last:
        return [c.desc_nulls_last() for c in cols]
    return [c.asc_nulls_last() if i < len(order) else c.asc_nulls_first() for i, c in enumerate(cols)]


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), last: bool = False) -> DataFrame:
    """``keep_one`` in one phase, for frames most of whose keys repeat.

    Each task first keeps one row per key, so a key with a third of all rows sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    within = Window.partitionBy(*[f"`{c}`" for c in keys]).orderBy(*_order(order, rest, last))
    return df.withColumn("__rank", F.row_number().over(within)).where("__rank = 1").drop("__rank")


def _digests(keys: Sequence[str]) -> list[Column]:
    """128 bits over the values of the keys and which of them are NULL."""
    cols = [F.col(f"`{k}`") for k in keys]
    # Hashes pass over NULL; its places are hashed as bits, 60 to a number.
    nulls = [
        reduce(Column.bitwiseOR, [F.shiftleft(c.isNull().cast("long"), i) for i, c in enumerate(cols[at : at + 60])])
        for at in range(0, len(cols), 60)
    ]
    return [F.xxhash64(*cols, *nulls).alias("__d1"), F.xxhash64(F.lit(1), *nulls, *cols).alias("__d2")]


def repeated_digests(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``__d1``, ``__d2`` and the rows ``__n`` of the keys with more than one row, written to the scratch folder.

    16 bytes a row and a count are combined in each task and shuffled, whatever the keys are.
    """
    counts = df.select(*_digests(keys)).groupBy("__d1", "__d2").agg(F.count(F.lit(1)).alias("__n"))
    return materialize(counts.where(F.col("__n") > 1), "repeated-digests")


def keep_one(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    last: bool = False,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """One whole row per key (NULLs equal): the least by ``order``, or the greatest if ``last``.

    A value comes before NULL either way. Remaining columns break ties in column order, so the survivor never depends on how the data
    was laid out. Two phases, unless a quarter of the rows or more share their key: digests of the keys are counted, and rows whose digest is the only one pass as they
    are, without a shuffle while the repeated digests are few. Only the others are compared by the keys themselves, so that two
    keys of one digest both stay. A frame that is more than a scan is written to the scratch folder first, as it is
    read more than once.
    """
    keys = list(keys)
    order = [c for c in order if c in df.columns and c not in keys]
    df = df if is_plain_scan(df) else materialize(df, "rows-to-compare")
    repeated = repeated_digests(df, keys)
    n, rows = repeated.agg(F.count(F.lit(1)), F.sum("__n")).first()
    if n == 0:
        return df
    if rows > _SEVERAL * df.count():
        return _one_of_several(df, keys, order, last, policy)
    on = ["__d1", "__d2"]
    marked = df.withColumns(dict(zip(on, _digests(keys))))
    if n <= policy.broadcast_rows:
        few = F.broadcast(repeated.select(*on))
        single, several = (marked.join(few, on, how) for how in ("left_anti", "left_semi"))
    else:
        single, several = (
            lookup_join(marked, repeated.select(*on), on, how, policy, right_is_large=True, counted=(repeated, "__n"))
            for how in ("left_anti", "left_semi")
        )
    return single.drop(*on).unionByName(_one_of_several(several.drop(*on), keys, order, last, policy))


def _one_of_several(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool, policy: SkewPolicy
) -> DataFrame:
    """One row per key of rows most of which share theirs.

    Where the other columns have few different values in all, as those of an audit do, these are numbered in
    their order and broadcast, and the least number per key is all there is to aggregate.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    if set(others) <= set(AUDIT_COLUMNS):
        values = materialize(df.select(*others).distinct(), "audit-values")
        if values.count() <= policy.broadcast_rows:
            numbers = Window.orderBy(*_order(order, [c for c in others if c not in order], last))
            values = values.withColumn("__number", F.row_number().over(numbers))
            same = reduce(Column.__and__, [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in others])
            coded = df.alias("a").join(F.broadcast(values.alias("b")), same).select(
                *[F.col(f"a.`{k}`").alias(k) for k in keys], "b.__number"
            )
            least = coded.groupBy(*[f"`{k}`" for k in keys]).agg(F.min("__number").alias("__number"))
            return least.join(F.broadcast(values), "__number").select(*[f"`{c}`" for c in df.columns])
    return first_row(df, keys, order, last)


def drop_exact(df: DataFrame, ignore: Sequence[str] = AUDIT_COLUMNS) -> DataFrame:
    """Drop rows that agree on every column but the ignored ones, keeping the earliest audit."""
    ignored = [c for c in df.columns if c in ignore]
    return keep_one(df, [c for c in df.columns if c not in ignored], ignored)


def drop_business_copies(df: DataFrame, key: str) -> DataFrame:
    """Of rows that differ in their key (and audit columns) only, keep the lowest key."""
    return keep_one(df, business_columns(df, key), [key])
