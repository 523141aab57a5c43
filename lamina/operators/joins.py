"""Equi-joins against a lookup side that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.runtime import is_plain_scan, materialize

_SALT = "__salt"
_SALTS = "__salts"
_DIGEST = "__digest"
_SKETCHES = 64  # into which the sketches of all tasks are merged first


@dataclass(frozen=True)
class SkewPolicy:
    """When a lookup is broadcast, and when a group of rows is split over several tasks.

    A lookup side is broadcast up to ``broadcast_rows`` rows and ``broadcast_bytes`` bytes, both
    measured. Beyond, the join shuffles, and every key with more than ``rows_per_task`` rows is split.
    """

    broadcast_rows: int = 200_000
    rows_per_task: int = 1_000_000
    broadcast_bytes: int = 64 << 20


DEFAULT_SKEW = SkewPolicy()


def _bytes(df: DataFrame) -> Column:
    """Bytes of a row, those of its texts and nested values measured."""
    total = F.lit(8 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
    return total


def is_small(df: DataFrame, policy: SkewPolicy = DEFAULT_SKEW) -> bool:
    """Whether ``df`` may be broadcast, by its measured rows and bytes (one aggregation)."""
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(_bytes(df)).alias("bytes")).first()
    return size["rows"] <= policy.broadcast_rows and (size["bytes"] or 0) <= policy.broadcast_bytes


def frequent_values(df: DataFrame, col: str, tracked: int = 8192) -> DataFrame:
    """One row per value that may be frequent: ``value``, and bounds ``at_least`` and ``at_most`` of its rows.

    Each task counts in a sketch of at most ``tracked`` values, and sketches are merged in two steps, so that neither
    a task nor a shuffle holds more than some sketches, however many different values there are. Every value
    with more than ``7 / tracked`` of the rows is among them, and at most ``tracked`` in all.
    """
    sketch, part = F.col("__sketch"), F.pmod(F.spark_partition_id(), F.lit(_SKETCHES))
    grouped = df.groupBy(part.alias("__part")).agg(
        F.call_function("approx_top_k_accumulate", F.col(col), F.lit(tracked)).alias("__sketch"),
        F.count(F.lit(1)).alias("__n"),
    )
    # One group rather than none: tasks without rows then have no sketch to merge.
    whole = grouped.groupBy(F.lit("all")).agg(
        F.call_function("approx_top_k_combine", sketch, F.lit(tracked)).alias("__sketch"), F.sum("__n").alias("__n")
    )
    found = F.explode(F.call_function("approx_top_k_estimate", sketch, F.lit(tracked)))
    return whole.select(found.alias("f"), "__n").select(
        F.col("f.item").alias("value"),
        F.col("f.count").alias("at_least"),
        (F.col("f.count") + F.ceil(F.lit(7) * F.col("__n") / F.lit(tracked))).alias("at_most"),
    )


def hot_groups(
    df: DataFrame,
    keys: Sequence[str],
    policy: SkewPolicy = DEFAULT_SKEW,
    rows: str | None = None,
) -> DataFrame | None:
    """Keys to split, with the number of salts each needs, or None when no key is that large.

    A sketch of frequent digests names the candidates in one pass over the key columns; a second pass counts the rows
    of these exactly. No shuffle grows with the number of different keys. Neither pass where ``df`` already has one row
    per key with its number of rows in the column ``rows``. A key is hot with more rows than
    ``policy.rows_per_task``, and than about a thousandth of all rows in tables so large that this is more. The keys
    are written to the scratch folder, all of them, and never pass through the driver.
    """
    keyed = df.dropna(subset=list(keys))
    if rows is None:
        keyed = keyed.select(*keys, F.xxhash64(*keys).alias(_DIGEST))
        candidates = frequent_values(keyed, _DIGEST).where(F.col("at_most") > policy.rows_per_task)
        candidates = materialize(candidates, "frequent-keys")
        if candidates.isEmpty():
            return None
        # At most the values that a sketch tracks.
        named = F.broadcast(candidates.select(F.col("value").alias(_DIGEST)))
        keyed = keyed.join(named, _DIGEST, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias(_SALTS))
    else:
        keyed = keyed.select(*keys, F.col(rows).alias(_SALTS))
    salts = F.ceil(F.col(_SALTS) / policy.rows_per_task).cast("long")
    hot = materialize(keyed.where(F.col(_SALTS) > policy.rows_per_task).withColumn(_SALTS, salts), "hot-keys")
    return None if hot.isEmpty() else hot


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    policy: SkewPolicy = DEFAULT_SKEW,
    right_is_large: bool = False,
    counted: tuple[DataFrame, str] | None = None,
    skew_of: DataFrame | None = None,
    even: bool = False,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join a fact side to a lookup side on equal column names.

    A ``right`` of small measured size is broadcast, so the fact side is not shuffled at all. A larger one
    is shuffled; hot keys of ``left`` are then spread over salts and their few ``right`` rows
    repeated per salt, and rows with a NULL key, which match nothing, are spread likewise.
    ``how`` is inner, left, left_semi or left_anti; columns keep the order of ``left``.
    ``right_is_large`` skips the count where the caller knows that ``right`` grows with the data;
    ``counted`` gives a frame with one row per key of ``left`` and the name of its column of row
    counts, where the caller has them anyway; ``skew_of`` gives a frame with the same key columns
    to look for hot keys in, where ``left`` itself is expensive. ``even`` says that no key of ``left``, nor
    NULL, has many rows, so that nothing is split and the result stays partitioned by the keys alone.
    ``spread_by`` names the columns that tell the rows of one key apart, all of them by default; with a few, no
    other column has to come through the shuffles below only to be hashed. Which keys are split decides how
    the work is spread and never what the result is.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a lookup join keeps the left side; {how!r} does not")
    on = list(on)
    added = [c for c in right.columns if c not in on] if how in ("inner", "left") else []
    columns = [*left.columns, *added]
    if not right_is_large and not is_plain_scan(right):
        # Measured and joined: computed once.
        right = materialize(right, "lookup")
    if not right_is_large and is_small(right, policy):
        return left.join(F.broadcast(right), on, how).select(*columns)
    if even:
        return left.join(right, on, how).select(*columns)
    if counted:
        hot = hot_groups(counted[0], on, policy, counted[1])
    else:
        hot = hot_groups(left if skew_of is None else skew_of, on, policy)
    # The salt of a row depends on the row and its input partition alone: a recomputed task after a
    # lost executor sends its rows to the same place. Rows of one partition spread by their content,
    # and copies of one row by their partitions.
    telling = [f for f in left.schema.fields if spread_by is None or f.name in spread_by]
    hashed = [F.col(f"`{f.name}`") for f in telling if not isinstance(f.dataType, T.MapType)]
    spread = F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), F.lit(1 << 20))
    no_key = F.greatest(*[F.col(k).isNull() for k in on], F.lit(False))
    if hot is None:
        salted = left.withColumn(_SALT, F.when(no_key, spread).otherwise(F.lit(0).cast("long")))
        # Always 0, but not a literal: the optimizer would take that out of the join keys, and
        # rows without a key would meet in one task again.
        lookup = right.withColumn(_SALT, F.pmod(F.xxhash64(*on), F.lit(1)))
    else:
        # Few keys are that large; should they be many, the join with them shuffles like any other.
        hot = F.broadcast(hot) if is_small(hot, SkewPolicy()) else hot
        salted = (
            left.join(hot, on, "left")
            .withColumn(
                _SALT,
                F.when(no_key, spread)
                .when(F.col(_SALTS).isNotNull(), F.pmod(spread, _SALTS))
                .otherwise(F.lit(0).cast("long")),
            )
            .drop(_SALTS)
        )
        lookup = (
            right.join(hot, on, "left")
            .withColumn(
                _SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(_SALTS, F.lit(1)) - 1))
            )
            .drop(_SALTS)
        )
    return salted.join(lookup, [*on, _SALT], how).select(*columns)
