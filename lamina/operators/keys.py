"""Surrogate keys that are the same in every run."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def natural_digest(cols: Sequence[str]) -> Column:
    """SHA-256 over the natural key; NULL and empty text differ, and so do shifted separators."""
    part = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in cols]
    return F.sha2(F.concat_ws("\u001f", *part), 256)


def hashed_key(df: DataFrame, cols: Sequence[str], alias: str) -> DataFrame:
    """The digest of the natural key itself: no shuffle at all, for dimensions of any size."""
    return df.withColumn(alias, natural_digest(cols))


def dense_key(df: DataFrame, cols: Sequence[str], alias: str, digits: int | None = None) -> DataFrame:
    """Numbers 1..n without gaps for a frame with one row per natural key.

    Rows are numbered by digest. The first ``digits`` hex digits cut them into even buckets, each
    numbered on its own behind the total of the buckets before it, so no task sorts everything.
    There are ``16**digits`` buckets, by default as many digits as leave about 100,000 rows to each.
    """
    if digits is None:
        digits = max(1, math.ceil(math.log(max(df.count(), 1) / 100_000, 16)))
    keyed = df.withColumn("__digest", natural_digest(cols))
    keyed = keyed.withColumn("__bucket", F.substring("__digest", 1, digits))
    sizes = keyed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    # One row per bucket, 16**digits at most.
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    within = Window.partitionBy("__bucket").orderBy("__digest")
    return (
        keyed.withColumn("__rn", F.row_number().over(within))
        .join(F.broadcast(offsets), "__bucket")
        .withColumn(alias, (F.col("__off") + F.col("__rn")).cast("long"))
        .drop("__digest", "__bucket", "__rn", "__off")
    )
