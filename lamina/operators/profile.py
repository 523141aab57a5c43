"""Profiles, conformity and reconciliation of tables, each in one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.context import RunContext
from lamina.functions.money import ratio


def unpivot_row(row: DataFrame, key: str, value: str) -> DataFrame:
    """A one-row frame of like-typed columns as (name, value) rows."""
    return row.unpivot([], row.columns, key, value)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns holding NULLs, with their number and share (4 places) of all rows."""
    cols = list(cols or df.columns)
    total = "__rows"
    counts = df.agg(
        F.count(F.lit(1)).alias(total), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    )
    long = counts.unpivot([total], cols, "column_name", "null_count")
    return long.where(F.col("null_count") > 0).select(
        "column_name",
        "null_count",
        ratio("null_count", total).alias("null_pct"),
    )


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """One row per column: type, row count of the table, NULLs and their share."""
    cols = df.columns
    total = "__rows"
    counts = df.agg(
        F.count(F.lit(1)).alias(total), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    )
    types = F.create_map(
        *[x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))]
    )
    return counts.unpivot([total], cols, "column_name", "null_count").select(
        F.lit(table).alias("table_name"),
        "column_name",
        types[F.col("column_name")].alias("data_type"),
        F.col(total).alias("row_count"),
        "null_count",
        ratio("null_count", total).alias("null_pct"),
    )


def conformity(raw: DataFrame, clean: DataFrame, table: str) -> DataFrame:
    """One row: rows before and after cleaning and their ratio (4 places, NULL for no rows)."""
    n = F.count(F.lit(1))
    both = raw.agg(n.alias("raw_rows")).withColumn("clean_rows", clean.agg(n).scalar())
    return both.select(
        F.lit(table).alias("table_name"),
        "raw_rows",
        "clean_rows",
        ratio("clean_rows", "raw_rows").alias("conformity_rate"),
    )


def conformity_gate(rates: DataFrame, minimum: float) -> DataFrame:
    """PASSED where the rate reaches the minimum; an unknown rate fails."""
    ok = F.col("conformity_rate") >= F.lit(minimum)
    return rates.withColumn("status", F.when(ok, F.lit("PASSED")).otherwise(F.lit("FAILED")))


def metric_rows(table: str, metrics: DataFrame, ctx: RunContext) -> DataFrame:
    """A one-row frame of numbers as rows of the quality report; a NULL is no metric."""
    doubles = metrics.select(*[F.col(c).cast("double").alias(c) for c in metrics.columns])
    return unpivot_row(doubles, "metric", "value").where(F.col("value").isNotNull()).select(
        F.lit(table).alias("table"),
        "metric",
        "value",
        F.lit(ctx.utc).cast("timestamp").alias("timestamp"),
        F.lit(ctx.batch_id).alias("batch_id"),
    )


def reconcile(
    counts: Mapping[str, DataFrame], by: Column, group: str, measures: Sequence[str]
) -> DataFrame:
    """Rows per group in each named frame, one column per measure, with a grand total row.

    ``counts`` names the frames; every frame is reduced to one row per group before they meet.
    The total row has a NULL group and ``is_total`` 1.
    """
    parts = []
    for name, df in counts.items():
        per = df.groupBy(by.alias(group)).agg(F.count(F.lit(1)).alias("__n"))
        parts.append(per.withColumn("__measure", F.lit(name)))
    every = reduce(DataFrame.unionByName, parts)
    pick = [
        F.coalesce(F.sum(F.when(F.col("__measure") == m, F.col("__n"))), F.lit(0)).alias(m)
        for m in measures
    ]
    return every.rollup(group).agg(*pick, F.grouping(group).cast("int").alias("is_total"))


def reconcile_tagged(tagged: DataFrame, by: Column, group: str) -> DataFrame:
    """Rows per group that came in, were loaded and were rejected, with a grand total row.

    For rows that carry their reject reason: one aggregation over one scan.
    """
    bad = F.col("_error_type").isNotNull()
    return tagged.select(by.alias(group), "_error_type").rollup(group).agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(~bad).alias("loaded_rows"),
        F.count_if(bad).alias("rejected_rows"),
        F.grouping(group).cast("int").alias("is_total"),
    )
