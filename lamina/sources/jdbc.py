"""JDBC tables and queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Parallel read of a table in ranges of a numeric, date or timestamp column."""

    column: str
    lower: object
    upper: object
    partitions: int


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    split: Split | None = None,
) -> DataFrame:
    """A table; with ``split`` each partition reads its own range over its own connection.

    Bounds only place the ranges: rows outside them belong to the first and last partition.
    Filters and column selection on the result are pushed to the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if split:
        reader = reader.options(
            partitionColumn=split.column,
            lowerBound=str(split.lower),
            upperBound=str(split.upper),
            numPartitions=str(split.partitions),
        )
    return reader.options(**dict(options or {})).load()


def read_query(
    spark: SparkSession, url: str, query: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """The result of a query the database runs."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    return reader.options(**dict(options or {})).load()


def reader(
    spark: SparkSession,
    url: str,
    options: Mapping[str, str] | None = None,
    schema: str | None = None,
    splits: Mapping[str, Split] | None = None,
) -> Callable[[str], DataFrame]:
    """A function that opens source tables by name, large ones in ranges."""

    def read(name: str) -> DataFrame:
        table = f"{schema}.{name}" if schema else name
        return read_table(spark, url, table, options, (splits or {}).get(name))

    return read


def bounds(
    spark: SparkSession, url: str, table: str, column: str, options: Mapping[str, str] | None = None
) -> tuple:
    """Least and greatest value of a column, computed by the database, to build a ``Split``."""
    query = f"SELECT MIN({column}) AS LO, MAX({column}) AS HI FROM {table}"
    return tuple(read_query(spark, url, query, options).first())
