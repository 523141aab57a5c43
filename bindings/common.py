"""What the bound queries share: table access, fixed run context, joined views."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import RunContext, tune
from lamina.operators.joins import lookup_join

AS_OF = date(2001, 1, 1)
CTX = RunContext("batch001", datetime(2024, 2, 1, 6, 30), AS_OF, "orders_system")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the order date as a date."""
    return table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with their day."""
    return table(spark, folder, "events").withColumn("event_day", F.to_date("ts"))


def lines_with_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with customer and date of their order, and the days between order and shipping."""
    o = orders(spark, folder).select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    lines = lookup_join(lineitem(spark, folder), o, ["l_orderkey"], "inner")
    return lines.withColumn("days", F.datediff("l_shipdate", "o_orderdate"))


LINES_SQL = """lines AS (
    SELECT l.* REPLACE (CAST(l.l_shipdate AS DATE) AS l_shipdate), o.o_custkey,
           CAST(o.o_orderdate AS DATE) AS o_orderdate,
           CAST(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) AS INTEGER) AS days
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)"""

BUCKET_SQL = """CASE WHEN days = 0 THEN 'Al día' WHEN days BETWEEN 1 AND 30 THEN 'Rango 1'
         WHEN days BETWEEN 31 AND 60 THEN 'Rango 2' WHEN days BETWEEN 61 AND 90 THEN 'Rango 3'
         WHEN days BETWEEN 91 AND 999999 THEN 'Deteriorado' ELSE 'Desconocido' END"""

RATING_SQL = """CASE WHEN days = 0 THEN 'A' WHEN days BETWEEN 1 AND 30 THEN 'B'
         WHEN days BETWEEN 31 AND 60 THEN 'C' WHEN days BETWEEN 61 AND 90 THEN 'D' ELSE 'E' END"""

SHARE_SQL = """CASE WHEN days = 0 THEN 0.01 WHEN days BETWEEN 1 AND 30 THEN 0.032
         WHEN days BETWEEN 31 AND 60 THEN 0.117 WHEN days BETWEEN 61 AND 90 THEN 0.5 ELSE 1.0 END"""


def customer_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with missing balances in one segment and missing segments in one nation."""
    return table(spark, folder, "customer").select(
        "c_custkey",
        "c_nationkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("c_mktsegment"),
    )


GAPS_SQL = """gaps AS (
    SELECT c_custkey, c_nationkey,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal,
           CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS c_mktsegment
    FROM customer)"""
