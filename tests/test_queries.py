"""Every bound query against its SQL counterpart, run by another engine on the same files."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import bindings
from lamina.operators.joins import DEFAULT_SKEW, SkewPolicy
from tests.conftest import SMALL
from tests.support import by_name, plan, rows

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


# Python workers, and joins of every row with every row.
OUTSIDE_THE_ENGINE = (
    "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
    "BroadcastNestedLoopJoin",
)


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("key", sorted(bindings.QUERIES))
def test_query_equals_sql(spark, sql, key):
    df = entry.queries()[key](spark, SMALL)
    expected = sql.sql(entry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(expected.columns)
    declared = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == declared
    assert by_name(df.columns, df.collect()) == by_name(expected.columns, expected.fetchall())
    text = plan(df)
    for word in OUTSIDE_THE_ENGINE:
        assert word not in text


JOINING = [
    "suspicious_flag", "suspicious_flag_history", "rolling_std", "reject_cross_column", "fk_orphans",
    "fk_valid", "constraint_unique", "reconcile_counts", "upsert_by_key", "ingest_incremental",
    "fx_convert_multi", "dim_customer", "dim_geography", "silver_movements", "silver_rejects",
    "fact_portfolio", "kpi_portfolio_daily", "customer_profitability", "check_referential",
    "dedup_exact", "dedup_business_key", "stream_null_keys",
]


@pytest.mark.parametrize("key", JOINING)
def test_result_is_the_same_when_every_join_is_large_and_split(spark, sql, key):
    """The same queries as if nothing were small enough to broadcast and every key were hot."""
    for name, value in {"broadcast_rows": 0, "rows_per_task": 10}.items():
        object.__setattr__(DEFAULT_SKEW, name, value)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()[key](spark, SMALL)
        expected = sql.sql(entry.oracle_sql()[key])
        assert by_name(df.columns, df.collect()) == by_name(expected.columns, expected.fetchall())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name, value in vars(SkewPolicy()).items():
            object.__setattr__(DEFAULT_SKEW, name, value)


@pytest.mark.parametrize("key", ["dedup_exact", "dedup_business_key", "silver_movements"])
def test_whole_rows_are_never_sorted_to_be_aggregated(spark, key):
    assert "SortAggregate" not in plan(entry.queries()[key](spark, SMALL))


def test_every_query_has_sql():
    assert set(bindings.QUERIES) == set(bindings.ORACLE)
    assert set(bindings.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_flags_known_number(spark):
    flagged = entry.entry(spark).where("is_outlier = 1")
    assert flagged.count() == 10


def test_two_runs_agree(spark):
    for key in ("dim_geography", "dedup_business_key", "upsert_initial"):
        query = entry.queries()[key]
        assert rows(query(spark, SMALL)) == rows(query(spark, SMALL))
