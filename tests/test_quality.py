"""Profiles, checks, reports and volumes on hand-written rows."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lamina import RunContext
from lamina.operators import checks, profile
from lamina.plans import report
from tests.support import plan, rows

CTX = RunContext("b3", datetime(2025, 1, 3), date(2025, 1, 1))


@pytest.fixture()
def facts(spark):
    return spark.createDataFrame(
        [(1, 10, date(2024, 5, 1)), (1, 10, date(2026, 1, 1)), (2, 99, date(2019, 1, 1)), (None, None, None)],
        "id int, client int, day date")


@pytest.fixture()
def tables(spark, facts):
    clients = spark.createDataFrame([(10,), (11,)], "client int")

    def broken():
        raise FileNotFoundError("gone")

    return {"facts": lambda: facts, "clients": lambda: clients, "broken": broken,
            "empty": lambda: facts.limit(0)}


def test_each_kind_of_check(spark, tables):
    wanted = [
        checks.min_rows("facts"), checks.no_nulls("facts", "id"), checks.unique_key("facts", "id"),
        checks.references("facts", "client", "clients"),
        checks.not_after("facts", "day", date(2025, 1, 1)),
        checks.not_before("facts", "day", date(2020, 1, 1)),
        checks.min_rows("empty"), checks.unique_key("empty", "id"), checks.min_rows("broken"),
    ]
    got = {(r["check_name"], r["table"]): (r["status"], r["details"])
           for r in checks.run_checks(spark, tables, wanted).collect()}
    assert got[("row_count_not_zero", "facts")] == ("PASSED", "4 rows")
    assert got[("no_null_primary_keys", "facts")] == ("FAILED", "1 nulls in id")
    # Two rows with id 1; the one row without id counts as one key.
    assert got[("no_exact_duplicates", "facts")] == ("FAILED", "1 repeated keys in id")
    assert got[("referential_integrity", "facts")] == ("FAILED", "2 rows without clients")
    assert got[("valid_date_ranges", "facts")][0] == "FAILED"
    assert got[("valid_date_ranges_min", "facts")] == ("FAILED", "1 rows with day before 2020-01-01")
    assert got[("row_count_not_zero", "empty")] == ("FAILED", "0 rows")
    assert got[("no_exact_duplicates", "empty")] == ("PASSED", "0 repeated keys in id")
    assert got[("row_count_not_zero", "broken")] == ("FAILED", "error: gone")


def test_table_that_breaks_while_it_is_read_does_not_stop_the_others(spark, tables, folder):
    import os

    spark.range(5).write.parquet(f"{folder}/t")
    torn = spark.read.parquet(f"{folder}/t")
    for name in os.listdir(f"{folder}/t"):
        if name.endswith(".parquet"):
            os.remove(f"{folder}/t/{name}")
    opened = {**tables, "torn": lambda: torn.where("id > 1")}
    wanted = [checks.min_rows("torn"), checks.min_rows("facts")]
    got = checks.run_checks(spark, opened, wanted, isolate=True)
    assert rows(got.select("table", "status")) == [("facts", "PASSED"), ("torn", "FAILED")]


def test_checks_of_one_table_scan_it_once(spark, folder):
    spark.range(100).write.parquet(f"{folder}/t")
    opened = {"t": lambda: spark.read.parquet(f"{folder}/t")}
    wanted = [checks.min_rows("t"), checks.no_nulls("t", "id"), checks.unique_key("t", "id")]
    text = plan(checks.run_checks(spark, opened, wanted))
    assert text.count("Location: InMemoryFileIndex") == 1


def test_summary(spark, tables):
    good = checks.run_checks(spark, tables, [checks.min_rows("facts")])
    assert checks.summary(good).first() == (1, 1, 0, "ALL_CHECKS_PASSED")
    bad = checks.run_checks(spark, tables, [checks.min_rows("facts"), checks.min_rows("empty")])
    assert checks.summary(bad).first() == (2, 1, 1, "QUALITY_WARNINGS:1")


def test_null_profile(facts):
    assert rows(profile.null_profile(facts)) == [("client", 1, 0.25), ("day", 1, 0.25), ("id", 1, 0.25)]
    assert profile.null_profile(facts.dropna()).count() == 0
    assert profile.null_profile(facts.limit(0)).count() == 0


def test_conformity(facts):
    rate = profile.conformity(facts, facts.dropna(), "facts")
    assert rate.first() == ("facts", 4, 3, 0.75)
    assert profile.conformity(facts.limit(0), facts.limit(0), "facts").first()[3] is None
    assert profile.conformity_gate(rate, 0.75).first()["status"] == "PASSED"
    assert profile.conformity_gate(rate, 0.76).first()["status"] == "FAILED"
    nothing = profile.conformity(facts.limit(0), facts.limit(0), "facts")
    assert profile.conformity_gate(nothing, 0.5).first()["status"] == "FAILED"


def test_reconcile_has_a_grand_total(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "g string, v int")
    out = profile.reconcile({"src": df, "bad": df.where("v = 3")}, F.col("g"), "g", ["src", "bad"])
    assert rows(out) == [("a", 2, 0, 0), ("b", 1, 1, 0), (None, 3, 1, 1)]


def log(spark, volumes):
    made = [(f"z{9 - i}" if i % 2 else f"a{i}", datetime(2025, 1, 1 + i), "t", v)
            for i, v in enumerate(volumes)]
    return made[-1][0], spark.createDataFrame(made, "batch_id string, run_ts timestamp, table string, row_count bigint")


@pytest.mark.parametrize("volumes, anomaly", [
    ([100], 0), ([100, 1000], 0), ([100, 100, 131], 1), ([100, 100, 130], 0),
    ([9999] + [100] * 7 + [100], 0), ([100, 100, 0], 1), ([0, 0, 5], 0),
])
def test_volume_check_looks_at_the_last_seven_runs(spark, volumes, anomaly):
    batch, frame = log(spark, volumes)
    assert report.volume_check(frame, batch, 30.0).first()["is_anomaly"] == anomaly
    history = report.volume_history(report.run_volumes(frame), 30.0)
    assert history.where(F.col("batch_id") == batch).first()["is_anomaly"] == anomaly


def test_run_report_sums_rejected_rows(spark):
    ingest = spark.createDataFrame(
        [("b3", CTX.run_ts, 5), ("b3", CTX.run_ts, 7), ("b2", CTX.run_ts, 100)],
        "batch_id string, run_ts timestamp, row_count bigint")
    metrics = spark.createDataFrame(
        [("b3", "rejected_future_date", 2.0), ("b3", "rejected_x", 3.0), ("b3", "silver_row_count", 9.0),
         ("b2", "rejected_x", 50.0)], "batch_id string, metric string, value double")
    verdicts = spark.createDataFrame(
        [("b3", "PASSED"), ("b3", "FAILED"), ("b3", "PASSED"), ("b2", "FAILED")],
        "batch_id string, status string")
    row = report.run_report(ingest, metrics, verdicts, CTX, "p").first()
    assert json.loads(row["report_json"]) == {
        "pipeline": "p", "status": "SUCCESS", "batch_id": "b3", "timestamp": "2025-01-03 00:00:00",
        "summary": {"bronze_total_rows": 12, "silver_rejected_records": 5,
                    "gold_quality_checks_passed": 2, "gold_quality_checks_failed": 1}}
    empty = report.run_report(ingest.limit(0), metrics.limit(0), verdicts.limit(0), CTX, "p").first()
    assert json.loads(empty["report_json"])["summary"]["bronze_total_rows"] == 0
