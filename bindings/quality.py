"""Profiles, checks, reports and the volume check."""

from datetime import date, datetime

from pyspark.sql import functions as F

from bindings.common import AS_OF, CTX, GAPS_SQL, customer_gaps, events, lineitem, orders, table
from bindings.model import MOVES_ONCE_SQL, OUTLIER_SQL, OUTLIER_WINDOW, staged_movements
from bindings.validation import FIRST_RULES
from lamina import RunContext
from lamina.operators import checks, profile, validate
from lamina.plans import report, silver


def null_profile(spark, folder):
    return profile.null_profile(customer_gaps(spark, folder))


def table_profile(spark, folder):
    return profile.table_profile(customer_gaps(spark, folder), "customer").unionByName(
        profile.table_profile(orders(spark, folder), "orders")
    )


def quality_report(spark, folder):
    """The metrics of cleaning the movements, one row per metric."""
    raw, staged, clean = staged_movements(spark, folder)
    reasons = ("null_primary_key", "future_date", "referential_integrity_fail")
    measured = silver.metrics(raw, staged, clean, reasons)
    return profile.metric_rows("movements", measured, CTX).select("table", "metric", "value", "batch_id")


def conformity_rate(spark, folder):
    raw = table(spark, folder, "customer")
    rate = profile.conformity(raw, validate.valid(validate.tag(raw, FIRST_RULES)), "customer")
    return rate.withColumn("conformity_rate", F.col("conformity_rate").cast("double"))


def conformity_gate(spark, folder):
    customer, lines = table(spark, folder, "customer"), lineitem(spark, folder)
    positive = validate.valid(validate.tag(customer, [validate.at_least("c_acctbal", 0, "negative")]))
    listed = validate.valid(validate.tag(lines, [validate.positive("l_quantity", "no_quantity")]))
    rates = profile.conformity(customer, positive, "customer").unionByName(
        profile.conformity(lines, listed, "lineitem")
    )
    return profile.conformity_gate(rates, 0.95).select(
        "table_name", F.col("conformity_rate").cast("double").alias("conformity_rate"), "status"
    )


def _check(spark, folder, wanted):
    opened = {
        "orders": lambda: orders(spark, folder),
        "lineitem": lambda: lineitem(spark, folder),
        "customer": lambda: customer_gaps(spark, folder),
        "documents": lambda: table(spark, folder, "documents"),
        "labels": lambda: table(spark, folder, "labels"),
        "absent": lambda: orders(spark, folder).where(F.lit(False)),
    }
    return checks.run_checks(spark, opened, wanted)


VOLUME = [checks.min_rows(t) for t in ("orders", "lineitem", "customer", "documents", "absent")]
COMPLETENESS = [
    checks.no_nulls("orders", "o_orderkey"),
    checks.no_nulls("customer", "c_custkey"),
    checks.no_nulls("customer", "c_mktsegment", "no_null_segments"),
]
REFERENTIAL = [
    checks.references("orders", "o_custkey", "customer", "c_custkey"),
    checks.references("lineitem", "l_orderkey", "orders", "o_orderkey"),
    checks.references("documents", "doc_id", "labels"),
]
RANGE = [
    checks.not_after("orders", "o_orderdate", AS_OF),
    checks.not_before("orders", "o_orderdate", date(1990, 1, 1)),
]
UNIQUENESS = [checks.unique_key(t, c) for t, c in (
    ("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("customer", "c_mktsegment"))]


def check_volume(spark, folder):
    return _check(spark, folder, VOLUME)


def check_completeness(spark, folder):
    return _check(spark, folder, COMPLETENESS)


def check_referential(spark, folder):
    return _check(spark, folder, REFERENTIAL)


def check_date_range(spark, folder):
    return _check(spark, folder, RANGE)


def check_uniqueness(spark, folder):
    return _check(spark, folder, UNIQUENESS)


def check_summary(spark, folder):
    every = [*VOLUME, *COMPLETENESS, *REFERENTIAL, *RANGE, *UNIQUENESS]
    return checks.summary(_check(spark, folder, every))


def _daily_log(spark, folder):
    """Each day of events as one batch of the ingest log."""
    return events(spark, folder).groupBy("event_day").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.date_format("event_day", "yyyy-MM-dd").alias("batch_id"),
        F.col("event_day").cast("timestamp").alias("run_ts"),
        "row_count",
    )


def volume_anomaly(spark, folder):
    """Days whose volume is more than a tenth off the mean of the seven days before."""
    history = report.volume_history(report.run_volumes(_daily_log(spark, folder)), 10.0)
    return history.select(
        "batch_id", "row_count", "earlier_runs",
        F.round("mean_rows", 4).alias("mean_rows"),
        F.round("deviation_pct", 4).alias("deviation_pct"), "is_anomaly",
    )


def volume_check(spark, folder):
    """The same for one day, against the last seven before it."""
    one = report.volume_check(_daily_log(spark, folder), "2024-01-15", 10.0)
    return one.select(
        "batch_id", "row_count", "earlier_runs",
        F.round("mean_rows", 4).alias("mean_rows"),
        F.round("deviation_pct", 4).alias("deviation_pct"), "is_anomaly",
    )


def run_report(spark, folder):
    """The JSON report of one day, from logs derived from the events of each day."""
    daily = events(spark, folder).withColumn("batch_id", F.date_format("event_day", "yyyy-MM-dd"))
    metrics = daily.groupBy("batch_id").agg(
        F.count_if(F.col("value") < 1).alias("rejected_small"),
        F.count_if(F.col("value") > 200).alias("rejected_large"),
        F.count(F.lit(1)).alias("silver_row_count"),
    )
    metrics = metrics.unpivot(
        ["batch_id"], ["rejected_small", "rejected_large", "silver_row_count"], "metric", "value"
    )
    verdicts = daily.groupBy("batch_id", "event_type").agg(
        F.when(F.max("value") < 100, "PASSED").otherwise("FAILED").alias("status")
    )
    ctx = RunContext("2024-01-15", datetime(2024, 1, 16), AS_OF)
    return report.run_report(_daily_log(spark, folder), metrics, verdicts, ctx, "daily").select(
        "batch_id", "report_json"
    )


QUERIES = {
    "null_profile": null_profile,
    "table_profile": table_profile,
    "quality_report": quality_report,
    "conformity_rate": conformity_rate,
    "conformity_gate": conformity_gate,
    "check_volume": check_volume,
    "check_completeness": check_completeness,
    "check_referential": check_referential,
    "check_date_range": check_date_range,
    "check_uniqueness": check_uniqueness,
    "check_summary": check_summary,
    "volume_anomaly": volume_anomaly,
    "volume_check": volume_check,
    "run_report": run_report,
}


def _profile_sql(source: str, table: str, columns: dict[str, str]) -> str:
    parts = [
        f"""SELECT '{table}' AS table_name, '{c}' AS column_name, '{t}' AS data_type,
                   count(*) AS row_count, count(*) - count({c}) AS null_count,
                   round((count(*) - count({c})) / count(*), 4) AS null_pct FROM {source}"""
        for c, t in columns.items()
    ]
    return " UNION ALL ".join(parts)


_CUSTOMER_COLUMNS = {
    "c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string",
}
_ORDER_COLUMNS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
    "o_totalprice": "double", "o_orderdate": "date", "o_orderpriority": "string",
}


def _result_sql(name: str, table: str, bad: str, source: str, unit: str, passes: str = "= 0") -> str:
    return f"""SELECT '{name}' AS check_name, '{table}' AS "table",
               CASE WHEN n {passes} THEN 'PASSED' ELSE 'FAILED' END AS status,
               n || ' {unit}' AS details, 'error' AS severity
        FROM (SELECT CAST({bad} AS BIGINT) AS n FROM {source})"""


def _repeats(col: str) -> str:
    return f"count(*) - count(DISTINCT {col}) - coalesce(max(CAST({col} IS NULL AS INTEGER)), 0)"


_VOLUME_SQL = [
    _result_sql("row_count_not_zero", t, "count(*)", t if t != "absent" else "orders WHERE false", "rows", ">= 1")
    for t in ("orders", "lineitem", "customer", "documents", "absent")
]
_COMPLETENESS_SQL = [
    _result_sql("no_null_primary_keys", "orders", "count(*) - count(o_orderkey)", "orders", "nulls in o_orderkey"),
    _result_sql("no_null_primary_keys", "customer", "count(*) - count(c_custkey)", "gaps", "nulls in c_custkey"),
    _result_sql("no_null_segments", "customer", "count(*) - count(c_mktsegment)", "gaps", "nulls in c_mktsegment"),
]
_REFERENTIAL_SQL = [
    _result_sql("referential_integrity", t, "count(*)", f"{t} WHERE {c} NOT IN (SELECT {k} FROM {p})", f"rows without {p}")
    for t, c, p, k in (
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("documents", "doc_id", "labels", "doc_id"),
    )
]
_RANGE_SQL = [
    _result_sql("valid_date_ranges", "orders", "count(*)", "orders WHERE CAST(o_orderdate AS DATE) > DATE '2001-01-01'",
                "rows with o_orderdate after 2001-01-01"),
    _result_sql("valid_date_ranges_min", "orders", "count(*)", "orders WHERE o_orderdate < DATE '1990-01-01'",
                "rows with o_orderdate before 1990-01-01"),
]
_UNIQUENESS_SQL = [
    _result_sql("no_exact_duplicates", t, _repeats(c), s, f"repeated keys in {c}")
    for t, c, s in (
        ("orders", "o_orderkey", "orders"), ("lineitem", "l_orderkey", "lineitem"),
        ("customer", "c_mktsegment", "gaps"),
    )
]


def _union(parts: list[str]) -> str:
    return f"WITH {GAPS_SQL} " + " UNION ALL ".join(parts)


_DAILY_SQL = """daily AS (
    SELECT strftime(ts, '%Y-%m-%d') AS batch_id, count(*) AS row_count FROM events GROUP BY 1)"""

_VOLUME_HISTORY_SQL = f"""
    WITH {_DAILY_SQL}, h AS (
        SELECT *, count(*) OVER w AS earlier_runs, avg(row_count) OVER w AS m FROM daily
        WINDOW w AS (ORDER BY batch_id ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    SELECT batch_id, row_count, earlier_runs, round(m, 4) AS mean_rows,
           round(abs(row_count - m) / m * 100, 4) AS deviation_pct,
           CAST(CASE WHEN earlier_runs >= 2 AND abs(row_count - m) / m * 100 > 10 THEN 1 ELSE 0 END
                AS INTEGER) AS is_anomaly
    FROM h"""

ORACLE = {
    "null_profile": f"""
        WITH {GAPS_SQL}
        SELECT * FROM (
            SELECT 'c_acctbal' AS column_name, count(*) - count(c_acctbal) AS null_count,
                   round((count(*) - count(c_acctbal)) / count(*), 4) AS null_pct FROM gaps
            UNION ALL
            SELECT 'c_mktsegment', count(*) - count(c_mktsegment),
                   round((count(*) - count(c_mktsegment)) / count(*), 4) FROM gaps)
        WHERE null_count > 0""",
    "table_profile": f"""
        WITH {GAPS_SQL} {_profile_sql("gaps", "customer", _CUSTOMER_COLUMNS)}
        UNION ALL {_profile_sql("orders", "orders", _ORDER_COLUMNS)}""",
    "quality_report": f"""
        WITH {MOVES_ONCE_SQL}, loads AS (
            SELECT count(*) AS n, count(*) FILTER (event_type = 'purchase') AS again FROM events),
        raw AS (SELECT n + again AS n FROM loads),
        flagged AS (SELECT {OUTLIER_SQL} FROM judged WHERE reason IS NULL {OUTLIER_WINDOW})
        SELECT 'movements' AS "table", metric, value::DOUBLE AS value, 'batch001' AS batch_id FROM (
            SELECT 'bronze_row_count' AS metric, n::DOUBLE AS value FROM raw
            UNION ALL SELECT 'null_pct_cod_ciudad', 1 FROM raw
            UNION ALL SELECT 'duplicates_removed', n - (SELECT count(*) FROM judged) FROM raw
            UNION ALL SELECT 'rejected_' || reason, count(*) FROM judged WHERE reason IS NOT NULL GROUP BY 1
            UNION ALL SELECT 'rejected_null_primary_key', 0 FROM raw
            UNION ALL SELECT 'silver_row_count', count(*) FROM flagged
            UNION ALL SELECT 'ind_sospechoso_flagged', sum(ind_sospechoso) FROM flagged
            UNION ALL SELECT 'conformity_rate', round((SELECT count(*) FROM flagged) / n, 4) FROM raw)""",
    "conformity_rate": """
        SELECT 'customer' AS table_name, count(*) AS raw_rows, count(*) FILTER (ok) AS clean_rows,
               round(count(*) FILTER (ok) / count(*), 4) AS conformity_rate
        FROM (SELECT c_acctbal >= 0 AND c_nationkey >= 5
                     AND c_mktsegment IN ('BUILDING','MACHINERY','FURNITURE') AS ok FROM customer)""",
    "conformity_gate": """
        SELECT table_name, rate AS conformity_rate,
               CASE WHEN rate >= 0.95 THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM (SELECT 'customer' AS table_name, round(count(*) FILTER (c_acctbal >= 0) / count(*), 4) AS rate
              FROM customer
              UNION ALL SELECT 'lineitem', round(count(*) FILTER (l_quantity > 0) / count(*), 4) FROM lineitem)""",
    "check_volume": _union(_VOLUME_SQL),
    "check_completeness": _union(_COMPLETENESS_SQL),
    "check_referential": _union(_REFERENTIAL_SQL),
    "check_date_range": _union(_RANGE_SQL),
    "check_uniqueness": _union(_UNIQUENESS_SQL),
    "check_summary": f"""
        WITH {GAPS_SQL}, r AS ({" UNION ALL ".join(
            [*_VOLUME_SQL, *_COMPLETENESS_SQL, *_REFERENTIAL_SQL, *_RANGE_SQL, *_UNIQUENESS_SQL])})
        SELECT count(*) AS total, count(*) FILTER (status = 'PASSED') AS passed,
               count(*) FILTER (status = 'FAILED') AS failed,
               CASE WHEN count(*) FILTER (status = 'FAILED') = 0 THEN 'ALL_CHECKS_PASSED'
                    ELSE 'QUALITY_WARNINGS:' || count(*) FILTER (status = 'FAILED') END AS outcome
        FROM r""",
    "volume_anomaly": _VOLUME_HISTORY_SQL,
    "volume_check": f"SELECT * FROM ({_VOLUME_HISTORY_SQL}) WHERE batch_id = '2024-01-15'",
    "run_report": """
        WITH d AS (SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'),
        v AS (SELECT max(value) < 100 AS ok FROM d GROUP BY event_type)
        SELECT '2024-01-15' AS batch_id,
               '{"pipeline":"daily","status":"SUCCESS","batch_id":"2024-01-15","timestamp":"2024-01-16 00:00:00",'
               || '"summary":{"bronze_total_rows":' || (SELECT count(*) FROM d)
               || ',"silver_rejected_records":' || (SELECT count(*) FROM d WHERE value < 1 OR value > 200)
               || ',"gold_quality_checks_passed":' || (SELECT count(*) FROM v WHERE ok)
               || ',"gold_quality_checks_failed":' || (SELECT count(*) FROM v WHERE NOT ok) || '}}'
               AS report_json""",
}
