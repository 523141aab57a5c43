"""Audited ingest, watermarks, upserts, sources and sinks."""

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from bindings.common import AS_OF, CTX, lineitem, orders, table
from lamina.functions import dates
from lamina.operators import sketches
from lamina.operators.incremental import (
    after_watermark, high_watermark, upsert, watermark_frame, with_audit,
)
from lamina.plans import bronze, silver
from lamina.plans.tables import TableSpec
from lamina.runtime import scratch_dir
from lamina.settings import Settings
from lamina.sources.files import CORRUPT, read_csv, write_csv
from lamina.sources.pruning import where_days
from lamina.sources.store import TableStore
from lamina.streaming.increments import ingest_arrivals


def _scratch(spark, name):
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ingest_audit(spark, folder):
    audited = with_audit(orders(spark, folder).select("o_orderkey", "o_orderdate"), CTX)
    return audited.withColumn(
        "_ingestion_timestamp", F.date_format("_ingestion_timestamp", "yyyy-MM-dd HH:mm:ss")
    )


def watermark_max(spark, folder):
    loaded = orders(spark, folder).where(F.col("o_orderstatus") == "F")
    return watermark_frame(loaded, "o_orderdate", cap=AS_OF)


def _incremental(spark, folder, inclusive):
    source = orders(spark, folder)
    mark = high_watermark(source.where(F.col("o_orderstatus") == "F"), "o_orderdate", cap=AS_OF)
    return after_watermark(source, "o_orderdate", mark, inclusive)


def incremental_filter(spark, folder):
    return _incremental(spark, folder, inclusive=False)


def incremental_filter_inclusive(spark, folder):
    return _incremental(spark, folder, inclusive=True)


def upsert_by_key(spark, folder):
    every = orders(spark, folder)
    target = every.where(F.col("o_orderstatus") != "F")
    source = every.where(F.col("o_orderstatus") != "O").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    return upsert(target, source, ["o_orderkey"], ["o_orderdate"])


def upsert_null_keys(spark, folder):
    """Low-priority orders have no key: all of them stay, from both sides."""
    key = F.when(~F.col("o_orderpriority").startswith("5"), F.col("o_orderkey"))
    every = orders(spark, folder).withColumn("o_orderkey", key)
    target = every.where(F.col("o_orderstatus") != "F")
    source = every.where(F.col("o_orderstatus") != "O").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return upsert(target, source, ["o_orderkey"], ["o_orderdate"])


def upsert_initial(spark, folder):
    return upsert(None, orders(spark, folder), ["o_custkey"], ["o_orderdate"])


SPECS = (
    TableSpec("customer", "customer", "c_custkey"),
    TableSpec("orders", "orders", "o_orderkey", watermark="o_orderdate"),
    TableSpec("events", "events", "event_id"),
)


def run_log(spark, folder):
    """The log of a full ingest of three tables, written and read back."""
    root = _scratch(spark, "ingest")
    store, logs = TableStore(spark, f"{root}/bronze"), TableStore(spark, f"{root}/logs")
    bronze.ingest_all(SPECS, lambda name: table(spark, folder, name), store, logs, CTX)
    return logs.read_all(bronze.LOG).select("table", "row_count", "status", "mode", "batch_id")


def _two_loads(spark, folder, mode):
    root = _scratch(spark, "ingest")
    store, logs = TableStore(spark, f"{root}/bronze"), TableStore(spark, f"{root}/logs")
    spec = TableSpec("orders", "orders", "o_orderkey", watermark="o_orderdate")
    every = orders(spark, folder)
    first = every.where(F.col("o_orderdate") <= F.lit(AS_OF))
    bronze.ingest_all([spec], lambda name: first, store, logs, CTX)
    changed = every.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    later = type(CTX)("batch002", datetime(2024, 2, 2, 6, 30), AS_OF, CTX.source_system)
    bronze.ingest_all([spec], lambda name: changed, store, logs, later, mode=mode)
    return store, spec


def ingest_incremental(spark, folder):
    """An upsert run on top of a first load: the raw orders afterwards, with the batch of each row."""
    store, spec = _two_loads(spark, folder, "incremental")
    return bronze.read_raw(spec, store).select("o_orderkey", "o_orderdate", "o_totalprice", "_batch_id")


def ingest_append_compact(spark, folder):
    """The same with the increment appended, and folded in by a later compaction."""
    store, spec = _two_loads(spark, folder, "append")
    bronze.compact(spec, store)
    return store.read("orders").select("o_orderkey", "o_orderdate", "o_totalprice", "_batch_id")


def stream_null_keys(spark, folder):
    """Orders that arrive in two files: those with a key replace each other, those without one all stay."""
    root = _scratch(spark, "stream")
    store = TableStore(spark, f"{root}/raw")
    spec = TableSpec("orders", "orders", "o_orderkey", watermark="o_orderdate")
    every = orders(spark, folder)
    key = F.when(~F.col("o_orderpriority").startswith("5"), F.col("o_orderkey"))
    every = every.withColumn("o_orderkey", key)
    second = every.where("o_orderstatus <> 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for name, arriving in (("first", every.where("o_orderstatus <> 'F'")), ("second", second)):
        arriving.write.parquet(f"{root}/in/{name}")
        ingest_arrivals(
            spark, f"{root}/in/*", every.schema, store, spec, CTX, f"{root}/progress", fold=False
        ).awaitTermination()
    return bronze.read_raw(spec, store).select(*every.columns)


def watermark_state(spark, folder):
    """The watermark of two loads from their notes, before and after a note is lost and the increment folded."""
    store, spec = _two_loads(spark, folder, "append")
    found = [bronze.known_watermark(spec, store, CTX)]
    bronze.compact(spec, store)
    found.append(bronze.known_watermark(spec, store, CTX))
    return spark.createDataFrame([(i, mark) for i, mark in enumerate(found)], "step int, watermark date")


def log_slots(spark, folder):
    """Batches of two-part names that differ only in where the parts end, and those of the first name."""
    store = TableStore(spark, _scratch(spark, "slots"))
    every = orders(spark, folder).select("o_orderkey", "o_orderstatus")
    store.append(every.where("o_orderstatus = 'F'"), "log", "b-x", "y")
    store.append(every.where("o_orderstatus <> 'F'"), "log", "b", "x-y")
    both = store.read_all("log").withColumn("of", F.lit("all"))
    return both.unionByName(store.read_all("log", "b").withColumn("of", F.lit("b")))


def csv_reject_bad_values(spark, folder):
    """Lines of a CSV export whose amount is no number are rejects, not rows without an amount."""
    path = _scratch(spark, "csv")
    amount = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    write_csv(orders(spark, folder).select("o_orderkey", "o_orderstatus", amount.alias("o_totalprice")), path)
    raw = read_csv(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double")
    found = silver.tagged(raw, TableSpec("orders", "orders", "o_orderkey"), None, CTX, Settings())
    return found.select("o_orderkey", "o_orderstatus", "o_totalprice", "_error_type")


def sink_partitioned(spark, folder):
    """Orders written by year and month and read back: rows and totals of each partition."""
    store = TableStore(spark, _scratch(spark, "sink"))
    dated = orders(spark, folder).withColumns(
        {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    )
    store.write(dated, "orders", ["year", "month"])
    return store.read("orders").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


def sink_clustered(spark, folder):
    """Orders written sorted by customer range and read back for one tail of the range."""
    store = TableStore(spark, _scratch(spark, "sink"))
    store.write(orders(spark, folder), "orders", cluster_by=["o_custkey"])
    return store.read("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


def sink_zordered(spark, folder):
    """Order lines clustered by part and day together, and read back by a range of either."""
    store = TableStore(spark, _scratch(spark, "sink"))
    store.write(lineitem(spark, folder), "lines", cluster_by=["l_partkey", "l_shipdate"], along_curve=True)
    lines = store.read("lines")
    by_part = lines.where("l_partkey BETWEEN 20 AND 60").withColumn("by", F.lit("part"))
    by_day = where_days(lines, "l_shipdate", date(1996, 3, 1), date(1996, 4, 30)).withColumn("by", F.lit("day"))
    return by_part.unionByName(by_day).groupBy("by", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity")
    )


def days_by_partition(spark, folder):
    """Orders stored by year and month of their day, filtered by the day alone."""
    store = TableStore(spark, _scratch(spark, "sink"))
    day = "o_orderdate"
    dated = orders(spark, folder).withColumns({f"{day}_year": F.year(day), f"{day}_month": F.month(day)})
    store.write(dated, "orders", [f"{day}_year", f"{day}_month"])
    found = where_days(store.read("orders"), day, date(1996, 11, 30), date(1997, 2, 1))
    recent = dates.since_cutoff(store.read("orders"), day, dates.trailing_cutoff(store.read("orders"), day, 3))
    return found.select("o_orderkey", day, F.lit("days").alias("by")).unionByName(
        recent.select("o_orderkey", day, F.lit("recent").alias("by"))
    )


def distinct_sketch(spark, folder):
    """Customers per order status and year from daily sketches stored month by month, beside the exact numbers."""
    store = TableStore(spark, _scratch(spark, "sketches"))
    every = orders(spark, folder)
    daily = sketches.distinct_sketches(every, ["o_orderstatus", "o_orderdate"], "o_custkey")
    for half in (0, 1):
        store.append(daily.where((F.quarter("o_orderdate") > 2).cast("int") == half), "daily", f"half{half}")
    year = F.year("o_orderdate").alias("year")
    stored = store.read_all("daily").withColumn("year", year)
    found = sketches.merged(stored, ["o_orderstatus", "year"]).withColumn("estimated", sketches.estimate())
    exact = every.groupBy("o_orderstatus", year).agg(F.count_distinct("o_custkey").alias("customers"))
    return exact.join(found, ["o_orderstatus", "year"], "left").select(
        "o_orderstatus", "year", "customers", sketches.within(F.col("estimated"), F.col("customers")).alias("within_bound")
    )


def source_csv_roundtrip(spark, folder):
    path = _scratch(spark, "csv")
    write_csv(orders(spark, folder), path)
    schema = (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate date, o_orderpriority string"
    )
    return read_csv(spark, path, schema).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


SURFACE_SQL = """
    SELECT c_mktsegment, o_orderstatus, COUNT(*) AS n, COUNT(DISTINCT o_custkey) AS customers
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey
    WHERE o_orderpriority LIKE '%URGENT%' OR o_orderstatus = 'F'
    GROUP BY c_mktsegment, o_orderstatus"""


def sql_surface(spark, folder):
    """Stored tables registered as views and queried by SQL text."""
    store = TableStore(spark, _scratch(spark, "sql"))
    for name in ("orders", "customer"):
        store.write(table(spark, folder, name), f"stored_{name}")
    store.register("stored_orders", "stored_customer")
    return spark.sql(SURFACE_SQL.format(orders="stored_orders", customer="stored_customer"))


QUERIES = {
    "ingest_audit": ingest_audit,
    "watermark_max": watermark_max,
    "incremental_filter": incremental_filter,
    "incremental_filter_inclusive": incremental_filter_inclusive,
    "upsert_by_key": upsert_by_key,
    "upsert_null_keys": upsert_null_keys,
    "upsert_initial": upsert_initial,
    "run_log": run_log,
    "ingest_incremental": ingest_incremental,
    "ingest_append_compact": ingest_append_compact,
    "stream_null_keys": stream_null_keys,
    "watermark_state": watermark_state,
    "log_slots": log_slots,
    "csv_reject_bad_values": csv_reject_bad_values,
    "sink_partitioned": sink_partitioned,
    "sink_clustered": sink_clustered,
    "sink_zordered": sink_zordered,
    "days_by_partition": days_by_partition,
    "distinct_sketch": distinct_sketch,
    "source_csv_roundtrip": source_csv_roundtrip,
    "sql_surface": sql_surface,
}

_ORDERS_SQL = "o AS (SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders)"
_MARK_SQL = "(SELECT max(o_orderdate) FROM o WHERE o_orderstatus = 'F' AND o_orderdate <= DATE '2001-01-01')"

_TWO_LOADS_SQL = f"""
        WITH {_ORDERS_SQL}, m AS (
            SELECT max(o_orderdate) AS mark FROM o WHERE o_orderdate <= DATE '2001-01-01')
        SELECT o_orderkey, o_orderdate,
               CASE WHEN o_orderdate >= mark THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               CASE WHEN o_orderdate >= mark THEN 'batch002' ELSE 'batch001' END AS _batch_id
        FROM o, m"""

ORACLE = {
    "ingest_audit": f"""
        WITH {_ORDERS_SQL}
        SELECT o_orderkey, o_orderdate, '2024-02-01 06:30:00' AS _ingestion_timestamp,
               'orders_system' AS _source_system, 'batch001' AS _batch_id,
               2024 AS ingestion_year, 2 AS ingestion_month, 1 AS ingestion_day FROM o""",
    "watermark_max": f"WITH {_ORDERS_SQL} SELECT {_MARK_SQL} AS watermark",
    "incremental_filter": f"WITH {_ORDERS_SQL} SELECT * FROM o WHERE o_orderdate > {_MARK_SQL}",
    "incremental_filter_inclusive": f"WITH {_ORDERS_SQL} SELECT * FROM o WHERE o_orderdate >= {_MARK_SQL}",
    "upsert_by_key": f"""
        WITH {_ORDERS_SQL}
        SELECT * REPLACE (CASE WHEN o_orderstatus <> 'O' THEN o_totalprice + 1 ELSE o_totalprice END
                          AS o_totalprice) FROM o""",
    "upsert_null_keys": f"""
        WITH {_ORDERS_SQL},
        k AS (SELECT * REPLACE (CASE WHEN o_orderpriority NOT LIKE '5%' THEN o_orderkey END AS o_orderkey) FROM o)
        SELECT * REPLACE (CASE WHEN o_orderstatus <> 'O' THEN o_totalprice + 1 ELSE o_totalprice END
                          AS o_totalprice) FROM k WHERE o_orderkey IS NOT NULL
        UNION ALL SELECT * FROM k WHERE o_orderkey IS NULL AND o_orderstatus <> 'F'
        UNION ALL SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM k
        WHERE o_orderkey IS NULL AND o_orderstatus <> 'O'""",
    "stream_null_keys": f"""
        WITH {_ORDERS_SQL},
        k AS (SELECT * REPLACE (CASE WHEN o_orderpriority NOT LIKE '5%' THEN o_orderkey END AS o_orderkey) FROM o)
        SELECT * REPLACE (CASE WHEN o_orderstatus <> 'O' THEN o_totalprice + 1 ELSE o_totalprice END
                          AS o_totalprice) FROM k WHERE o_orderkey IS NOT NULL
        UNION ALL SELECT * FROM k WHERE o_orderkey IS NULL AND o_orderstatus <> 'F'
        UNION ALL SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM k
        WHERE o_orderkey IS NULL AND o_orderstatus <> 'O'""",
    "watermark_state": f"""
        WITH {_ORDERS_SQL}, m AS (SELECT max(o_orderdate) AS watermark FROM o WHERE o_orderdate <= DATE '2001-01-01')
        SELECT CAST(0 AS INTEGER) AS step, watermark FROM m UNION ALL SELECT 1, watermark FROM m""",
    "upsert_initial": f"""
        WITH {_ORDERS_SQL}
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
                       o_orderkey DESC, o_orderstatus DESC, o_totalprice DESC, o_orderpriority DESC) AS rn
            FROM o) WHERE rn = 1""",
    "run_log": """
        SELECT 'customer' AS "table", count(*) AS row_count, 'SUCCESS' AS status, 'full' AS mode,
               'batch001' AS batch_id FROM customer
        UNION ALL SELECT 'orders', count(*), 'SUCCESS', 'full', 'batch001' FROM orders
        UNION ALL SELECT 'events', count(*), 'SUCCESS', 'full', 'batch001' FROM events""",
    "ingest_incremental": _TWO_LOADS_SQL,
    "ingest_append_compact": _TWO_LOADS_SQL,
    "log_slots": """
        SELECT o_orderkey, o_orderstatus, 'all' AS "of" FROM orders
        UNION ALL SELECT o_orderkey, o_orderstatus, 'b' FROM orders WHERE o_orderstatus <> 'F'""",
    "csv_reject_bad_values": """
        SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
               CASE WHEN o_orderstatus = 'P' THEN 'invalid_type' END AS _error_type FROM orders""",
    "sink_partitioned": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
               count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM orders GROUP BY 1, 2""",
    "sink_clustered": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1",
    "sink_zordered": """
        SELECT 'part' AS "by", l_returnflag, count(*) AS n,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
        FROM lineitem WHERE l_partkey BETWEEN 20 AND 60 GROUP BY l_returnflag
        UNION ALL SELECT 'day', l_returnflag, count(*), CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE)
        FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-04-30'
        GROUP BY l_returnflag""",
    "days_by_partition": f"""
        WITH {_ORDERS_SQL}
        SELECT o_orderkey, o_orderdate, 'days' AS "by" FROM o
        WHERE o_orderdate BETWEEN DATE '1996-11-30' AND DATE '1997-02-01'
        UNION ALL SELECT o_orderkey, o_orderdate, 'recent' FROM o
        WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 3 MONTH FROM o)""",
    "distinct_sketch": f"""
        WITH {_ORDERS_SQL}
        SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_custkey) AS customers,
               true AS within_bound
        FROM o GROUP BY o_orderstatus, year(o_orderdate)""",
    "source_csv_roundtrip": f"WITH {_ORDERS_SQL} SELECT * FROM o",
    "sql_surface": SURFACE_SQL.format(orders="orders", customer="customer"),
}
