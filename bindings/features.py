"""Rolling statistics, outlier flags, classifications, rates and conversions."""

from pyspark.sql import functions as F

from bindings.common import (
    BUCKET_SQL, LINES_SQL, RATING_SQL, SHARE_SQL, events, lines_with_orders, lineitem, orders, table,
)
from lamina.functions import classify, dates, money
from lamina.operators.joins import lookup_join
from lamina.operators.rolling import OutlierRule, flag_outliers, rolling_stats
from lamina.settings import DELINQUENCY_BUCKETS, PROVISION_SHARES, RATINGS


def _flagged(spark, folder, rule):
    rows = events(spark, folder).select("event_id", "user_id", "event_day", "value")
    return flag_outliers(rows, "user_id", "event_day", "value", rule).drop("rolling_avg", "rolling_std")


def suspicious_flag(spark, folder):
    return _flagged(spark, folder, OutlierRule())


def suspicious_flag_history(spark, folder):
    return _flagged(spark, folder, OutlierRule(frame="history"))


def suspicious_flag_excluding(spark, folder):
    return _flagged(spark, folder, OutlierRule(exclude_current=True))


def _rolling(spark, folder):
    rows = orders(spark, folder).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return rolling_stats(rows, "o_custkey", "o_orderdate", "o_totalprice", 90)


def rolling_avg(spark, folder):
    return _rolling(spark, folder).select(
        "o_orderkey", "o_custkey", "o_orderdate", F.round("rolling_avg", 4).alias("avg_90d")
    )


def rolling_std(spark, folder):
    return _rolling(spark, folder).select(
        "o_orderkey", "o_custkey", "o_orderdate", F.round("rolling_std", 4).alias("std_90d")
    )


def _drifted(rows, key, day, value):
    """Whole numbers, a thousand million higher on all days of a key but its first."""
    first = rows.groupBy(key).agg(F.min(day).alias("first_day"))
    moved = lookup_join(rows, first, [key], "left")
    later = F.when(F.col(day) > F.col("first_day"), 1_000_000_000).otherwise(0)
    return moved.withColumn(value, F.floor(value) + later).drop("first_day")


def rolling_std_drift(spark, folder):
    """Deviations of values whose level has moved far beyond them."""
    rows = orders(spark, folder).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    rows = _drifted(rows, "o_custkey", "o_orderdate", "o_totalprice")
    found = rolling_stats(rows, "o_custkey", "o_orderdate", "o_totalprice", 90)
    return found.select("o_orderkey", "o_custkey", "o_orderdate", F.round("rolling_std", 1).alias("std_90d"))


def suspicious_flag_drift(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "event_day", (F.col("value") * 100).alias("value"))
    rows = _drifted(rows, "user_id", "event_day", "value")
    return flag_outliers(rows, "user_id", "event_day", "value", OutlierRule()).drop("rolling_avg", "rolling_std")


def business_hours(spark, folder):
    clock = events(spark, folder).select("event_id", F.date_format("ts", "HH:mm:ss").alias("clock"))
    return clock.withColumn("hours", dates.hours_flag(dates.hour_of("clock"), 7, 18))


def delinquency_bucket(spark, folder):
    return lines_with_orders(spark, folder).select(
        "l_orderkey", "l_linenumber", "days",
        classify.by_range("days", DELINQUENCY_BUCKETS, "Desconocido").alias("bucket"),
    )


def regulatory_rating(spark, folder):
    return lines_with_orders(spark, folder).select(
        "l_orderkey", "l_linenumber", "days",
        classify.by_range("days", RATINGS, "E").alias("rating"),
        classify.by_range("days", PROVISION_SHARES, 1.0).alias("share"),
    )


def provision(spark, folder):
    share = classify.by_range("days", PROVISION_SHARES, 1.0)
    return lines_with_orders(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        money.provision("l_extendedprice", share).cast("double").alias("provision"),
    )


def rating_agreement(spark, folder):
    days = F.col("days")
    graded = (
        F.when(days == 0, "A").when(days <= 30, "B").when(days <= 60, "C").when(days <= 90, "D")
    ).otherwise("E")
    return (
        lines_with_orders(spark, folder)
        .groupBy(classify.by_range("days", RATINGS, "E").alias("rating"), graded.alias("grade"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fx_convert(spark, folder):
    return orders(spark, folder).select(
        "o_orderkey", money.convert("o_totalprice", 0.000245).cast("double").alias("price_usd")
    )


# Rates of the regions' currencies; EUROPE has none.
REGION_RATES = {"AFRICA": 0.058, "AMERICA": 0.267, "ASIA": 0.00106, "MIDDLE EAST": 0.00114}


def _order_regions(spark, folder):
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    region = table(spark, folder, "region").select("r_regionkey", "r_name")
    placed = lookup_join(customer, nation, ["n_nationkey"], "left")
    placed = lookup_join(placed, region, ["r_regionkey"], "left").select("o_custkey", "r_name")
    return lookup_join(orders(spark, folder), placed, ["o_custkey"], "left")


def fx_convert_multi(spark, folder):
    converted = money.convert_by_code("o_totalprice", "r_name", REGION_RATES)
    return _order_regions(spark, folder).select(
        "o_orderkey", "r_name", converted.cast("double").alias("price_usd"),
        F.when(converted.isNull(), F.lit("missing_rate")).alias("_error_type"),
    )


def rate_equivalent(spark, folder):
    rates = lineitem(spark, folder).select("l_tax").distinct()
    return rates.select("l_tax", money.periodic_rate("l_tax").alias("monthly_rate"))


FAMILIES = {"Crédito": ("ECONOMY", "STANDARD"), "Ahorro": ("PROMO",)}


def product_family(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", "p_type", classify.by_set("p_type", FAMILIES, "Transaccional").alias("family")
    )


QUERIES = {
    "suspicious_flag": suspicious_flag,
    "suspicious_flag_history": suspicious_flag_history,
    "suspicious_flag_excluding": suspicious_flag_excluding,
    "rolling_avg": rolling_avg,
    "rolling_std": rolling_std,
    "rolling_std_drift": rolling_std_drift,
    "suspicious_flag_drift": suspicious_flag_drift,
    "business_hours": business_hours,
    "delinquency_bucket": delinquency_bucket,
    "regulatory_rating": regulatory_rating,
    "provision": provision,
    "rating_agreement": rating_agreement,
    "fx_convert": fx_convert,
    "fx_convert_multi": fx_convert_multi,
    "rate_equivalent": rate_equivalent,
    "product_family": product_family,
}

_EVENTS_SQL = "e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS event_day, value FROM events)"


def _flag_sql(frame: str) -> str:
    return f"""
        WITH {_EVENTS_SQL}, s AS (
            SELECT *, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd
            FROM e WINDOW w AS ({frame}))
        SELECT event_id, user_id, event_day, value,
               CAST(CASE WHEN sd > 0 AND value > m + 3 * sd THEN 1 ELSE 0 END AS INTEGER) AS is_outlier
        FROM s"""


_30D = "PARTITION BY user_id ORDER BY event_day RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW"


def _drift_sql(value: str, key: str, day: str) -> str:
    later = f"CASE WHEN {day} > min({day}) OVER (PARTITION BY {key}) THEN 1000000000 ELSE 0 END"
    return f"CAST(floor({value}) AS HUGEINT) + {later}"


def _rolling_sql(aggregate: str, alias: str) -> str:
    return f"""
        WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
                          o_totalprice FROM orders)
        SELECT o_orderkey, o_custkey, o_orderdate, round({aggregate}(o_totalprice) OVER (
                   PARTITION BY o_custkey ORDER BY o_orderdate
                   RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW), 4) AS {alias}
        FROM o"""


ORACLE = {
    "suspicious_flag": _flag_sql(_30D),
    "suspicious_flag_history": _flag_sql("PARTITION BY user_id"),
    # The row itself leaves the frame: sums without it, then mean and sample deviation of the rest.
    "suspicious_flag_excluding": f"""
        WITH {_EVENTS_SQL}, c AS (
            SELECT *, CAST(round(value * 100) AS HUGEINT) AS cents FROM e),
        s AS (SELECT *, count(*) OVER w - 1 AS n, sum(cents) OVER w - cents AS t,
                     sum(cents * cents) OVER w - cents * cents AS q
              FROM c WINDOW w AS ({_30D})),
        d AS (SELECT *, CASE WHEN n > 0 THEN t / n END AS m,
                     CASE WHEN n > 1 THEN sqrt((n * q - t * t)::DOUBLE / n / (n - 1)) END AS sd FROM s)
        SELECT event_id, user_id, event_day, value,
               CAST(CASE WHEN sd > 0 AND cents > m + 3 * sd THEN 1 ELSE 0 END AS INTEGER) AS is_outlier
        FROM d""",
    "rolling_avg": _rolling_sql("avg", "avg_90d"),
    "rolling_std": _rolling_sql("stddev_samp", "std_90d"),
    # Sums of whole numbers are exact, whatever their level.
    "rolling_std_drift": f"""
        WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders),
        d AS (SELECT *, {_drift_sql("o_totalprice", "o_custkey", "o_orderdate")} AS x FROM o),
        s AS (SELECT *, count(*) OVER w AS n, sum(x) OVER w AS sx, sum(x * x) OVER w AS sxx FROM d
              WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate
                           RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW))
        SELECT o_orderkey, o_custkey, o_orderdate,
               CASE WHEN n > 1 THEN round(sqrt(CAST(n * sxx - sx * sx AS DOUBLE) / (n * (n - 1))), 1) END AS std_90d
        FROM s""",
    "suspicious_flag_drift": f"""
        WITH {_EVENTS_SQL},
        d AS (SELECT * REPLACE ({_drift_sql("value * 100", "user_id", "event_day")} AS value) FROM e),
        s AS (SELECT *, count(*) OVER w AS n, sum(value) OVER w AS sx, sum(value * value) OVER w AS sxx FROM d
              WINDOW w AS (PARTITION BY user_id ORDER BY event_day
                           RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW))
        SELECT event_id, user_id, event_day, CAST(value AS BIGINT) AS value,
               CAST(CASE WHEN n > 1 AND n * sxx > sx * sx AND n * value > sx
                          AND (n * value - sx) * (n * value - sx) * (n - 1) > 9 * n * (n * sxx - sx * sx)
                         THEN 1 ELSE 0 END AS INTEGER) AS is_outlier
        FROM s""",
    "business_hours": """
        SELECT event_id, strftime(ts, '%H:%M:%S') AS clock,
               CASE WHEN hour(ts) BETWEEN 7 AND 18 THEN 'HABIL' ELSE 'NO_HABIL' END AS hours
        FROM events""",
    "delinquency_bucket": f"""
        WITH {LINES_SQL} SELECT l_orderkey, l_linenumber, days, {BUCKET_SQL} AS bucket FROM lines""",
    "regulatory_rating": f"""
        WITH {LINES_SQL}
        SELECT l_orderkey, l_linenumber, days, {RATING_SQL} AS rating,
               CAST({SHARE_SQL} AS DOUBLE) AS share FROM lines""",
    "provision": f"""
        WITH {LINES_SQL}
        SELECT l_orderkey, l_linenumber, l_extendedprice,
               CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST({SHARE_SQL} AS DECIMAL(9,6)), 0)
                    AS DOUBLE) AS provision
        FROM lines""",
    "rating_agreement": f"""
        WITH {LINES_SQL}
        SELECT {RATING_SQL} AS rating,
               CASE WHEN days = 0 THEN 'A' WHEN days <= 30 THEN 'B' WHEN days <= 60 THEN 'C'
                    WHEN days <= 90 THEN 'D' ELSE 'E' END AS grade, count(*) AS n
        FROM lines GROUP BY 1, 2""",
    "fx_convert": """
        SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.000245 AS DECIMAL(9,6)), 2)
                                AS DOUBLE) AS price_usd FROM orders""",
    "fx_convert_multi": """
        SELECT o_orderkey, r_name,
               CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(CASE r_name
                   WHEN 'AFRICA' THEN 0.058 WHEN 'AMERICA' THEN 0.267 WHEN 'ASIA' THEN 0.00106
                   WHEN 'MIDDLE EAST' THEN 0.00114 END AS DECIMAL(9,6)), 2) AS DOUBLE) AS price_usd,
               CASE WHEN r_name NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'MIDDLE EAST')
                    THEN 'missing_rate' END AS _error_type
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
                    JOIN region ON r_regionkey = n_regionkey""",
    "rate_equivalent": """
        SELECT DISTINCT l_tax, round(pow(1 + l_tax, 1.0 / 12) - 1, 6) AS monthly_rate FROM lineitem""",
    "product_family": """
        SELECT p_partkey, p_type, CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'Crédito'
               WHEN p_type = 'PROMO' THEN 'Ahorro' ELSE 'Transaccional' END AS family FROM part""",
}
