"""Standardisation, masking, deduplication and missing values."""

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from bindings.common import CTX, GAPS_SQL, customer_gaps, events, lineitem, orders, table
from lamina.functions import classify
from lamina.functions.clean import normalize_text, standardize
from lamina.functions.mask import Mask, exposure, mask_columns
from lamina.operators import impute
from lamina.operators.dedup import drop_exact, keep_one
from lamina.operators.incremental import with_audit
from lamina.plans import silver
from lamina.plans.tables import TableSpec
from lamina.settings import from_mapping


def standardize_types(spark, folder):
    raw = events(spark, folder).select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.get_json_object("props", "$.k"))
        .alias("k"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.col("value").cast("string").alias("amount"),
    )
    typed = standardize(raw, {"k": "int", "day": "date", "amount": "decimal(18,2)"}, flag=True)
    return typed.withColumn("amount", F.col("amount").cast("double"))


def normalize_text_query(spark, folder):
    padded = table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), F.lower("p_name"), F.lit(" ")).alias("p_name"),
        F.concat(F.lit(" "), "p_brand", F.lit("  ")).alias("p_brand"),
    )
    return normalize_text(padded, upper=["p_name"], trim=["p_brand"])


def mask_sha256(spark, folder):
    policy = {"c_name": Mask(), "c_mktsegment": Mask(salt="s1"), "c_acctbal": Mask("drop")}
    return mask_columns(table(spark, folder, "customer"), policy)


def mask_scaled(spark, folder):
    amounts = orders(spark, folder).select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")
    )
    masked = mask_columns(amounts, {"o_totalprice": Mask("scale", keep_clear=False)})
    return masked.withColumn("o_totalprice_masked", F.col("o_totalprice_masked").cast("double"))


CONFIG = {
    "pipeline": {
        "silver": {
            "pii_columns": {"TB_OBLIGACIONES": ["sdo_capital"]},
            "masking_strategy": "sha256_hash",
            "null_handling": {"default": "flag", "overrides": {"c_acctbal": "impute_median"}},
        }
    }
}


def mask_amount_hash(spark, folder):
    """An amount masked by the strategy of the configuration; it stays readable for the rules."""
    amounts = orders(spark, folder).select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("sdo_capital"))
    masked = mask_columns(amounts, from_mapping(CONFIG).masks["TB_OBLIGACIONES"])
    return masked.withColumn("sdo_capital", F.col("sdo_capital").cast("double"))


def null_policy_default(spark, folder):
    """Missing values by the configuration: one column filled, all others flagged."""
    gaps = customer_gaps(spark, folder).select("c_custkey", "c_acctbal", "c_mktsegment")
    filled = silver.enriched(gaps, TableSpec("customer", "customer", "c_custkey"), from_mapping(CONFIG))
    return filled.withColumn("c_acctbal", F.round("c_acctbal", 4))


def pii_schema_check(spark, folder):
    policy = {"c_name": Mask(), "c_mktsegment": Mask(), "c_acctbal": Mask("scale", keep_clear=False)}
    raw = table(spark, folder, "customer")
    masked = mask_columns(raw, policy)
    leaky = mask_columns(raw, {"c_mktsegment": Mask()})
    return (
        exposure(masked, policy).withColumn("layer", F.lit("masked"))
        .unionByName(exposure(leaky, policy).withColumn("layer", F.lit("leaky")))
    )


def dedup_exact(spark, folder):
    second = replace(CTX, batch_id="batch002", run_ts=datetime(2024, 2, 2, 6, 30))
    lines = lineitem(spark, folder)
    again = lines.where(F.col("l_returnflag") == "R")
    both = with_audit(again, second).unionByName(with_audit(lines, CTX))
    return drop_exact(both).drop("_ingestion_timestamp", "_source_system")


def dedup_business_key(spark, folder):
    return keep_one(lineitem(spark, folder), ["l_orderkey", "l_linenumber"])


def flag_nulls(spark, folder):
    return impute.flag_nulls(customer_gaps(spark, folder), ["c_acctbal", "c_mktsegment"])


def impute_median(spark, folder):
    gaps = customer_gaps(spark, folder).select("c_custkey", "c_acctbal")
    filled = impute.handle_nulls(gaps, "flag", {"c_acctbal": "impute_median"}, ["c_acctbal"])
    return filled.withColumn("c_acctbal", F.round("c_acctbal", 4))


def impute_mode(spark, folder):
    gaps = customer_gaps(spark, folder).select("c_custkey", "c_mktsegment")
    return impute.handle_nulls(gaps, "flag", {"c_mktsegment": "impute_mode"}, ["c_mktsegment"])


def exclude_nulls(spark, folder):
    gaps = customer_gaps(spark, folder)
    return impute.handle_nulls(gaps, "flag", {"c_mktsegment": "exclude"}, ["c_acctbal", "c_mktsegment"])


SEGMENT_LABELS = {"BUILDING": "Básico", "MACHINERY": "Estándar", "FURNITURE": "Premium", "HOUSEHOLD": "Elite"}


def code_lookup(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", "c_mktsegment", classify.by_code("c_mktsegment", SEGMENT_LABELS).alias("label")
    )


def banding(spark, folder):
    sizes = table(spark, folder, "part").select("p_partkey", F.nullif("p_size", F.lit(25)).alias("size"))
    labels = ("XS", "S", "M", "L", "XL")
    return sizes.select(
        "p_partkey", "size",
        classify.by_band("size", (10, 20, 30, 40), labels).alias("band"),
        classify.by_band("size", (10, 20, 30, 40), labels, null_label="?").alias("band_known"),
    )


QUERIES = {
    "standardize_types": standardize_types,
    "normalize_text": normalize_text_query,
    "mask_sha256": mask_sha256,
    "mask_scaled": mask_scaled,
    "mask_amount_hash": mask_amount_hash,
    "null_policy_default": null_policy_default,
    "pii_schema_check": pii_schema_check,
    "dedup_exact": dedup_exact,
    "dedup_business_key": dedup_business_key,
    "flag_nulls": flag_nulls,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "exclude_nulls": exclude_nulls,
    "code_lookup": code_lookup,
    "banding": banding,
}

ORACLE = {
    "standardize_types": """
        WITH raw AS (
            SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a'
                                  ELSE json_extract_string(props, '$.k') END AS k,
                   CAST(ts AS DATE) AS day, value AS amount FROM events)
        SELECT event_id, TRY_CAST(k AS INTEGER) AS k, day, amount,
               CASE WHEN k IS NOT NULL AND TRY_CAST(k AS INTEGER) IS NULL THEN 'k' END AS _cast_error
        FROM raw""",
    "normalize_text": """
        SELECT p_partkey, upper(trim('  ' || lower(p_name) || ' ')) AS p_name,
               trim(' ' || p_brand || '  ') AS p_brand FROM part""",
    "mask_sha256": """
        SELECT c_custkey, c_nationkey, sha256(c_name) AS c_name_hash,
               sha256('s1' || c_mktsegment) AS c_mktsegment_hash FROM customer""",
    "mask_scaled": """
        SELECT o_orderkey,
               CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 0.000001, 2) AS DOUBLE)
                   AS o_totalprice_masked
        FROM orders""",
    "mask_amount_hash": """
        SELECT o_orderkey, o_totalprice AS sdo_capital,
               sha256(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)) AS sdo_capital_hash FROM orders""",
    "null_policy_default": f"""
        WITH {GAPS_SQL}
        SELECT c_custkey, round(coalesce(c_acctbal, (SELECT median(c_acctbal) FROM gaps)), 4) AS c_acctbal,
               c_mktsegment, CAST(c_acctbal IS NULL AS INTEGER) AS is_null_c_acctbal,
               CAST(c_mktsegment IS NULL AS INTEGER) AS is_null_c_mktsegment FROM gaps""",
    "pii_schema_check": """
        WITH n AS (SELECT count(*) AS checked_rows, count(c_name) AS names,
                          count(c_acctbal) AS balances FROM customer)
        SELECT 'c_name' AS column_name, 0 AS is_clear, 0::BIGINT AS clear_values, checked_rows,
               'masked' AS layer FROM n
        UNION ALL SELECT 'c_mktsegment', 0, 0, checked_rows, 'masked' FROM n
        UNION ALL SELECT 'c_acctbal', 0, 0, checked_rows, 'masked' FROM n
        UNION ALL SELECT 'c_name', 1, names, checked_rows, 'leaky' FROM n
        UNION ALL SELECT 'c_mktsegment', 0, 0, checked_rows, 'leaky' FROM n
        UNION ALL SELECT 'c_acctbal', 1, balances, checked_rows, 'leaky' FROM n""",
    "dedup_exact": """
        SELECT DISTINCT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate), 'batch001' AS _batch_id,
               2024 AS ingestion_year, 2 AS ingestion_month, 1 AS ingestion_day
        FROM lineitem""",
    "dedup_business_key": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate),
                   row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                       ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                                l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
            FROM lineitem) WHERE rn = 1""",
    "flag_nulls": f"""
        WITH {GAPS_SQL}
        SELECT *, CAST(c_acctbal IS NULL AS INTEGER) AS is_null_c_acctbal,
               CAST(c_mktsegment IS NULL AS INTEGER) AS is_null_c_mktsegment FROM gaps""",
    "impute_median": f"""
        WITH {GAPS_SQL}
        SELECT c_custkey, round(coalesce(c_acctbal, (SELECT median(c_acctbal) FROM gaps)), 4) AS c_acctbal,
               CAST(c_acctbal IS NULL AS INTEGER) AS is_null_c_acctbal FROM gaps""",
    "impute_mode": f"""
        WITH {GAPS_SQL}, top AS (
            SELECT c_mktsegment FROM gaps WHERE c_mktsegment IS NOT NULL
            GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT c_custkey, coalesce(c_mktsegment, (SELECT c_mktsegment FROM top)) AS c_mktsegment,
               CAST(c_mktsegment IS NULL AS INTEGER) AS is_null_c_mktsegment FROM gaps""",
    "exclude_nulls": f"""
        WITH {GAPS_SQL}
        SELECT *, CAST(c_acctbal IS NULL AS INTEGER) AS is_null_c_acctbal
        FROM gaps WHERE c_mktsegment IS NOT NULL""",
    "code_lookup": """
        SELECT c_custkey, c_mktsegment,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Básico' WHEN 'MACHINERY' THEN 'Estándar'
                   WHEN 'FURNITURE' THEN 'Premium' WHEN 'HOUSEHOLD' THEN 'Elite' END AS label
        FROM customer""",
    "banding": """
        SELECT p_partkey, nullif(p_size, 25) AS size,
               CASE WHEN size < 10 THEN 'XS' WHEN size < 20 THEN 'S' WHEN size < 30 THEN 'M'
                    WHEN size < 40 THEN 'L' ELSE 'XL' END AS band,
               CASE WHEN size IS NULL THEN '?' ELSE band END AS band_known
        FROM part""",
}
