"""Rules, reject routing, referential checks and source constraints."""

from pyspark.sql import functions as F

from bindings.common import (
    AS_OF, CTX, GAPS_SQL, LINES_SQL, customer_gaps, lines_with_orders, lineitem, orders, table,
)
from lamina.operators import validate
from lamina.operators.joins import lookup_join
from lamina.operators.profile import reconcile, reconcile_tagged
from lamina.operators.validate import Rule

REJECT = ["_error_type", "_source_table", "_batch_id"]


def reject_null_key(spark, folder):
    keyed = table(spark, folder, "customer").select(
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey")).alias("key"), "c_name"
    )
    return validate.rejected(validate.tag(keyed, [validate.not_null("key")]))


def reject_future_date(spark, folder):
    tagged = validate.tag(orders(spark, folder), [validate.not_after("o_orderdate", AS_OF)])
    rows = validate.envelope(validate.rejected(tagged), CTX, "orders")
    return rows.select("o_orderkey", "o_orderdate", *REJECT)


def _negative(spark, folder):
    rule = validate.at_least("c_acctbal", 0, "negative_balance")
    tagged = validate.tag(table(spark, folder, "customer"), [rule])
    rows = validate.envelope(validate.rejected(tagged), CTX, "customer")
    return rows.select("c_custkey", "c_acctbal", *REJECT)


def reject_cross_column(spark, folder):
    rule = validate.at_most_column("o_orderdate", "l_shipdate", "shipped_before_order")
    tagged = validate.tag(lines_with_orders(spark, folder), [rule])
    return validate.rejected(tagged).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "o_orderdate", "_error_type"
    )


FIRST_RULES: list[Rule] = [
    validate.at_least("c_acctbal", 0, "negative_balance"),
    validate.in_set("c_mktsegment", ["BUILDING", "MACHINERY", "FURNITURE"], "unknown_segment"),
    validate.satisfies("small_nation", lambda: F.col("c_nationkey") >= 5),
]


def reject_first_rule(spark, folder):
    tagged = validate.tag(table(spark, folder, "customer"), FIRST_RULES)
    reason = F.coalesce("_error_type", F.lit("valid")).alias("reason")
    return tagged.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def reject_null_policy(spark, folder):
    gaps = customer_gaps(spark, folder)

    def counts(policy):
        tagged = validate.tag(gaps, FIRST_RULES, null_policy=policy)
        reason = F.coalesce("_error_type", F.lit("valid")).alias("reason")
        return tagged.groupBy(F.lit(policy).alias("policy"), reason).agg(F.count(F.lit(1)).alias("n"))

    return counts("reject").unionByName(counts("drop"))


def reject_union(spark, folder):
    return validate.union_rejects(_negative(spark, folder), reject_future_date(spark, folder))


def _documents(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, folder, "labels")
    return validate.tag(documents, [validate.foreign_key("doc_id", labels, reason="no_label")])


def fk_orphans(spark, folder):
    return validate.rejected(_documents(spark, folder))


def fk_valid(spark, folder):
    return validate.valid(_documents(spark, folder))


def constraint_in_set(spark, folder):
    rule = validate.in_set("c_mktsegment", ["BUILDING", "MACHINERY", "FURNITURE"], "segment_not_listed")
    tagged = validate.tag(customer_gaps(spark, folder), [rule])
    return validate.rejected(tagged).select("c_custkey", "c_mktsegment", "_error_type")


def constraint_between(spark, folder):
    sizes = table(spark, folder, "part").select("p_partkey", F.nullif("p_size", F.lit(50)).alias("size"))
    tagged = validate.tag(sizes, [validate.between("size", 5, 45, "size_out_of_range")])
    return validate.rejected(tagged)


def constraint_unique(spark, folder):
    rule = validate.unique(["l_orderkey", "l_linenumber"], "repeated_line")
    return validate.rejected(validate.tag(lineitem(spark, folder), [rule]))


def constraint_positive(spark, folder):
    rule = validate.positive("c_acctbal", "balance_not_positive")
    tagged = validate.tag(customer_gaps(spark, folder), [rule])
    return validate.rejected(tagged).select("c_custkey", "c_acctbal", "_error_type")


def _placed_customers(spark, folder):
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    region = table(spark, folder, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    placed = lookup_join(table(spark, folder, "customer"), nation, ["c_nationkey"], "left")
    return lookup_join(placed, region, ["n_regionkey"], "left")


def reconcile_counts(spark, folder):
    """Regions over three separate tables: customers, suppliers and nations."""
    nation = table(spark, folder, "nation")
    supplier = lookup_join(
        table(spark, folder, "supplier").withColumnRenamed("s_nationkey", "n_nationkey"),
        nation.select("n_nationkey", "n_regionkey"), ["n_nationkey"], "left",
    )
    frames = {"customers": _placed_customers(spark, folder), "suppliers": supplier, "nations": nation}
    return reconcile(frames, F.col("n_regionkey"), "region", list(frames))


def reconcile_rejects(spark, folder):
    tagged = validate.tag(_placed_customers(spark, folder), FIRST_RULES)
    return reconcile_tagged(tagged, F.col("r_name"), "region")


QUERIES = {
    "reject_null_key": reject_null_key,
    "reject_future_date": reject_future_date,
    "reject_negative": _negative,
    "reject_cross_column": reject_cross_column,
    "reject_first_rule": reject_first_rule,
    "reject_null_policy": reject_null_policy,
    "reject_union": reject_union,
    "fk_orphans": fk_orphans,
    "fk_valid": fk_valid,
    "constraint_in_set": constraint_in_set,
    "constraint_between": constraint_between,
    "constraint_unique": constraint_unique,
    "constraint_positive": constraint_positive,
    "reconcile_counts": reconcile_counts,
    "reconcile_rejects": reconcile_rejects,
}

_NEGATIVE_SQL = """SELECT c_custkey, c_acctbal, 'negative_balance' AS _error_type,
               'customer' AS _source_table, 'batch001' AS _batch_id
        FROM customer WHERE c_acctbal < 0"""

_FUTURE_SQL = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
               'future_date' AS _error_type, 'orders' AS _source_table, 'batch001' AS _batch_id
        FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '2001-01-01'"""

_FIRST_SQL = """CASE WHEN c_acctbal < 0 THEN 'negative_balance'
                    WHEN c_mktsegment NOT IN ('BUILDING','MACHINERY','FURNITURE') THEN 'unknown_segment'
                    WHEN c_nationkey < 5 THEN 'small_nation' ELSE 'valid' END"""

ORACLE = {
    "reject_null_key": """
        SELECT CAST(NULL AS BIGINT) AS key, c_name, 'null_primary_key' AS _error_type
        FROM customer WHERE c_mktsegment = 'MACHINERY'""",
    "reject_future_date": _FUTURE_SQL,
    "reject_negative": _NEGATIVE_SQL,
    "reject_cross_column": f"""
        WITH {LINES_SQL}
        SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_orderdate,
               'shipped_before_order' AS _error_type FROM lines WHERE l_shipdate < o_orderdate""",
    "reject_first_rule": f"SELECT {_FIRST_SQL} AS reason, count(*) AS n FROM customer GROUP BY 1",
    "reject_null_policy": f"""
        WITH {GAPS_SQL}, r AS (
            SELECT CASE WHEN c_acctbal < 0 THEN 'negative_balance'
                        WHEN c_acctbal IS NULL THEN 'null_c_acctbal'
                        WHEN c_mktsegment NOT IN ('BUILDING','MACHINERY','FURNITURE') THEN 'unknown_segment'
                        WHEN c_mktsegment IS NULL THEN 'null_c_mktsegment'
                        WHEN c_nationkey < 5 THEN 'small_nation' ELSE 'valid' END AS reason
            FROM gaps)
        SELECT 'reject' AS policy, reason, count(*) AS n FROM r GROUP BY 2
        UNION ALL
        SELECT 'drop', reason, count(*) FROM r WHERE reason NOT LIKE 'null\\_%' ESCAPE '\\' GROUP BY 2""",
    "reject_union": f"""
        SELECT * FROM ({_NEGATIVE_SQL}) UNION ALL BY NAME SELECT * FROM ({_FUTURE_SQL})""",
    "fk_orphans": """
        SELECT doc_id, lang, source, n_chars, 'no_label' AS _error_type
        FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "fk_valid": """
        SELECT doc_id, lang, source, n_chars
        FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "constraint_in_set": f"""
        WITH {GAPS_SQL}
        SELECT c_custkey, c_mktsegment,
               CASE WHEN c_mktsegment IS NULL THEN 'null_c_mktsegment' ELSE 'segment_not_listed' END
                   AS _error_type
        FROM gaps WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN ('BUILDING','MACHINERY','FURNITURE')""",
    "constraint_between": """
        SELECT p_partkey, nullif(p_size, 50) AS size, 'size_out_of_range' AS _error_type
        FROM part WHERE p_size <> 50 AND p_size NOT BETWEEN 5 AND 45""",
    "constraint_unique": """
        SELECT * EXCLUDE (n) FROM (
            SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate), 'repeated_line' AS _error_type,
                   count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
            FROM lineitem) WHERE n > 1""",
    "constraint_positive": f"""
        WITH {GAPS_SQL}
        SELECT c_custkey, c_acctbal,
               CASE WHEN c_acctbal IS NULL THEN 'null_c_acctbal' ELSE 'balance_not_positive' END
                   AS _error_type
        FROM gaps WHERE c_acctbal IS NULL OR c_acctbal <= 0""",
    "reconcile_counts": """
        WITH c AS (
            SELECT n_regionkey AS region, 'customers' AS t FROM customer JOIN nation ON n_nationkey = c_nationkey
            UNION ALL SELECT n_regionkey, 'suppliers' FROM supplier JOIN nation ON n_nationkey = s_nationkey
            UNION ALL SELECT n_regionkey, 'nations' FROM nation)
        SELECT region, count(*) FILTER (t = 'customers') AS customers,
               count(*) FILTER (t = 'suppliers') AS suppliers, count(*) FILTER (t = 'nations') AS nations,
               CAST(GROUPING(region) AS INTEGER) AS is_total
        FROM c GROUP BY ROLLUP (region)""",
    "reconcile_rejects": f"""
        WITH r AS (
            SELECT r_name AS region, {_FIRST_SQL} AS reason
            FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
                          LEFT JOIN region ON r_regionkey = n_regionkey)
        SELECT region, count(*) AS source_rows,
               count(*) FILTER (WHERE reason = 'valid') AS loaded_rows,
               count(*) FILTER (WHERE reason <> 'valid') AS rejected_rows,
               CAST(GROUPING(region) AS INTEGER) AS is_total
        FROM r GROUP BY ROLLUP (region)""",
}
