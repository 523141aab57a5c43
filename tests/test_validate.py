"""Rules, routing, null policies and referential checks."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lamina import RunContext
from lamina.functions.clean import standardize
from lamina.operators import validate
from lamina.operators.joins import SkewPolicy
from tests.support import plan, rows

CTX = RunContext("b1", datetime(2025, 1, 2, 3, 4, 5), date(2025, 1, 1))
SPLIT = SkewPolicy(broadcast_rows=0, rows_per_task=2)


@pytest.fixture()
def loans(spark):
    return spark.createDataFrame(
        [
            (1, 10, 5, 100.0, 100.0),
            (2, 10, -1, 200.0, 100.0),   # fails two rules, the first one counts
            (3, 11, 0, 101.0, 100.0),
            (4, 99, 0, 1.0, 2.0),        # no such client
            (5, None, 0, 1.0, 2.0),      # no client
            (6, 10, None, 1.0, 2.0),     # nothing to compare
            (7, 10, 0, None, 2.0),
        ],
        "id int, client int, days int, balance double, approved double",
    )


@pytest.fixture()
def clients(spark):
    return spark.createDataFrame([(10,), (11,), (11,), (None,)], "id_cli int")


def rules(clients):
    return [
        validate.at_least("days", 0, "negative_days"),
        validate.at_most_column("balance", "approved", "balance_exceeds"),
        validate.foreign_key("client", clients, "id_cli"),
    ]


@pytest.mark.parametrize("policy", [SkewPolicy(), SPLIT])
def test_first_failing_rule_wins(loans, clients, policy):
    tagged = validate.tag(loans, rules(clients), policy=policy)
    assert tagged.columns == [*loans.columns, "_error_type"]
    reasons = dict(rows(tagged.select("id", "_error_type")))
    assert reasons == {
        1: None, 2: "negative_days", 3: "balance_exceeds", 4: "referential_integrity_fail",
        5: "referential_integrity_fail", 6: "null_days", 7: "null_balance",
    }


def test_nothing_is_lost_or_doubled(loans, clients):
    tagged = validate.tag(loans, rules(clients))
    assert validate.valid(tagged).count() + validate.rejected(tagged).count() == loans.count()


def test_undecided_rows_leave_under_drop(loans, clients):
    tagged = validate.tag(loans, rules(clients), null_policy="drop")
    assert [r[0] for r in rows(validate.valid(tagged).select("id"))] == [1]
    assert [r[0] for r in rows(validate.rejected(tagged).select("id"))] == [2, 3, 4, 5]
    with pytest.raises(ValueError):
        validate.tag(loans, [], null_policy="keep")


def test_date_rules(spark):
    df = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 1, 2),), (None,)], "d date")
    tagged = validate.tag(df, [validate.not_after("d", CTX.as_of)])
    assert rows(tagged) == [
        (None, "null_d"), (date(2025, 1, 1), None), (date(2025, 1, 2), "future_date")]


def test_source_constraints(spark):
    df = spark.createDataFrame(
        [("CC", "1", 150, 1.0), ("CC", "1", None, 1.0), ("XX", "2", 400, 1.0), ("CE", "3", 951, 1.0),
         ("CE", "4", 200, 0.0), ("CE", None, 200, 1.0), ("CE", None, 200, 1.0)],
        "kind string, number string, score int, amount double",
    )
    checks = [
        validate.in_set("kind", ["CC", "CE"], "kind"),
        validate.between("score", 150, 950, "score"),
        validate.positive("amount", "amount"),
        validate.unique(["kind", "number"], "twice"),
    ]
    got = [r[-1] for r in sorted(map(tuple, validate.tag(df, checks).collect()), key=repr)]
    assert sorted(got, key=repr) == sorted(
        ["twice", "twice", "kind", "score", "amount", None, None], key=repr)
    assert rows(validate.tag(df, checks)) == rows(validate.tag(df, checks, policy=SPLIT))


def test_lost_values_are_routed(spark):
    df = standardize(spark.createDataFrame([("1",), ("x",)], "a string"), {"a": "int"}, flag=True)
    tagged = validate.tag(df, [validate.castable()])
    assert tagged.columns == ["a", "_error_type"]
    assert rows(tagged) == [(1, None), (None, "invalid_type")]


def test_key_rule_and_envelope(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    bad = validate.envelope(validate.rejected(validate.tag(df, [validate.not_null("k")])), CTX, "T")
    assert rows(bad) == [(None, "null_primary_key", CTX.run_ts, "T", "b1")]


def test_rejects_of_different_tables_meet(spark):
    a = spark.createDataFrame([(1, "r")], "x int, _error_type string")
    b = spark.createDataFrame([("y", "q")], "y string, _error_type string")
    assert rows(validate.union_rejects(a, b)) == [(1, "r", None), (None, "q", "y")]


def test_empty_table(loans, clients):
    tagged = validate.tag(loans.limit(0), rules(clients))
    assert tagged.count() == 0


def test_custom_rule(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    odd = validate.satisfies("even", lambda: F.col("a") % 2 == 1, "missing")
    assert rows(validate.tag(df, [odd])) == [(1, None), (2, "even"), (None, "missing")]


def test_both_outputs_come_from_one_scan(spark, folder):
    spark.range(10).select("id", (F.col("id") - 3).alias("v")).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    tagged = validate.tag(df, [validate.at_least("v", 0, "negative"), validate.not_null("id")])
    counts = tagged.groupBy("_error_type").count()
    assert plan(counts).count("Location: InMemoryFileIndex") == 1
    assert rows(counts) == [("negative", 3), (None, 7)]
