"""Invariants on generated rows."""

from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lamina import RunContext
from lamina.functions.classify import Range, by_range
from lamina.operators import validate
from lamina.operators.dedup import drop_exact, keep_one
from lamina.operators.incremental import upsert, with_audit
from tests.support import rows

QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
CTX = RunContext("b", datetime(2025, 1, 1), date(2025, 1, 1))

small = st.one_of(st.none(), st.integers(-3, 6))
table = st.lists(st.tuples(small, small, st.one_of(st.none(), st.sampled_from("ab"))), max_size=25)
SCHEMA = "k int, v int, s string"


@QUICK
@given(data=table, parents=st.lists(small, max_size=5))
def test_every_row_is_valid_or_has_one_reason(spark, data, parents):
    df = spark.createDataFrame(data, SCHEMA)
    known = spark.createDataFrame([(p,) for p in parents], "k int")
    rules = [validate.not_null("v"), validate.at_least("v", 0, "negative"),
             validate.in_set("s", ["a"], "not_a"), validate.foreign_key("k", known)]
    tagged = validate.tag(df, rules)
    assert rows(tagged.drop("_error_type")) == rows(df)
    expected = []
    for k, v, s in data:
        if v is None:
            reason = "null_primary_key"
        elif v < 0:
            reason = "negative"
        elif s is None:
            reason = "null_s"
        elif s != "a":
            reason = "not_a"
        else:
            reason = None if k is not None and k in parents else "referential_integrity_fail"
        expected.append((k, v, s, reason))
    assert rows(tagged) == sorted(expected, key=repr)


@QUICK
@given(target=table, source=table)
def test_upsert_twice_is_upsert_once(spark, target, source):
    t = keep_one(spark.createDataFrame(target, SCHEMA), ["k"])
    s = spark.createDataFrame(source, SCHEMA)
    once = upsert(t, s, ["k"], ["v"])
    keyed = once.where("k IS NOT NULL")
    assert rows(upsert(keyed, s.where("k IS NOT NULL"), ["k"], ["v"])) == rows(keyed)
    keys = {r[0] for r in target} | {r[0] for r in source}
    assert sorted(r[0] for r in rows(keyed)) == sorted(k for k in keys if k is not None)
    loose = t.where("k IS NULL").count() + s.where("k IS NULL").count()
    assert once.where("k IS NULL").count() == loose


@QUICK
@given(data=table)
def test_one_row_per_key_and_it_is_one_of_them(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got = rows(keep_one(df, ["k"], ["v"]))
    assert len(got) == len({r[0] for r in data})
    for k, v, s in got:
        assert (k, v, s) in data
        values = [r[1] for r in data if r[0] == k and r[1] is not None]
        assert v == (min(values) if values else None)


@QUICK
@given(data=table)
def test_loading_twice_adds_nothing(spark, data):
    df = with_audit(spark.createDataFrame(data, SCHEMA), CTX)
    assert rows(drop_exact(df.unionByName(df)).select("k", "v", "s")) == sorted(set(data), key=repr)


@QUICK
@given(days=st.lists(st.one_of(st.none(), st.integers(-200, 200)), min_size=1, max_size=40))
def test_classes_follow_their_ranges(spark, days):
    ranges = [Range(0, 0, "a"), Range(1, 30, "b"), Range(31, 90, "c")]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    for day, label in df.select("d", by_range("d", ranges, "?").alias("c")).collect():
        inside = [r.value for r in ranges if day is not None and r.low <= day <= r.high]
        assert label == (inside[0] if inside else "?")


