"""Lookup joins: the same rows whichever way they are carried out, and evenly spread work."""

import pytest
from pyspark.sql import functions as F

from lamina.operators.joins import SkewPolicy, frequent_values, hot_groups, lookup_join
from tests.support import plan, rows

# Nothing is broadcast, and a key with more than 500 rows is split.
SPLIT = SkewPolicy(broadcast_rows=0, rows_per_task=500)


@pytest.fixture()
def skewed(spark):
    """A third of the rows has key 7, a third none at all."""
    ids = spark.range(0, 9000, 1, 8)
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") % 50)
    return ids.select("id", key.cast("long").alias("k"))


@pytest.fixture()
def lookup(spark):
    return spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("policy", [SkewPolicy(), SPLIT, SkewPolicy(broadcast_rows=0)])
def test_same_rows_as_a_plain_join(skewed, lookup, how, policy):
    expected = skewed.join(lookup, ["k"], how)
    actual = lookup_join(skewed, lookup, ["k"], how, policy)
    added = ["v"] if how in ("inner", "left") else []
    assert actual.columns == [*skewed.columns, *added]
    assert rows(actual.select(*expected.columns)) == rows(expected)


def test_repeated_lookup_keys_still_multiply(skewed, lookup):
    twice = lookup.unionByName(lookup)
    expected = skewed.join(twice, ["k"], "left")
    actual = lookup_join(skewed, twice, ["k"], "left", SPLIT)
    assert rows(actual.select(*expected.columns)) == rows(expected)


def test_two_column_key(skewed, lookup):
    left = skewed.withColumn("k2", F.col("k") % 2)
    right = lookup.withColumn("k2", F.col("k") % 2)
    expected = left.join(right, ["k", "k2"], "left")
    actual = lookup_join(left, right, ["k", "k2"], "left", SPLIT)
    assert rows(actual.select(*expected.columns)) == rows(expected)


def test_hot_keys_may_come_from_elsewhere(skewed, lookup):
    """Whatever is taken for hot, the rows are the same."""
    expected = rows(lookup_join(skewed, lookup, ["k"], "left"))
    other = skewed.where("k = 3 OR k IS NULL").unionByName(skewed.where("k = 3"))
    policy = SkewPolicy(broadcast_rows=0, rows_per_task=5)
    assert rows(lookup_join(skewed, lookup, ["k"], "left", policy, skew_of=other)) == expected
    counts = skewed.groupBy("k").count()
    assert rows(lookup_join(skewed, lookup, ["k"], "left", policy, counted=(counts, "count"))) == expected


def test_hot_groups_are_few_and_sized(skewed):
    hot = hot_groups(skewed, ["k"], SPLIT)
    assert [(r["k"], r["__salts"]) for r in hot.collect()] == [(7, 7)]
    assert hot_groups(skewed, ["k"], SkewPolicy()) is None


def test_every_hot_key_is_listed(skewed):
    tight = SkewPolicy(broadcast_rows=0, rows_per_task=10)
    expected = skewed.dropna(subset=["k"]).groupBy("k").count().where("count > 10").count()
    assert hot_groups(skewed, ["k"], tight).count() == expected > 3


def test_wide_lookups_are_not_broadcast(skewed, lookup):
    wide = lookup.withColumn("text", F.repeat(F.lit("x"), 1000))
    assert "__salt" in plan(lookup_join(skewed, wide, ["k"], "left", SkewPolicy(broadcast_bytes=10_000)))


def test_salts_spread_a_key_that_is_already_in_one_partition(spark):
    left = spark.range(6000).select(F.lit(7).alias("k"), "id").repartition(4, "k")
    right = spark.createDataFrame([(7, "x")], "k int, name string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup_join(left, right, ["k"], "left", SPLIT)
        largest = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert largest < 3000


def test_no_task_holds_a_hot_key_alone(spark, skewed, lookup):
    """Rows per task after the shuffle, with adaptive merging off so that tasks stay visible."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def largest(df):
            per_task = df.groupBy(F.spark_partition_id().alias("p")).count()
            return per_task.agg(F.max("count")).first()[0]

        plain = largest(skewed.join(lookup, ["k"], "left"))
        split = largest(lookup_join(skewed, lookup, ["k"], "left", SPLIT))
        # Rows without a key are spread even where no key is hot.
        keyless = skewed.where("k IS NULL")
        spread = largest(lookup_join(keyless, lookup, ["k"], "left", SkewPolicy(broadcast_rows=0)))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plain >= 3000
    assert split < plain / 1.5
    assert spread < keyless.count() / 2


def test_small_lookup_is_broadcast_and_large_one_is_not(skewed, lookup):
    assert "BroadcastHashJoin" in plan(lookup_join(skewed, lookup, ["k"], "left"))
    text = plan(lookup_join(skewed, lookup, ["k"], "left", SPLIT))
    assert "__salt" in text


def test_spread_by_few_columns_prunes_the_others(spark, skewed, lookup, tmp_path):
    skewed.withColumn("wide", F.col("id") * 3).write.parquet(f"{tmp_path}/facts")
    facts = spark.read.parquet(f"{tmp_path}/facts")
    joined = lookup_join(facts, lookup, ["k"], "left", SPLIT, spread_by=["id"])
    assert rows(joined) == rows(facts.join(lookup, ["k"], "left").select("id", "k", "wide", "v"))
    assert "wide" not in plan(joined.select("k", "v"))
    assert "wide" in plan(lookup_join(facts, lookup, ["k"], "left", SPLIT).select("k", "v"))


def test_even_keys_are_neither_counted_nor_salted(skewed, lookup, monkeypatch):
    monkeypatch.setattr("lamina.operators.joins.hot_groups", None)
    policy = SkewPolicy(broadcast_rows=0)
    joined = lookup_join(skewed, lookup, ["k"], "left", policy, even=True)
    assert rows(joined) == rows(skewed.join(lookup, ["k"], "left").select("id", "k", "v"))
    assert "__salt" not in plan(joined)


def test_right_joins_are_refused(skewed, lookup):
    with pytest.raises(ValueError):
        lookup_join(skewed, lookup, ["k"], "full_outer")


def test_frequent_values_are_found_by_bounded_sketches(spark):
    df = spark.range(0, 40_000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN -1 WHEN id % 50 = 1 THEN -2 ELSE id END AS k")
    exact = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    found = frequent_values(df, "k", tracked=512)
    bounds = {r.value: (r.at_least, r.at_most) for r in found.collect()}
    assert len(bounds) <= 512
    assert all(a <= exact[k] <= b for k, (a, b) in bounds.items())
    assert {k for k, n in exact.items() if n > 7 * 40_000 / 512} <= set(bounds)


def test_no_shuffle_follows_the_keys(spark):
    """What is sent to find hot keys is the same for a thousand times as many keys."""
    sent = []
    for keys in (50, 50_000):
        df = spark.range(0, 100_000, 1, 4).selectExpr(f"id % {keys} AS k")
        found = frequent_values(df, "k", tracked=64)
        text = plan(found)
        assert "approx_top_k" in text and "hashpartitioning(k" not in text
        sent.append(text.count("Exchange"))
    assert sent[0] == sent[1]
    df = spark.range(0, 100_000, 1, 4).selectExpr("IF(id % 2 = 0, -1, id) AS k")
    assert rows(hot_groups(df, ["k"], SkewPolicy(rows_per_task=40_000))) == [(-1, 2)]
    assert hot_groups(df, ["k"], SkewPolicy(rows_per_task=60_000)) is None
