"""Stores, files, JDBC options and the streaming ingest."""

import os
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lamina import RunContext
from lamina.operators import incremental
from lamina.plans import bronze
from lamina.plans.tables import TableSpec
from lamina.runtime import materialize, scratch_dir, tune
from lamina.sources import files, jdbc
from lamina.sources.store import TableStore, merge_statement
from lamina.streaming.increments import ingest_arrivals
from tests.support import plan, rows

CTX = RunContext("b1", datetime(2025, 1, 2), date(2025, 1, 2))


def test_replaced_table_may_be_read_while_it_is_replaced(spark, folder):
    store = TableStore(spark, folder)
    assert not store.exists("t") and store.path("t") is None
    store.write(spark.range(3), "t")
    store.write(store.read("t").where("id > 0").unionByName(spark.range(7, 8)), "t")
    assert rows(store.read("t")) == [(1,), (2,), (7,)]
    store.write(store.read("t").withColumn("x", F.lit(1)), "t")
    assert store.read("t").columns == ["id", "x"]


def test_uncommitted_version_is_not_seen(spark, folder):
    store = TableStore(spark, folder)
    store.write(spark.range(3), "t")
    good = store.path("t")
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{folder}/t/version=99999999999999999999-crashed")
    assert store.path("t") == good and store.read("t").count() == 3


def test_former_versions_are_pruned(spark, folder):
    store = TableStore(spark, folder)
    for n in range(4):
        store.write(spark.range(n), "t")
    assert len(store.prune("t", keep=2)) == 2 and store.prune("t", keep=2) == []
    assert store.read("t").count() == 3
    with pytest.raises(ValueError):
        store.prune("t", keep=0)
    assert store.prune("absent") == []


def test_missing_table_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        TableStore(spark, folder).read("t")
    with pytest.raises(FileNotFoundError):
        TableStore(spark, folder).read_all("t")


def test_partitioned_sink_prunes(spark, folder):
    store = TableStore(spark, folder)
    df = spark.range(100).select("id", (F.col("id") % 5).cast("int").alias("p"))
    store.write(df, "t", ["p"])
    back = store.read("t").where("p = 3")
    assert back.count() == 20
    assert "PartitionFilters: [isnotnull(p" in plan(back)
    assert len({r[0] for r in store.read("t").select(F.input_file_name()).collect()}) == 5


def test_clustered_sink_sorts_by_range(spark, folder):
    store = TableStore(spark, folder)
    store.write(spark.range(1000).select((1000 - F.col("id")).alias("id")), "t", cluster_by=["id"])
    spans = store.read("t").groupBy(F.input_file_name()).agg(F.min("id"), F.max("id")).collect()
    spans = sorted((r[1], r[2]) for r in spans)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_appended_slot_is_replaced_when_it_is_written_again(spark, folder):
    store = TableStore(spark, folder)
    store.append(spark.range(3), "log", "b1", "x")
    store.append(spark.range(3).withColumn("more", F.lit("m")), "log", "b2", "x")
    store.append(spark.range(2), "log", "b1", "x")
    assert rows(store.read_all("log")) == [(0, "m"), (0, None), (1, "m"), (1, None), (2, "m")]


def test_slots_never_share_a_folder(spark, folder):
    store = TableStore(spark, folder)
    parts = [("b-x", "y"), ("b", "x-y"), ("b/x", "y"), ("b_x", "y"), ("b=x", "y"), ("b", "x", "y"), ("b+x", "y"), ("b%2Bx", "y")]
    for i, slot in enumerate(parts):
        store.append(spark.range(i, i + 1), "log", *slot)
    assert len(store.slots("log")) == len(parts)
    assert rows(store.read_all("log")) == [(i,) for i in range(len(parts))]


def test_rows_of_one_cluster_value_fill_several_tasks(spark, folder):
    store = TableStore(spark, folder)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(10_000).select(F.lit(1).alias("c"), "id")
        store.write(df, "hot", cluster_by=["c"])
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = store.read("hot").groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] < 5000


def test_catalog_table_follows_the_version(spark, folder):
    store = TableStore(spark, folder)
    try:
        for n in (5, 7):
            store.write(spark.range(n), "followed")
            store.create_table("followed", "followed_table")
            assert spark.table("followed_table").count() == n
    finally:
        spark.sql("DROP TABLE IF EXISTS followed_table")


def test_sql_surface(spark, folder):
    store = TableStore(spark, folder)
    store.write(spark.range(5), "numbers_view")
    store.register("numbers_view")
    assert spark.sql("SELECT count(*) FROM numbers_view").first()[0] == 5
    store.create_table("numbers_view", "numbers_table")
    try:
        assert spark.sql("SELECT sum(id) FROM numbers_table").first()[0] == 10
    finally:
        spark.sql("DROP TABLE numbers_table")


def test_csv_keeps_bad_lines(spark, folder):
    with open(f"{folder}/t.csv", "w", encoding="utf-8") as out:
        out.write("a,b\n1,ñandú\nx,two\n,\n")
    got = rows(files.read_csv(spark, f"{folder}/t.csv", "a int, b string"))
    assert got == [(1, "ñandú", None), (None, "two", "x,two"), (None, None, None)]


def test_parquet_with_and_without_schema(spark, folder):
    files.write_csv(spark.range(2), f"{folder}/c")
    spark.range(2).write.parquet(f"{folder}/p")
    assert files.read_parquet(spark, f"{folder}/p").count() == 2
    assert files.read_parquet(spark, f"{folder}/p", "id bigint, extra string").columns == ["id", "extra"]


class FakeReader:
    """Takes down what a JDBC read would be asked for; no database is started for a test."""

    def __init__(self):
        self.asked = {}
        self.read = self

    def format(self, name):
        self.asked["format"] = name
        return self

    def option(self, key, value):
        self.asked[key] = value
        return self

    def options(self, **more):
        self.asked.update(more)
        return self

    def load(self):
        return self.asked


def test_jdbc_reads_in_ranges():
    asked = jdbc.read_table(
        FakeReader(), "jdbc:x", "dbo.T", {"user": "u"}, jdbc.Split("id", 1, 1000, 16))
    assert asked == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "dbo.T", "partitionColumn": "id",
        "lowerBound": "1", "upperBound": "1000", "numPartitions": "16", "user": "u",
    }
    read = jdbc.reader(FakeReader(), "jdbc:x", schema="dbo", splits={"T": jdbc.Split("id", 1, 9, 2)})
    assert read("T")["dbtable"] == "dbo.T" and read("T")["numPartitions"] == "2"
    assert jdbc.read_query(FakeReader(), "jdbc:x", "SELECT 1 AS test")["query"] == "SELECT 1 AS test"


def test_merge_statement():
    assert merge_statement("delta.`/x/t`", "v", ["a", "b"]) == (
        "MERGE INTO delta.`/x/t` t USING v s ON t.`a` = s.`a` AND t.`b` = s.`b` "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    kept = materialize(df, "numbers")
    assert f"{scratch_dir(spark)}/" in kept.inputFiles()[0]
    assert rows(kept) == rows(df)
    assert "ReadSchema: struct<x:bigint>" in plan(kept.select("x"))


class FakeSession:
    """A session on a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        applicationId = "app"
        getCheckpointDir = staticmethod(lambda: None)


def test_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession)
    FakeSession.sparkContext.getCheckpointDir = staticmethod(lambda: "hdfs:/checkpoints/")
    assert scratch_dir(FakeSession) == "hdfs:/checkpoints"


def test_settings_given_by_the_user_win(spark):
    tune(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


SPEC = TableSpec("t", "t", "k")


def arrive(spark, folder, rows_, name, schema="k int, o int, v string"):
    spark.createDataFrame(rows_, schema).coalesce(1).write.parquet(f"{folder}/in/{name}")


def stream(spark, folder, store, ctx=CTX, **more):
    schema = "k int, o int, v string"
    ingest_arrivals(spark, f"{folder}/in/*", schema, store, SPEC, ctx, f"{folder}/progress", **more).awaitTermination()
    return rows(bronze.read_raw(SPEC, store).select("k", "o", "v"))


@pytest.mark.parametrize("fold", [False, True])
def test_streaming_ingest_upserts_arrivals(spark, folder, fold):
    store = TableStore(spark, f"{folder}/raw")
    arrive(spark, folder, [(1, 1, "a"), (2, 2, "bb"), (None, 0, "n")], "first")
    assert stream(spark, folder, store, fold=fold) == [(1, 1, "a"), (2, 2, "bb"), (None, 0, "n")]
    arrive(spark, folder, [(2, 1, "B"), (3, 1, "c"), (None, 0, "n")], "second")
    # Of one key the row of the later epoch counts, whatever its content; rows without a key all stay.
    expected = [(1, 1, "a"), (2, 1, "B"), (3, 1, "c"), (None, 0, "n"), (None, 0, "n")]
    assert stream(spark, folder, store, fold=fold) == expected
    assert stream(spark, folder, store, fold=fold) == expected
    bronze.compact(SPEC, store)
    assert rows(store.read("t").select("k", "o", "v")) == expected


def test_epochs_are_increments_and_the_version_stays(spark, folder):
    store = TableStore(spark, f"{folder}/raw")
    store.write(bronze.with_audit(spark.createDataFrame([(1, 0, "old"), (None, 9, "base")], "k int, o int, v string"), CTX), "t")
    version = store.path("t")
    for n in range(3):
        arrive(spark, folder, [(n, n, "x"), (None, n, "y")], f"part{n}")
        stream(spark, folder, store, fold=False)
    assert store.path("t") == version and len(store.slots(bronze.increments(SPEC, store))) == 3
    # A full load and increments may share a batch id: nothing of the load without a key is replaced.
    expected = [(0, 0, "x"), (1, 1, "x"), (2, 2, "x"), (None, 0, "y"), (None, 1, "y"), (None, 2, "y"), (None, 9, "base")]
    assert rows(bronze.read_raw(SPEC, store).select("k", "o", "v")) == expected


@pytest.mark.parametrize("folded", [False, True])
def test_a_repeated_epoch_replaces_its_own_rows(spark, folder, folded):
    """An epoch whose rows were written but not committed by the stream comes once more, in a later run."""
    store = TableStore(spark, f"{folder}/raw")
    arrive(spark, folder, [(1, 1, "a"), (None, 1, "n")], "first")
    stream(spark, folder, store, fold=False)
    arrive(spark, folder, [(1, 2, "b"), (None, 2, "m")], "second")
    expected = stream(spark, folder, store, fold=False)
    if folded:
        bronze.compact(SPEC, store)
    os.remove(f"{folder}/progress/commits/1")
    os.path.exists(f"{folder}/progress/commits/.1.crc") and os.remove(f"{folder}/progress/commits/.1.crc")
    later = replace(CTX, batch_id="later", run_ts=CTX.run_ts + timedelta(days=1))
    assert stream(spark, folder, store, later, fold=False) == expected == [(1, 2, "b"), (None, 1, "n"), (None, 2, "m")]
    if folded:
        assert len(store.slots(bronze.increments(SPEC, store))) == 1


def test_watermark_is_kept_with_each_batch(spark, folder):
    store = TableStore(spark, folder)
    spec = TableSpec("t", "t", "k", watermark="day")
    frame = lambda *days: spark.createDataFrame([(i, d) for i, d in enumerate(days)], "k int, day date")
    at = lambda batch, day: replace(CTX, batch_id=batch, as_of=day, run_ts=datetime(2025, 3, day.day))
    first, second = at("b1", date(2025, 3, 10)), at("b2", date(2025, 3, 12))
    # The 11th and the 14th are in the future of the first run.
    bronze.ingest_table(spec, lambda _: frame(date(2025, 3, 9), date(2025, 3, 11), date(2025, 3, 14)), store, first)
    mark = lambda ctx: bronze.known_watermark(spec, store, ctx)
    assert mark(first) == date(2025, 3, 9) and mark(second) == date(2025, 3, 11) and mark(at("b", date(2025, 3, 20))) == date(2025, 3, 14)
    assert mark(at("b0", date(2025, 3, 8))) is None
    assert mark(first) == date(2025, 3, 9)
    for _ in range(2):  # what this batch brought before does not count
        assert mark(second) == date(2025, 3, 11)
        rows_, _path = bronze.ingest_table(spec, lambda _: frame(date(2025, 3, 12), None, date(2025, 3, 10)), store, second, "append")
        assert rows_ == 1
    third = at("b3", date(2025, 3, 13))
    assert mark(third) == date(2025, 3, 12)
    # Lost notes are made again, from the footers.
    for folder_ in (store.path("t"), *store.slots(bronze.increments(spec, store))):
        os.remove(f"{folder_}/_watermark_day.json".removeprefix("file:"))
    assert mark(third) == date(2025, 3, 12)
    bronze.compact(spec, store)
    assert mark(third) == date(2025, 3, 12)
    store.write(frame().withColumn("x", F.lit(1)), "e")
    assert bronze.known_watermark(TableSpec("e", "e", "k", watermark="day"), store, third) is None


def test_watermark_reads_no_rows_of_the_table(spark, folder, monkeypatch):
    store = TableStore(spark, folder)
    spec = TableSpec("t", "t", "k", watermark="day")
    base = spark.range(1000).selectExpr("id AS k", "date_add(DATE '2025-01-01', CAST(id % 50 AS INT)) AS day")
    bronze.ingest_table(spec, lambda _: base, store, replace(CTX, as_of=date(2025, 3, 1)))
    text = plan(incremental.footer_maximum(store.read("t"), store.path("t"), "day"))
    assert "PushedAggregation: [MAX(day)]" in text
    read = []
    monkeypatch.setattr(incremental, "high_watermark", lambda *a, **b: read.append(a))
    monkeypatch.setattr(bronze, "high_watermark", lambda *a, **b: read.append(a))
    assert bronze.known_watermark(spec, store, replace(CTX, as_of=date(2025, 3, 1))) == date(2025, 2, 19)
    assert not read


def test_increments_are_folded_when_they_are_due(spark, folder):
    store = TableStore(spark, folder)
    spec = TableSpec("t", "t", "k")
    base = spark.range(200_000).selectExpr("id AS k", "uuid() AS v")
    bronze.ingest_table(spec, lambda _: base, store, CTX)
    version = store.path("t")
    for n in range(3):
        ctx = replace(CTX, batch_id=f"b{n}")
        bronze.ingest_table(spec, lambda _, n=n: spark.range(n, n + 2).selectExpr("id AS k", "'new' AS v"), store, ctx, "incremental")
    assert store.path("t") == version and len(store.slots(bronze.increments(spec, store))) == 3
    assert not bronze.compact_if_due(spec, store) and bronze.compact_if_due(spec, store, batches=3)
    assert store.path("t") != version and not store.slots(bronze.increments(spec, store))
    assert store.read("t").where("v = 'new'").count() == 4 and store.read("t").count() == 200_000


def test_partitioned_table_without_rows(spark, folder):
    store = TableStore(spark, folder)
    nothing = spark.createDataFrame([], "y int, v string, m int")
    store.write(nothing, "t", ["y", "m"])
    assert store.read("t").count() == 0 and set(store.read("t").columns) == {"y", "v", "m"}
    store.write(spark.createDataFrame([(2024, "a", 5)], nothing.schema), "t", ["y", "m"])
    assert rows(store.read("t").select("y", "m", "v")) == [(2024, 5, "a")]
    assert store.read("t").schema["y"].dataType.typeName() == "integer"


def test_versions_follow_the_last_one_whatever_the_clock_says(spark, folder):
    store = TableStore(spark, folder)
    spark.range(1).write.parquet(f"{folder}/t/version=29990101000000000000-aaaaaaaa")
    store.write(spark.range(2), "t")
    assert store.read("t").count() == 2
    spark.range(1).write.parquet(f"{folder}/log/_slot=s-a/version=29990101000000000000-aaaaaaaa")
    store.append(spark.range(3), "log", "a")
    assert store.read_all("log").count() == 3


def test_batches_are_read_by_the_first_parts_of_their_slots(spark, folder):
    store = TableStore(spark, folder)
    for n, slot in enumerate([("a", "x"), ("a", "y"), ("a+x",), ("ab",)], 1):
        store.append(spark.range(n), "log", *slot)
    assert store.read_all("log", "a").count() == 3
    assert store.read_all("log", "a", "y").count() == 2
    assert store.read_all("log").count() == 10
    with pytest.raises(FileNotFoundError):
        store.read_all("log", "b")
