"""Clustering along a curve, filters that prune partitions, stored sketches."""

import glob
import re
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lamina.functions import dates
from lamina.operators import curve, sketches
from lamina.plans import gold
from lamina.sources.pruning import in_months, where_days
from lamina.sources.store import TableStore
from tests.support import plan, rows


def row_groups(path):
    """Row groups of all files, each as a dictionary of the ranges of its columns."""
    found = []
    for name in glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            columns = [meta.row_group(g).column(c) for c in range(meta.num_columns)]
            found.append({c.path_in_schema: (c.statistics.min, c.statistics.max) for c in columns if c.statistics})
    return found


def test_either_column_skips_most_row_groups(spark, folder):
    """One in eight of the values of either column is asked for; clustering by one column serves that one only."""
    df = spark.range(0, 40_000, 1, 4).selectExpr("id", "pmod(xxhash64(id), 1000) AS a", "pmod(xxhash64(id, 1), 1000) / 7.0D AS b")
    store = TableStore(spark, folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.setInt("parquet.block.size", 8192)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        curved = store.write(df, "curved", cluster_by=["a", "b"], along_curve=True)
        plain = store.write(df, "plain", cluster_by=["a", "b"])
    finally:
        conf.unset("parquet.block.size")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert rows(store.read("curved")) == rows(df) and store.read("curved").columns == df.columns

    def opened(path, col, low, high):
        groups = row_groups(path)
        return sum(g[col][0] <= high and g[col][1] >= low for g in groups) / len(groups)

    assert len(row_groups(curved)) >= 64
    assert opened(curved, "a", 0, 124) < 0.3 and opened(curved, "b", 0, 124 / 7) < 0.3
    assert opened(plain, "a", 0, 124) < 0.2 and opened(plain, "b", 0, 124 / 7) > 0.9


def test_places_interleave_the_bits_of_ranks(spark):
    bounds = {"x": [10, 20, 30], "y": [1, 2, 3]}
    df = spark.createDataFrame([(x, y) for x in (0, 10, 25, 30, None) for y in (0, 1, 2, 3)], "x long, y long")
    ranks = {0: 0, 10: 1, 25: 2, 30: 3, None: 0}
    for r in df.select("x", "y", curve.curve(df, ["x", "y"], 2, bounds).alias("place")).collect():
        a, b = ranks[r.x], r.y
        assert r.place == ((a >> 1) << 3) | ((b >> 1) << 2) | ((a & 1) << 1) | (b & 1)


def test_every_kind_of_column_keeps_its_order(spark):
    df = spark.createDataFrame(
        [(date(2020, 1, i % 28 + 1), datetime(2020, 1, 1, i % 24), f"{chr(97 + i % 26)}{i}", i * 1.5 - 40, i % 2 == 0) for i in range(200)],
        "d date, t timestamp, s string, f double, q boolean",
    ).withColumn("m", F.col("f").cast("decimal(12,2)")).union(spark.createDataFrame([(None,) * 6], "d date, t timestamp, s string, f double, q boolean, m decimal(12,2)"))
    for col in df.columns:
        placed = df.select(F.col(col).alias("v"), curve.curve(df, [col], 4).alias("place")).collect()
        known = sorted((r for r in placed if r.v is not None), key=lambda r: r.v)
        assert [r.place for r in known] == sorted(r.place for r in known)
        assert known[-1].place > known[0].place and [r.place for r in placed if r.v is None] == [0]
    with pytest.raises(ValueError):
        curve.curve(df, ["d", "t", "s", "f"], 16)
    nothing = df.limit(0)
    assert nothing.select(curve.curve(nothing, ["d", "s"]).alias("p")).count() == 0


@pytest.fixture()
def dated(spark, folder):
    """Five rows on each day of three years, stored by year and month."""
    store = TableStore(spark, folder)
    days = spark.range(0, 1096 * 5).selectExpr("id", "date_add(DATE '2019-01-01', CAST(id DIV 5 AS INT)) AS d")
    store.write(days.withColumns({"d_year": F.year("d"), "d_month": F.month("d")}), "t", ["d_year", "d_month"])
    return store.read("t"), days


BOUNDS = [
    (date(2019, 12, 31), date(2020, 1, 1)), (date(2020, 2, 1), date(2020, 2, 29)), (date(2020, 3, 31), date(2020, 3, 31)),
    (date(2019, 1, 31), date(2021, 2, 1)), (None, date(2019, 1, 1)), (date(2021, 12, 31), None), (None, None),
    (date(2020, 5, 2), date(2020, 5, 1)), (date(2022, 1, 1), None), (date(2020, 11, 30), date(2021, 1, 31)),
]


@pytest.mark.parametrize("first, last", BOUNDS)
def test_days_at_the_borders_of_months(dated, first, last):
    table, days = dated
    found, expected = where_days(table, "d", first, last), days
    if first:
        expected = expected.where(F.col("d") >= F.lit(first))
    if last:
        expected = expected.where(F.col("d") <= F.lit(last))
    assert rows(found.select("id", "d")) == rows(expected)


def months_opened(df):
    return {tuple(map(int, re.search(r"d_year=(\d+)/d_month=(\d+)", f).groups())) for f in df.select("_metadata.file_path").distinct().toPandas()["file_path"]}


def test_only_partitions_of_the_days_are_opened(spark, dated):
    table, _ = dated
    found = where_days(table, "d", date(2019, 12, 31), date(2020, 1, 1))
    text = plan(found)
    filters = next(line for line in text.split("\n") if "PartitionFilters" in line)
    assert "d_year" in filters and "d_month" in filters
    assert months_opened(found) == {(2019, 12), (2020, 1)}
    # Without the days themselves: the partitions that the condition leaves.
    assert months_opened(table.where(in_months("d_year", "d_month", F.lit(date(2020, 11, 30)), F.lit(date(2021, 1, 1))))) == {
        (2020, 11), (2020, 12), (2021, 1)}
    # A cutoff that is only known when the query runs.
    recent = dates.since_cutoff(table, "d", dates.trailing_cutoff(table, "d", 2))
    filters = [line for line in plan(recent).split("\n") if "PartitionFilters" in line]
    assert any("d_month" in line and "ubquery" in line for line in filters), filters
    assert months_opened(recent) == {(2021, 10), (2021, 11), (2021, 12)}
    # Tables without such columns, or with other names for them.
    assert where_days(table.drop("d_year"), "d", date(2020, 1, 1)).count() == where_days(table, "d", date(2020, 1, 1)).count()
    renamed = table.withColumnsRenamed({"d_year": "y", "d_month": "m"})
    assert where_days(renamed, "d", date(2020, 1, 1), partitions=("y", "m")).count() == 5 * (366 + 365)


@pytest.mark.parametrize("lg", [8, 12])
def test_merged_sketches_stay_within_their_bound(spark, lg):
    """Values that several days have count once, in whatever order the sketches are merged."""
    df = spark.range(0, 60_000, 1, 6).selectExpr("id % 20000 AS v", "id % 7 AS day", "IF(id % 3 = 0, 'hot', CAST(id % 5 AS STRING)) AS g")
    daily = sketches.distinct_sketches(df, ["g", "day"], "v", lg)
    size = daily.agg(F.max(F.length(sketches.SKETCH))).first()[0]
    assert size <= 2 ** (lg + 1) + 64
    exact = {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
    weeks = sketches.merged(daily.withColumn("half", F.expr("day DIV 4")), ["g", "half"])
    for found in (sketches.merged(daily, ["g"]), sketches.merged(weeks, ["g"])):
        told = {r.g: r.n for r in found.select("g", sketches.estimate().alias("n")).collect()}
        assert set(told) == set(exact)
        assert all(abs(told[g] - n) <= sketches.error_bound(lg) * n for g, n in exact.items())
    nothing = sketches.distinct_sketches(df.withColumn("v", F.lit(None).cast("long")), ["g"], "v", lg)
    assert {r.n for r in nothing.select(sketches.estimate().alias("n")).collect()} == {0}


def test_late_clients_of_several_days_from_stored_sketches(spark, folder):
    store = TableStore(spark, folder)
    for day in (1, 2, 3):
        portfolio = spark.range(0, 3000).selectExpr(
            "id AS id_cli", "CONCAT('P', id % 2) AS cod_prod", f"IF(id % 3 = {day} % 3, 5, 0) AS dias_mora_act")
        store.append(gold.late_client_sketches(portfolio, date(2025, 1, day)), "late", f"2025-01-0{day}")
    told = lambda a, b: {r.cod_prod: r.clientes_con_mora_aprox for r in gold.late_clients_over(
        store.read_all("late"), date(2025, 1, a), date(2025, 1, b)).collect()}
    for (a, b), n in {(1, 1): 500, (1, 2): 1000, (1, 3): 1500}.items():
        assert all(abs(x - n) <= sketches.error_bound() * n for x in told(a, b).values()) and len(told(a, b)) == 2
