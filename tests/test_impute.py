"""Fill values, exact on any distribution."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from lamina.operators import impute
from tests.support import rows

RANDOM = random.Random(3)
SHAPES = {
    "uniform odd": [RANDOM.random() for _ in range(4001)],
    "uniform even": [RANDOM.random() for _ in range(4000)],
    "half and half": [1.0] * 2000 + [2.0] * 2000,
    "one heavy value": [5.0] * 3000 + [RANDOM.random() for _ in range(1001)],
    "heavy at the ends": [0.0] * 1999 + [9.0] * 1999 + [1.0, 4.0],
    "few values": [float(RANDOM.randrange(4)) for _ in range(4000)],
    "wide": [RANDOM.lognormvariate(0, 8) for _ in range(4000)],
    "constant": [3.25] * 3000,
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("held", [10, 200, 1_000_000])
def test_median_is_exact(spark, shape, held):
    values = SHAPES[shape]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    assert impute.median(df, "v", held) == pytest.approx(statistics.median(values), rel=1e-12)


def test_median_of_nothing(spark):
    assert impute.median(spark.createDataFrame([(None,)], "v double"), "v") is None


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "b", "a", None, None, None]], "v string")
    assert impute.mode(df, "v") == "a"
    assert impute.mode(df.where("v IS NULL"), "v") is None


def test_policies(spark):
    df = spark.createDataFrame([(1, 10, "x", "p"), (2, None, None, None), (3, 30, "x", "p")],
                               "id int, score int, channel string, other string")
    out = impute.handle_nulls(
        df, "flag", {"score": "impute_median", "channel": "impute_mode"}, ["score", "channel", "other"])
    assert out.schema["score"].dataType.simpleString() == "int"
    assert rows(out)[1] == (2, 20, "x", None, 1, 1, 1)
    kept = impute.handle_nulls(df, "flag", {"other": "exclude"}, ["other"])
    assert kept.count() == 2 and "is_null_other" not in kept.columns
    with pytest.raises(ValueError):
        impute.handle_nulls(df, "guess", {}, ["score"])


def test_fill_skips_columns_without_a_value(spark):
    df = spark.createDataFrame([(None, None)], "a int, b string")
    assert rows(impute.fill(df, {"a": None, "b": "x"})) == [(None, "x")]


def test_all_columns_are_searched_together(spark):
    """Medians and modes of many columns are those of each alone, and take as many jobs as one."""
    draw = random.Random(5)
    shapes = [values + [None] * 40 for values in SHAPES.values()]
    longest = max(map(len, shapes))
    table = [[s[i] if i < len(s) else None for s in shapes] for i in range(longest)]
    draw.shuffle(table)
    names = [f"c {i}" for i in range(len(shapes))]
    df = spark.createDataFrame(table, ", ".join(f"`{n}` double" for n in names)).withColumn("none", F.lit(None).cast("int"))
    told = impute.medians(df, [*names, "none"], 300)
    assert told.pop("none") is None
    assert list(told.values()) == [pytest.approx(statistics.median([v for v in s if v is not None]), rel=1e-12) for s in shapes]
    mixed = df.select(F.col("`c 5`").cast("int").alias("i"), F.col("`c 5`").cast("string").alias("s"), F.col("`c 7`").alias("f"), "none")
    few = [v for v in SHAPES["few values"]]
    top = min(set(few), key=lambda v: (-few.count(v), v))
    assert impute.modes(mixed, ["i", "s", "f", "none"]) == {"i": int(top), "s": str(top), "f": 3.25, "none": None}
    assert impute.medians(df, []) == {} and impute.modes(df, []) == {}

    def jobs(name, work):
        spark.sparkContext.setJobGroup(name, name)
        work()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    same = df.select(*[F.col("`c 6`").alias(f"v{i}") for i in range(6)])
    for held, find in ((50, lambda c: impute.medians(same, c, 50)), (0, lambda c: impute.modes(same, c))):
        one = jobs(f"one{held}", lambda: find(["v0"]))
        assert 0 < jobs(f"six{held}", lambda: find([f"v{i}" for i in range(6)])) <= one + 1
