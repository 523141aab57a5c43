"""Rolling statistics against brute force, and the flag's boundary rows."""

import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lamina.operators import rolling
from lamina.operators.joins import SkewPolicy
from lamina.operators.rolling import OutlierRule, flag_outliers, rolling_stats, trailing_sum, trailing_sum_over
from tests.support import plan, rows

START = date(2024, 1, 1)
SPLIT = SkewPolicy(broadcast_rows=0, rows_per_task=20)


def brute(data, days, exclude):
    """Mean and sample deviation of each row's frame, straight from the definition."""
    out = {}
    for i, key, day, _ in data:
        if key is None or day is None:
            out[i] = (None, None)
            continue
        low = date.min if days is None else day - timedelta(days=days)
        high = date.max if days is None else day
        frame = [
            v for j, k, d, v in data
            if k == key and d is not None and low <= d <= high and v is not None
            and not (exclude and j == i)
        ]
        mean = statistics.fmean(frame) if frame else None
        out[i] = (mean, statistics.stdev(frame) if len(frame) > 1 else None)
    return out


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(5)
    made = []
    for i in range(600):
        # Half of all rows belong to one key, a fifth to one key on one day.
        key = 1 if i % 2 else rnd.choice([2, 3, 4, None])
        day = START if i % 5 == 1 else START + timedelta(days=rnd.randrange(90))
        if rnd.random() < 0.03:
            day = None
        value = None if rnd.random() < 0.05 else round(rnd.lognormvariate(5, 1), 2)
        made.append((i, key, day, value))
    return made


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "i int, k int, d date, v double")


@pytest.mark.parametrize("policy", [SkewPolicy(), SPLIT])
@pytest.mark.parametrize("exclude", [False, True])
@pytest.mark.parametrize("days", [0, 30, None])
def test_statistics_match_brute_force(frame, data, days, exclude, policy):
    expected = brute(data, days, exclude)
    got = rolling_stats(frame, "k", "d", "v", days, exclude_current=exclude, policy=policy)
    assert got.columns == ["i", "k", "d", "v", "rolling_avg", "rolling_std"]
    result = {r["i"]: (r["rolling_avg"], r["rolling_std"]) for r in got.collect()}
    assert result.keys() == expected.keys()
    for i, pair in expected.items():
        for a, b in zip(result[i], pair):
            assert (a is None) == (b is None), (i, result[i], pair)
            if a is not None:
                assert a == pytest.approx(b, rel=1e-9, abs=1e-7)


def flags(spark, values, **rule):
    df = spark.createDataFrame([(i, 1, START, float(v)) for i, v in enumerate(values)],
                               "i int, k int, d date, v double")
    out = flag_outliers(df, "k", "d", "v", OutlierRule(**rule))
    return [r["is_outlier"] for r in out.orderBy("i").collect()]


def test_ten_rows_cannot_flag_but_eleven_can(spark):
    assert sum(flags(spark, [1] * 9 + [1000])) == 0
    assert flags(spark, [1] * 10 + [1000]) == [0] * 10 + [1]


def test_without_the_row_itself_few_rows_suffice(spark):
    assert flags(spark, [1, 2, 3, 1000], exclude_current=True) == [0, 0, 0, 1]


def test_constant_and_single_values_are_never_flagged(spark):
    assert flags(spark, [0.1] * 30) == [0] * 30
    assert flags(spark, [5]) == [0]
    assert flags(spark, [123456.78] * 12, exclude_current=True) == [0] * 12


def test_low_values_are_not_outliers(spark):
    assert flags(spark, [1000] * 20 + [1]) == [0] * 21


@pytest.mark.parametrize("days,exclude", [(30, False), (30, True), (None, False), (500, True)])
def test_a_moved_level_loses_no_digits(spark, days, exclude):
    shifts = [0.0, 0.1, 0.2, 0.3, 5.0]
    data = [(0, "a", START, 1.0)]
    data += [(i + 1, "a", START + timedelta(days=400 + i), 1e9 + x) for i, x in enumerate(shifts)]
    df = spark.createDataFrame(data, "id int, k string, d date, v double")
    out = rolling_stats(df, "k", "d", "v", days, exclude_current=exclude)
    got = {r.id: r.rolling_std for r in out.collect()}
    for i, (_, expected) in brute(data, days, exclude).items():
        assert (got[i] is None) == (expected is None)
        if expected is not None:
            assert got[i] == pytest.approx(expected, rel=1e-5)


def test_unknown_frame_is_refused():
    with pytest.raises(ValueError):
        OutlierRule(frame="week")


def test_window_runs_over_days_not_rows(frame):
    moments = rolling._moments_by_day(frame, "k", "d", "v")
    keyed = frame.dropna(subset=["k", "d"])
    assert moments.count() == keyed.select("k", "d").distinct().count() < keyed.count()
    # Rows are combined by key and day before the exchange, and the window reads the result.
    assert "partial_avg" in plan(moments) and "partial_count" in plan(moments)
    assert "daily-moments" in plan(rolling_stats(frame, "k", "d", "v", 30))


def test_trailing_sums(spark):
    df = spark.createDataFrame(
        [(1, 2024, 1, 1.0), (1, 2024, 2, 2.0), (1, 2024, 5, 4.0), (2, 2024, 1, 8.0)],
        "k int, y int, m int, v double")
    by_rows = trailing_sum(df, "k", ["y", "m"], "v", 2, "s")
    assert [r[-1] for r in rows(by_rows)] == [1.0, 3.0, 6.0, 8.0]
    index = F.col("y") * 12 + F.col("m")
    by_months = trailing_sum_over(df, "k", index, "v", 2, "s")
    assert [r[-1] for r in rows(by_months)] == [1.0, 3.0, 4.0, 8.0]
