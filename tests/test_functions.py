"""Boundary rows of every scalar rule."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lamina.functions import classify, dates, money
from lamina.functions.clean import normalize_text, standardize
from lamina.functions.mask import Mask, clear_columns, exposure, mask_columns, sha256_hex
from lamina.settings import (
    AGE_EDGES, AGE_LABELS, DELINQUENCY_BUCKETS, PROVISION_SHARES, RATINGS, SEGMENTS,
)
from tests.support import rows


def column(spark, values, type_name, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


DAYS = [-5, 0, 1, 30, 31, 60, 61, 90, 91, None]


def test_delinquency_buckets(spark):
    got = column(spark, DAYS, "int", classify.by_range("v", DELINQUENCY_BUCKETS, "Desconocido"))
    assert got == [
        "Desconocido", "Al día", "Rango 1", "Rango 1", "Rango 2", "Rango 2", "Rango 3", "Rango 3",
        "Deteriorado", "Desconocido",
    ]


def test_ratings_and_shares(spark):
    assert column(spark, DAYS, "int", classify.by_range("v", RATINGS, "E")) == list("EABBCCDDEE")
    shares = column(spark, DAYS, "int", classify.by_range("v", PROVISION_SHARES, 1.0))
    assert shares == [1.0, 0.01, 0.032, 0.032, 0.117, 0.117, 0.5, 0.5, 1.0, 1.0]


def test_age_bands(spark):
    ages = [17, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65, None]
    got = column(spark, ages, "int", classify.by_band("v", AGE_EDGES, AGE_LABELS))
    assert got == [
        "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55-64", "55-64",
        "65+", "65+",
    ]
    assert column(spark, [None], "int", classify.by_band("v", AGE_EDGES, AGE_LABELS, "?")) == ["?"]
    with pytest.raises(ValueError):
        classify.by_band(F.lit(1), [1, 2], ["a"])


def test_codes_and_sets(spark):
    got = column(spark, ["01", "04", "99", None], "string", classify.by_code("v", SEGMENTS))
    assert got == ["Básico", "Elite", None, None]
    sets = {"Digital": ("DIGITAL",), "Oficina": ("OFICINA",)}
    got = column(spark, ["DIGITAL", "KIOSCO", None], "string", classify.by_set("v", sets, "Otro"))
    assert got == ["Digital", "Otro", "Otro"]


def test_business_hours(spark):
    clocks = ["06:59:59", "07:00:00", "18:59:59", "19:00:00", None, "xx:00:00"]
    got = column(spark, clocks, "string", dates.hours_flag(dates.hour_of("v"), 7, 18))
    assert got == ["NO_HABIL", "HABIL", "HABIL", "NO_HABIL", "NO_HABIL", "NO_HABIL"]


def test_ages_and_tenure(spark):
    born = [date(2000, 1, 1), date(2000, 1, 2), None]
    assert column(spark, born, "date", dates.age_years("v", date(2025, 1, 1))) == [25, 24, None]
    assert column(spark, born, "date", dates.days_since("v", date(2000, 1, 31))) == [30, 29, None]


def test_cutoff_clamps_to_month_end(spark):
    df = spark.createDataFrame([(date(2024, 2, 29),), (date(2023, 5, 1),)], "d date")
    assert dates.trailing_cutoff(df, "d", 12).first()[0] == date(2023, 2, 28)
    assert dates.since_cutoff(df, "d", dates.trailing_cutoff(df, "d", 12)).count() == 2


def test_calendar_is_complete(spark):
    bounds = spark.createDataFrame([(date(2024, 2, 28), date(2024, 3, 2))], "first date, last date")
    days = dates.calendar(bounds).orderBy("day").collect()
    assert [r["date_key"] for r in days] == [20240228, 20240229, 20240301, 20240302]
    assert [r["is_weekend"] for r in days] == [0, 0, 0, 1]


def test_amounts_round_half_up(spark):
    values = [Decimal("1.01"), Decimal("2000.00"), None]
    assert column(spark, values, "decimal(18,2)", money.convert("v", "0.5")) == [
        Decimal("0.51"), Decimal("1000.00"), None,
    ]
    assert column(spark, values, "decimal(18,2)", money.provision("v", F.lit(0.5)))[:2] == [1, 1000]
    rates = {"COP": 0.000245, "MXN": 0.058}
    df = spark.createDataFrame([(100.0, "MXN"), (100.0, "XXX"), (100.0, None)], "v double, c string")
    got = [r[0] for r in df.select(money.convert_by_code("v", "c", rates)).collect()]
    assert got == [Decimal("5.80"), None, None]


def test_rates_and_ratios(spark):
    got = column(spark, [0.0, 0.12682503, None], "double", money.periodic_rate("v"))
    assert got == [0.0, 0.01, None]
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(money.percent("a", "b")).collect()] == [25.0, None]
    assert [r[0] for r in df.select(money.ratio("a", "b")).collect()] == [0.25, None]


def test_standardize_keeps_track_of_lost_values(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-01"), ("x", "2024-01-01"), (None, "2024-13-01"), ("x", "bad")], "a string, d string"
    )
    got = rows(standardize(df, {"a": "int", "d": "date"}, flag=True))
    assert got == [
        (1, date(2024, 1, 1), None), (None, None, "a"), (None, None, "d"), (None, date(2024, 1, 1), "a"),
    ]


def test_standardize_leaves_fitting_types_alone(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert standardize(df, {"a": "int"}).schema == df.schema


def test_normalize_text(spark):
    df = spark.createDataFrame([(" ab ", " Cd ", None)], "a string, b string, c string")
    assert normalize_text(df, upper=["a", "c"], trim=["b"]).first() == ("AB", "Cd", None)


def test_masking(spark):
    df = spark.createDataFrame([("a", "b", Decimal("1234567.00")), (None, "b", None)],
                               "n string, o string, v decimal(18,2)")
    policy = {"n": Mask(), "o": Mask("drop"), "v": Mask("scale"), "absent": Mask()}
    out = mask_columns(df, policy)
    assert out.columns == ["v", "n_hash", "v_masked"]
    assert rows(out)[0][1:] == (
        "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb", Decimal("1.23"))
    assert out.where("n_hash IS NULL").count() == 1
    assert clear_columns(out, policy) == [] and clear_columns(df, policy) == ["n", "o"]
    assert out.select("n_hash").first() != df.select(sha256_hex("n", salt="x")).first()
    with pytest.raises(ValueError):
        Mask("rot13")


def test_exposure_counts_leaked_values(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b")], "n string, o string")
    policy = {"n": Mask(), "o": Mask()}
    assert rows(exposure(df, policy)) == [(2, "n", 1, 1), (2, "o", 1, 2)] or rows(
        exposure(df, policy).select("column_name", "is_clear", "clear_values", "checked_rows")
    ) == [("n", 1, 1, 2), ("o", 1, 2, 2)]
    assert rows(exposure(mask_columns(df, policy), policy).select("is_clear", "clear_values")) == [
        (0, 0), (0, 0)]
