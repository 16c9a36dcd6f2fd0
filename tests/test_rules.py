"""Rule tables: each column rule against literal rows (FIXTURES.md section C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from galaxia.functions import rules as R

K = "a" * 32


def one(spark, expr, value, dtype):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("value,expected", [
    (f" {K.upper()} ", K), ("", ""), ("  ", ""), (None, None), ("\tab", "\tab"),
])
def test_clean_key(spark, value, expected):
    assert one(spark, R.clean_key, value, "string") == expected


@pytest.mark.parametrize("value,keep", [(K, True), ("", False), ("  ", False), (None, False)])
def test_not_blank(spark, value, keep):
    assert one(spark, R.not_blank, value, "string") == keep


def test_id_length(spark):
    assert one(spark, R.has_length, K, "string") is True
    assert one(spark, R.has_length, K[:31], "string") is False


@pytest.mark.parametrize("value,expected", [(None, "00000"), (42, "00042"), (123456, "123456"), (12345, "12345")])
def test_zip5(spark, value, expected):
    assert one(spark, R.zip5, value, "int") == expected


@pytest.mark.parametrize("value,expected", [
    (None, "unknown"), ("", "unknown"), (" ", "unknown"), ("ab", "unknown"),
    ("Sao   Paulo", "sao paulo"), (" Rio  de Janeiro ", "rio de janeiro"),
])
def test_city_customers(spark, value, expected):
    assert one(spark, lambda c: R.clean_city(c, R.CITY_MIN_LENGTH), value, "string") == expected


def test_city_sellers_keeps_short(spark):
    assert one(spark, R.clean_city, "ab", "string") == "ab"


@pytest.mark.parametrize("value,expected", [(None, "UN"), ("", "UN"), ("SPX", "UN"), (" sp ", "SP")])
def test_state(spark, value, expected):
    assert one(spark, R.state_code, value, "string") == expected


@pytest.mark.parametrize("value,expected", [(None, "unknown"), ("", "unknown"), (" Auto ", "auto")])
def test_category(spark, value, expected):
    assert one(spark, R.clean_category, value, "string") == expected


@pytest.mark.parametrize("value,expected", [(None, 0.0), (-1.0, 0.0), (2.0, 2.0)])
def test_photos_floor(spark, value, expected):
    assert one(spark, lambda c: R.floor_at(c, 0.0), value, "double") == expected


@pytest.mark.parametrize("value,expected", [(None, 1), (0, 1), (-2, 1), (3, 3)])
def test_installments_floor(spark, value, expected):
    assert one(spark, lambda c: R.floor_at(c, 1), value, "int") == expected


@pytest.mark.parametrize("value,expected", [(0.0, None), (-5.0, None), (None, None), (2.5, 2.5)])
def test_nonpositive(spark, value, expected):
    assert one(spark, R.nonpositive_to_null, value, "double") == expected


@pytest.mark.parametrize("value,expected", [(None, "Not Defined"), ("", "Not Defined"), ("BOLETO", "boleto")])
def test_payment_type(spark, value, expected):
    assert one(spark, R.payment_type, value, "string") == expected


@pytest.mark.parametrize("value,keep", [(0, False), (6, False), (None, True), (1, True), (5, True)])
def test_score_range(spark, value, keep):
    assert one(spark, lambda c: R.in_range_or_null(c, 1, 5), value, "int") == keep


def test_comment_blank(spark):
    assert one(spark, R.blank_to_null, "  ", "string") is None
    assert one(spark, R.blank_to_null, " ok ", "string") == "ok"


def test_money_half_up(spark):
    from decimal import Decimal
    assert one(spark, R.to_money, 2.675, "double") == Decimal("2.68")


def test_time_range(spark):
    lo, now = "2016-01-01 00:00:00", "2020-01-01 00:00:00"
    rows = [(dt.datetime(2016, 1, 1),), (dt.datetime(2015, 12, 31),), (None,), (dt.datetime(2021, 1, 1),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    strict = [r[0] for r in df.select(R.in_time_range("t", lo, now)).collect()]
    loose = [r[0] for r in df.select(R.in_time_range("t", lo, now, keep_null=True)).collect()]
    assert strict == [True, False, False, False]
    assert loose == [True, False, True, False]


def test_date_order_flag(spark):
    p = dt.datetime(2017, 1, 2)
    rows = [(p, p - dt.timedelta(days=1), None), (p, None, None), (p, p, p + dt.timedelta(days=3))]
    df = spark.createDataFrame(rows, "p timestamp_ntz, a timestamp_ntz, d timestamp_ntz")
    flags = [r[0] for r in df.select(R.before_any("p", ["a", "d"])).collect()]
    assert flags == [True, False, False]
