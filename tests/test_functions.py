from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartlake.functions import text, typing


def one(spark, value, expression, schema="c string"):
    return spark.createDataFrame([(value,)], schema).select(expression(F.col("c"))).head()[0]


@pytest.mark.parametrize("raw", [" a b ", "\ta b\n", "\r\n a b\u2003", "\u3000a b\x0b"])
def test_trim_takes_all_white_space(spark, raw):
    assert one(spark, raw, text.trim_space) == "a b"


def test_trim_keeps_no_break_space(spark):
    assert one(spark, "\u00a0a", text.trim_space) == "\u00a0a"


@pytest.mark.parametrize("raw, expected", [(None, False), ("", False), (" ", True), ("x", True)])
def test_present(spark, raw, expected):
    assert bool(one(spark, raw, text.present)) is expected


def test_default_replaces_null_only(spark):
    assert one(spark, None, lambda c: text.or_default(c, "d")) == "d"
    assert one(spark, "", lambda c: text.or_default(c, "d")) == ""


def test_hash_key_is_upper_case_md5(spark):
    assert one(spark, "abc", text.hash_key) == "900150983CD24FB0D6963F7D28E17F72"
    assert one(spark, None, text.hash_key) is None


def test_cut(spark):
    assert len(one(spark, "x" * 3000, text.cut)) == 2000


@pytest.mark.parametrize("raw", ["abc", ""])
def test_strict_number_fails(spark, raw):
    with pytest.raises(PySparkException):
        one(spark, raw, typing.number)
    assert one(spark, raw, lambda c: typing.number(c, on_bad_value="null")) is None


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError):
        typing.number(F.lit("1"), on_bad_value="maybe")


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2024-03-01T10:00:00+00:00", datetime(2024, 3, 1, 10)),
        ("2024-03-01T10:00:00.123456+02:00", datetime(2024, 3, 1, 8, 0, 0, 123456)),
        (None, None),
    ],
)
def test_iso_timestamp_to_utc_wall_clock(spark, raw, expected):
    assert one(spark, raw, lambda c: typing.utc_wall_clock(typing.iso_timestamp(c))) == expected


def test_utc_wall_clock_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        value = one(
            spark,
            "1969-07-20T20:17:40.5+00:00",
            lambda c: typing.utc_wall_clock(typing.iso_timestamp(c)),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert value == datetime(1969, 7, 20, 20, 17, 40, 500000)


@pytest.mark.parametrize(
    "raw, expected",
    [("", None), ("x", None), (None, None), ("2018-05-01 10:00:00", datetime(2018, 5, 1, 10))],
)
def test_wall_clock(spark, raw, expected):
    assert one(spark, raw, typing.wall_clock) == expected


@pytest.mark.parametrize("current, mean, expected", [(130, 100.0, 30.0), (7, 0.0, None), (7, None, None)])
def test_percent_change(spark, current, mean, expected):
    df = spark.createDataFrame([(current, mean)], "n bigint, m double")
    assert df.select(typing.percent_change(F.col("n"), F.col("m"))).head()[0] == expected


def test_floor_to_minutes(spark):
    value = one(
        spark,
        "2024-03-01T10:44:59+00:00",
        lambda c: typing.utc_wall_clock(typing.floor_to_minutes(typing.iso_timestamp(c), 15)),
    )
    assert value == datetime(2024, 3, 1, 10, 30)
