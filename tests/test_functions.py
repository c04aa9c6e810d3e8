import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronoroll.functions import (chunk_label, event_time, floor_time, format_reference_time,
                                  parse_time, region_from_path, run_id)
from chronoroll.functions.time import utc_epoch_millis
from chronoroll.functions.values import coerce

REF = "MM/dd/yyyy hh:mm:ss a"


def one(spark, expr, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).collect()[0]["r"]


@pytest.mark.parametrize("text,expected", [
    ("01/08/2020 02:30:00 PM", dt.datetime(2020, 1, 8, 14, 30)),
    ("01/08/2020 12:30:00 AM", dt.datetime(2020, 1, 8, 0, 30)),
    ("01/08/2020 12:30:00 PM", dt.datetime(2020, 1, 8, 12, 30)),
    ("01/08/2020 02:30:00 pm", dt.datetime(2020, 1, 8, 14, 30)),
    ("1/8/2020 2:30:00 PM", None),
    ("not a time", None),
    ("", None),
    (None, None),
])
def test_parse_reference_format(spark, text, expected):
    assert one(spark, parse_time(F.col("s"), REF), text) == expected


def test_parse_iso_and_auto(spark):
    assert one(spark, parse_time(F.col("s"), "iso"), "2024-01-02T03:04:05.123456") == \
        dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert one(spark, parse_time(F.col("s"), "iso"), "2024-01-02T03:04:05Z") == \
        dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, parse_time(F.col("s"), "auto"), "1704067207179") == \
        dt.datetime(2024, 1, 1, 0, 0, 7, 179000)
    assert one(spark, parse_time(F.col("s"), "auto"), "2024-01-01 00:00:07") == \
        dt.datetime(2024, 1, 1, 0, 0, 7)
    assert one(spark, parse_time(F.col("s"), "auto"), "garbage") is None
    assert one(spark, parse_time(F.col("s"), "posix"), "1704067207") == \
        dt.datetime(2024, 1, 1, 0, 0, 7)


def test_missing_default_only_for_blank(spark):
    e = event_time(F.col("s"), REF, "1999-09-09T09:00:00Z")
    for blank in (None, "", "  "):
        assert one(spark, e, blank) == dt.datetime(1999, 9, 9, 9)
    assert one(spark, e, "bad") is None


@pytest.mark.parametrize("g,expected", [
    ("none", dt.datetime(2024, 3, 10, 2, 47, 31, 500)),
    ("second", dt.datetime(2024, 3, 10, 2, 47, 31)),
    ("minute", dt.datetime(2024, 3, 10, 2, 47)),
    ("fifteen_minute", dt.datetime(2024, 3, 10, 2, 45)),
    ("hour", dt.datetime(2024, 3, 10, 2)),
    ("six_hour", dt.datetime(2024, 3, 10, 0)),
    ("day", dt.datetime(2024, 3, 10)),
    ("week", dt.datetime(2024, 3, 4)),
    ("month", dt.datetime(2024, 3, 1)),
    ("quarter", dt.datetime(2024, 1, 1)),
    ("year", dt.datetime(2024, 1, 1)),
])
def test_floor_time(spark, g, expected):
    v = dt.datetime(2024, 3, 10, 2, 47, 31, 500)
    assert one(spark, floor_time(F.col("t"), g), v, "t timestamp_ntz") == expected


def test_time_functions_do_not_depend_on_session_zone(spark):
    # 2024-03-10 02:30 does not exist in New York; NTZ flooring must not care
    v = dt.datetime(2024, 3, 10, 2, 30, 15)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, floor_time(F.col("t"), "hour"), v, "t timestamp_ntz") == \
            dt.datetime(2024, 3, 10, 2)
        assert one(spark, chunk_label(F.col("t"), "month"), v, "t timestamp_ntz") == "2024-03-01"
        assert one(spark, format_reference_time(F.col("t")), v, "t timestamp_ntz") == \
            "03/10/2024 02:30:15 AM"
        ms = one(spark, utc_epoch_millis(F.col("t")), dt.datetime(2024, 1, 1), "t timestamp_ntz")
        assert ms == 1704067200000
        assert one(spark, parse_time(F.col("s"), "millis"), "1704067200000") == dt.datetime(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_chunk_labels(spark):
    v = dt.datetime(2024, 1, 30, 23, 5)
    assert one(spark, chunk_label(F.col("t"), "day"), v, "t timestamp_ntz") == "2024-01-30"
    assert one(spark, chunk_label(F.col("t"), "hour"), v, "t timestamp_ntz") == "2024-01-30T23"


def test_format_reference_time_round_trip(spark):
    v = dt.datetime(2024, 7, 4, 12, 0, 59)
    text = one(spark, format_reference_time(F.col("t")), v, "t timestamp_ntz")
    assert text == "07/04/2024 12:00:59 PM"
    assert one(spark, parse_time(F.col("s"), REF), text) == v


def test_coerce_bad_text_is_null(spark):
    assert one(spark, coerce(F.col("s"), "long"), " 42 ") == 42
    assert one(spark, coerce(F.col("s"), "long"), "4x2") is None
    assert one(spark, coerce(F.col("s"), "double"), "1.5E3") == 1500.0
    assert one(spark, coerce(F.col("s"), "double"), "n/a") is None


def test_region_from_path(spark):
    assert one(spark, region_from_path(F.col("s")), "file:/d/raw/los%20angeles/a.csv") == "los angeles"
    assert one(spark, region_from_path(F.col("s")), "hdfs://nn/raw/city=austin/part-0.csv") == "austin"


def test_run_id_has_seconds():
    assert run_id(dt.datetime(2024, 2, 1, 13, 5, 9)) == "20240201130509"


def test_region_from_path_keeps_plus_and_plain_names(spark):
    assert one(spark, region_from_path(F.col("s")), "file:/d/raw/a+b/x.csv") == "a+b"
    assert one(spark, region_from_path(F.col("s")), "file:/d/raw/boston/x.csv") == "boston"


def test_instant_round_trip_in_any_zone(spark):
    from chronoroll.functions.time import instant_to_ntz, ntz_to_instant
    v = dt.datetime(2024, 1, 5, 23, 30)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = spark.createDataFrame([(v,)], "t timestamp_ntz")
        r = df.select(F.unix_seconds(ntz_to_instant("t")).alias("s"),
                      instant_to_ntz(ntz_to_instant("t")).alias("back"),
                      instant_to_ntz(F.window(ntz_to_instant("t"), "1 day").start).alias("day")
                      ).collect()[0]
        assert r["s"] == int(v.replace(tzinfo=dt.timezone.utc).timestamp())
        assert r["back"] == v and r["day"] == dt.datetime(2024, 1, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("tz", ["UTC", "America/New_York"])
def test_iso_offsets_become_utc(spark, tz):
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        p = parse_time(F.col("s"), "iso")
        assert one(spark, p, "2020-01-01T05:00:00+02:00") == dt.datetime(2020, 1, 1, 3)
        assert one(spark, p, "2020-01-01T05:00:00-0130") == dt.datetime(2020, 1, 1, 6, 30)
        assert one(spark, p, "2020-01-01T05:00:00Z") == dt.datetime(2020, 1, 1, 5)
        assert one(spark, p, "2020-01-01T05:00:00") == dt.datetime(2020, 1, 1, 5)
        assert one(spark, p, "2020-01-01 05:00") == dt.datetime(2020, 1, 1, 5)
        assert one(spark, p, "2020-01-01") == dt.datetime(2020, 1, 1)
        assert one(spark, p, "2020-13-01") is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("tz", ["UTC", "America/New_York", "Europe/Berlin"])
def test_pattern_parse_and_conversions_exact_in_any_zone(spark, tz):
    from chronoroll.functions.time import instant_to_ntz, ntz_to_instant
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        p = parse_time(F.col("s"), REF)
        # a wall clock that does not exist in New York (spring forward)
        assert one(spark, p, "03/10/2024 02:30:00 AM") == dt.datetime(2024, 3, 10, 2, 30)
        # one that exists twice there (fall back)
        assert one(spark, p, "11/03/2024 01:30:00 AM") == dt.datetime(2024, 11, 3, 1, 30)
        assert one(spark, p, "bad") is None
        for v in (dt.datetime(2024, 11, 3, 5, 30), dt.datetime(2024, 3, 10, 7, 15)):
            assert one(spark, instant_to_ntz(ntz_to_instant("t")), v, "t timestamp_ntz") == v
        assert one(spark, parse_time(F.col("s"), "yyyy-MM-dd HH:mm XXX"),
                   "2024-01-01 10:00 +02:00") == dt.datetime(2024, 1, 1, 8)
        assert one(spark, parse_time(F.col("s"), "micros"), "1704067200000001") == \
            dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_typed_instant_column_becomes_utc_wall_clock(spark):
    from chronoroll.operators import with_event_time
    from chronoroll.spec import TableSpec
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00+00:00' AS t")
        out = with_event_time(df, TableSpec(name="x", time_column="t")).collect()[0]["__time"]
        assert out == dt.datetime(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_time_parsing_in_a_session_without_an_explicit_zone(spark):
    """A plain session (the zone setting never set) must work too."""
    from chronoroll.functions.time import _session_is_utc
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.unset("spark.sql.session.timeZone")
    try:
        _session_is_utc()
        df = spark.createDataFrame([("01/08/2020 02:30:00 PM",)], "t string")
        got = df.select(parse_time("t", "MM/dd/yyyy hh:mm:ss a").alias("x")).first()["x"]
        assert str(got) == "2020-01-08 14:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
