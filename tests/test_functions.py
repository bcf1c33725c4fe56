"""Normalisation, dimensions and warehouse types on small hand-made cases."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pulseframe.functions import normalize as N
from pulseframe.functions import warehouse as W
from pulseframe.sources import dims, scan


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}" for k, v in values.items()) or "x long"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("out")).first().out


@pytest.mark.parametrize("value, expected", [("release", "release"), ("released", "Other"), ("beta", "beta"), ("beta-cck-x", "beta"), ("nightly", "nightly"), ("nightly-cck-x", "nightly"), ("nightly-x", "Other"), ("aurora", "aurora"), ("", "Other"), (None, "Other")])
def test_channel(spark, value, expected):
    assert one(spark, N.norm_channel(F.col("c")), c=value) == expected


@pytest.mark.parametrize("value, expected", [("Windows_NT", "Windows"), ("WINNT", "Windows"), ("Darwin", "Mac"), ("GNU/Linux", "Linux"), ("FreeBSD", "Linux"), ("SunOS", "Linux"), ("Haiku", "Other"), (None, "Other")])
def test_os(spark, value, expected):
    assert one(spark, N.norm_os(F.col("c")), c=value) == expected


def test_country(spark):
    codes = N.iso_countries()
    assert 240 < len(codes) < 260
    assert [one(spark, N.norm_country(F.col("c"), codes), c=c) for c in ("us", "De", "??", "", None)] == ["US", "DE", "Other", "Other", "Other"]


@pytest.mark.parametrize("value, expected", [("10.0", "Windows 10"), ("10.9", "Windows 10"), ("11", "Other"), ("6.3", "Windows 8"), ("6.1", "Windows 7"), ("x", "Other"), (None, "Other")])
def test_windows(spark, value, expected):
    assert one(spark, N.win_version_bucket(F.col("c")), c=value) == expected


def test_dimension_ids(spark):
    assert [one(spark, N.dimension_id(F.col("c"), N.CHANNELS), c=c) for c in ("Other", "release", "aurora", "x", None)] == [0, 1, 4, 0, 0]
    assert [one(spark, N.dimension_name(F.col("i"), N.SYSTEMS), i=i) for i in (0, 3, 9, -1)] == ["Other", "Linux", "Other", "Other"]


@pytest.mark.parametrize("path, parts", [("/foo/bar", ["foo", "bar"]), ("///foo//bar/", ["foo", "bar"]), ("foo/bar/", ["foo", "bar"]), ("/", [])])
def test_split_path(spark, path, parts):
    assert one(spark, N.split_path(F.col("p")), p=path) == parts


def test_flash_version_is_by_components(spark):
    df = spark.sql("SELECT array(named_struct('name', 'Shockwave Flash', 'version', '9.9.9.9'), named_struct('name', 'Shockwave Flash', 'version', '18.0.0.2'), named_struct('name', 'Java', 'version', '99.0.0.0')) AS p")
    assert df.select(N.flash_version(F.col("p")).alias("v")).first().v == "18.0.0.2"


def test_weeks_and_wednesdays(spark):
    day = lambda d: F.lit(date.fromisoformat(d))
    assert one(spark, N.sunday_week(day("2024-01-07"))) == date(2024, 1, 7) and one(spark, N.sunday_week(day("2024-01-06"))) == date(2023, 12, 31)
    assert [one(spark, N.previous_wednesday(day(d))) for d in ("2024-01-10", "2024-01-09", "2024-01-11")] == [date(2024, 1, 10), date(2024, 1, 3), date(2024, 1, 10)]


def test_usage_and_sessions(spark):
    assert [one(spark, N.usage_hours(F.col("s")), s=s) for s in (-1, 0, 7200, 180 * 86400)] == [0, 0, 2, 0]
    assert [one(spark, N.clamp_session(F.col("s")), s=s) for s in (-5, 10, 10**6)] == [0, 10, 90_000]


def test_sample_id(spark):
    import zlib

    assert one(spark, N.sample_id(F.col("c")), c="c0ffee") == zlib.crc32(b"c0ffee") % 100 and one(spark, N.sample_id(F.col("c")), c=None) is None


@pytest.mark.parametrize(
    "allowed, value, expected",
    [
        ("*", "any text", "any_text"),
        (["foo", "bar", "baz"], "quux", "OTHER"),
        (["foo", "bar", "baz"], "bar", "bar"),
        ({"min": "aaa"}, "100", "OTHER"),
        ({"min": "aaa"}, "bar", "bar"),
        ({"max": "bbb"}, "ccc", "OTHER"),
        ({"max": "bbb"}, "100", "100"),
        ({"min": "aaa", "max": "bbb"}, "aaa", "aaa"),
        ({"min": "aaa", "max": "bbb"}, "bbb", "bbb"),
        ({"min": "aaa", "max": "bbb"}, "aa0", "OTHER"),
        ({"min": "aaa", "max": "bbb"}, "bbc", "OTHER"),
        ("*", "", "UNKNOWN"),
        ("*", None, "UNKNOWN"),
        ("*", "1.23", "1.23"),
    ],
)
def test_dimensions(spark, allowed, value, expected):
    assert one(spark, dims.dimension(F.col("v"), allowed), v=value) == expected


def test_dimension_numbers_and_flags(spark):
    assert one(spark, dims.dimension(F.col("v"), "*"), v=1) == "1" and one(spark, dims.dimension(F.lit(True), "*")) == "true"
    with pytest.raises(ValueError):
        dims.parsed({"dimensions": [{"field_name": "x", "allowed_values": {"least": 1}}]})


def test_fitted_types(spark):
    assert [one(spark, W.fitted(F.col("v"), "SMALLINT"), v=v) for v in (5.9, -40_000.0)] == [5, None]
    assert one(spark, W.fitted(F.col("v"), "CHAR(3)"), v="aéb\nc") == "a?b"
    assert one(spark, W.fitted(F.col("v"), "VARCHAR(9)"), v="ab\0cd") == "ab"
    assert one(spark, W.fitted(F.lit(datetime(1960, 1, 1)), "TIMESTAMP")) is None
    assert one(spark, W.escaped(F.col("v"), "|"), v="a|b\\c\n") == "a\\|b\\\\c\\\n" and one(spark, W.escaped(F.col("v"), "\t"), v="a\tb\n") == "a\\tb\\n"


@pytest.mark.parametrize("topics, servers, start", [([], "h:1", "newest"), ([""], "h:1", "newest"), (["t"], "", "newest"), (["t"], "h:1", "middle"), (["t", ""], "h:1", "oldest")])
def test_topic_options_are_checked(topics, servers, start):
    with pytest.raises(ValueError):
        scan.kafka_options(topics, servers, start)


def test_topic_options():
    assert scan.kafka_options(["a", "b"], "h:1", "oldest")["startingOffsets"] == "earliest"


def test_json_schema():
    schema = {"type": "object", "properties": {"a": {"$ref": "#/definitions/n"}, "b": {"type": ["string", "null"]}, "c": {"type": "array", "items": {"type": "boolean"}}}, "definitions": {"n": {"type": "integer"}}}
    assert scan.from_json_schema(schema).simpleString() == "struct<a:bigint,b:string,c:array<boolean>>"
    assert [f.nullable for f in scan.from_json_schema(schema).fields] == [False, True, False]


def test_sizes_are_rounded_as_printf_has_it(spark):
    """Ties of the double itself go to the even digit; what only its shortest decimal has as a tie is none."""
    numbers = [0.0, 0.125, 0.375, 1.005, 1.015, 0.045, 587.625, 587.635, 0.994999, 0.995, 9.995, 99.99500000000001, 1e-9, 0.15, 0.25, 0.35, -0.125, -2.675, 1023.999, 123456789.125, 3.0000000001]
    got = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", N.fixed(F.col("x"), 2).alias("two"), N.fixed(F.col("x"), 1).alias("one")).collect()
    assert [(r.two, r.one) for r in got] == [(f"{r.x:.2f}", f"{r.x:.1f}") for r in got]
    sizes = spark.createDataFrame([(77809 * 7919 + 1,), (1000,), (1024 + 128,), (5 << 40,)], "n long").select(N.pretty_size(F.col("n")).alias("p"), N.gigabytes(F.col("n")).alias("g"), N.percent(F.col("n"), F.lit(16000)).alias("%")).collect()
    assert [r.p for r in sizes] == [f"{(77809 * 7919 + 1) / 2**20:.2f}MB", "1000B", "1.12KB", "5.00TB"]
    assert [r.g for r in sizes] == [f"{n / 2**30:.2f}GB" for n in (77809 * 7919 + 1, 1000, 1152, 5 << 40)]
    assert [r["%"] for r in sizes] == [f"{100 * n / 16000:.1f}%" for n in (77809 * 7919 + 1, 1000, 1152, 5 << 40)]
