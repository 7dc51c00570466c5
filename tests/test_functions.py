from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import scalars as S
from tidemark.functions import texts as X


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "part,first,second,want",
    [
        ("month", "2024-01-31 00:00:00", "2024-02-01 00:00:00", 1),
        ("year", "2023-12-31 23:59:59", "2024-01-01 00:00:00", 1),
        ("quarter", "2024-03-31 00:00:00", "2024-04-01 00:00:00", 1),
        ("week", "2018-01-06 00:00:00", "2018-01-07 00:00:00", 1),
        ("week", "2018-01-07 00:00:00", "2018-01-06 00:00:00", -1 + 1 - 1),
        ("week", "2018-01-07 00:00:00", "2018-01-13 00:00:00", 0),
        ("day", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("hour", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("minute", "2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
        ("second", "2024-01-01 00:00:00.9", "2024-01-01 00:00:01.1", 1),
        ("millisecond", "2024-01-01 00:00:00.9", "2024-01-01 00:00:01.1", 200),
        ("microsecond", "2024-01-01 00:00:00", "2024-01-02 00:00:00.000005", 86_400_000_005),
        ("hour", "2024-01-02 01:00:00", "2024-01-01 23:00:00", -2),
    ],
)
def test_datediff_counts_boundaries(spark, part, first, second, want):
    assert one(spark, D.datediff(ts(first), ts(second), part)) == want


def test_datediff_rejects_unknown_part():
    with pytest.raises(ValueError):
        D.datediff(F.lit(1), F.lit(2), "fortnight")


def test_dateadd_clamps_month_ends(spark):
    assert one(spark, D.dateadd("month", F.lit(1), ts("2024-01-31 05:00:00"))) == datetime(2024, 2, 29, 5)


@pytest.mark.parametrize("part,want", [("month", date(2024, 2, 29)), ("quarter", date(2024, 3, 31)), ("year", date(2024, 12, 31))])
def test_last_day(spark, part, want):
    assert one(spark, D.last_day(ts("2024-02-10 12:00:00"), part)) == want


def test_surrogate_key_tells_null_from_empty(spark, frame):
    df = frame([("a", None), ("a", "")], "x string, y string")
    keys = [r.k for r in df.select(S.surrogate_key(["x", "y"]).alias("k")).collect()]
    legacy = [r.k for r in df.select(S.surrogate_key(["x", "y"], null_as="").alias("k")).collect()]
    assert keys[0] != keys[1] and legacy[0] == legacy[1]
    with pytest.raises(ValueError):
        S.surrogate_key("x")


def test_safe_arithmetic(spark, frame):
    df = frame([(1, None, 3), (None, None, None)], "a int, b int, c int")
    got = df.select(S.safe_add(["a", "b", "c"]), S.safe_subtract(["a", "b", "c"]), S.safe_divide("a", "c")).collect()
    assert [tuple(r) for r in got] == [(4, -2, pytest.approx(1 / 3)), (0, 0, None)]
    assert one(spark, S.safe_divide(F.lit(7), F.lit(0))) is None
    assert one(spark, S.safe_divide(F.lit(7), F.lit(2))) == 3.5
    for broken in (S.safe_add, S.safe_subtract):
        with pytest.raises(ValueError):
            broken("a")


@pytest.mark.parametrize(
    "value,low,high,n,want",
    [
        (0.0, 0.0, 10.0, 5, 1),  # edge of the first bucket
        (2.0, 0.0, 10.0, 5, 2),  # on an inner edge: the bucket above
        (3.0, 0.0, 10.0, 5, 2),
        (10.0, 0.0, 10.0, 5, 6),
        (12.0, 0.0, 10.0, 5, 7),  # over the maximum and on a multiple: n + 2
        (12.5, 0.0, 10.0, 5, 6),
        (-3.0, 0.0, 10.0, 5, -1),  # not clamped below
        (3.0, 1.0, 11.0, 5, 1),  # the tie rule looks at the value, not at value - low
        (None, 0.0, 10.0, 5, 6),
    ],
)
def test_width_bucket_rules(spark, value, low, high, n, want):
    column = S.width_bucket(F.lit(value).cast("double"), F.lit(low), F.lit(high), F.lit(n))
    assert one(spark, column) == want


def test_haversine(spark):
    points = [F.lit(v) for v in (48.864716, 2.349014, 52.379189, 4.899431)]
    assert round(one(spark, S.haversine_distance(*points, unit="km"))) == 430
    assert round(one(spark, S.haversine_distance(*points))) == 267
    with pytest.raises(ValueError):
        S.haversine_distance(*points, unit="yard")


def test_casts(spark):
    assert one(spark, S.try_cast_to(F.lit("x"), "int")) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, S.cast_to(F.lit("x"), "int"))


def test_equals(spark):
    null = F.lit(None).cast("int")
    assert one(spark, S.equals(null, null)) is None
    assert one(spark, S.equals(null, null, True)) is True
    assert one(spark, S.equals(F.lit(1), null, True)) is False


def test_text_helpers(spark):
    assert one(spark, X.right(F.lit("abcdef"), 2)) == "ef"
    assert one(spark, X.right(F.lit("abcdef"), 9)) == "abcdef"
    assert one(spark, X.right(F.lit("abcdef"), -2)) == "cdef"
    assert one(spark, X.right(F.lit("abcdef"), 0)) == ""
    assert one(spark, X.split_part(F.lit("a|b|c"), "|", -1)) == "c"
    assert one(spark, X.concat([F.lit("a"), F.lit(None)])) is None
    assert one(spark, X.bool_to_text(F.lit(True))) == "true"
    assert X.escape_single_quotes("it's") == "it''s"
    assert one(spark, X.array_construct((), "int")) == []


@pytest.mark.parametrize(
    "url,host,path",
    [
        ("https://a.com/x/y?z=1", "a.com", "x/y"),
        ("http://a.com?z=/q", "a.com", "q"),
        ("a.com", "a.com", "a.com"),
        ("a.com?z=1", "a.com", ""),
        ("android-app://b.c/d", "b.c", "/b.c/d"),
        (None, None, None),
    ],
)
def test_url_parts(spark, url, host, path):
    value = F.lit(url).cast("string")
    assert one(spark, X.url_host(value)) == host
    assert one(spark, X.url_path(value)) == path


def test_url_parameter(spark):
    url = F.lit("https://a.com/?utm_source=x&source=y&empty=")
    assert one(spark, X.url_parameter(url, "utm_source")) == "x"
    assert one(spark, X.url_parameter(url, "source")) == "x"  # plain text: the first text that ends so
    assert one(spark, X.url_parameter(url, "empty")) is None
    assert one(spark, X.url_parameter(url, "none")) is None
