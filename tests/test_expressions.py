"""Scalar expressions: edge values and agreed readings of the data formats."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ripplekit.functions import geo, text, times


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def at(s):
    return F.lit(s).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "day, year, week",
    [("2011-01-01", 2010, 52), ("2010-01-03", 2009, 53), ("2012-12-31", 2013, 1), ("2024-01-01", 2024, 1)],
)
def test_iso_week_at_year_edges(spark, day, year, week):
    assert value(spark, times.iso_year(at(day))) == year
    assert value(spark, times.iso_week(at(day))) == week


@pytest.mark.parametrize(
    "minute, expected",
    [(0, "10:00"), (2, "10:00"), (3, "10:04"), (5, "10:04"), (6, "10:08"), (10, "10:08"), (59, "11:00")],
)
def test_n_minute_bucket_rounds_half_even(spark, minute, expected):
    got = value(spark, times.bucket(at(f"2024-01-05 10:{minute:02d}:30"), "4m"))
    assert got.strftime("%H:%M") == expected


def test_other_buckets(spark):
    ts = at("2024-01-05 10:59:59.999999")
    assert value(spark, times.bucket(ts, "h")) == dt.datetime(2024, 1, 5, 10)
    assert value(spark, times.bucket(ts, "10m")) == dt.datetime(2024, 1, 5, 10, 50)
    assert value(spark, times.bucket(ts, "d")) == dt.datetime(2024, 1, 5)


def test_api_date_drops_the_offset(spark):
    got = value(spark, times.parse_api_date(F.lit("Sat Jan 01 10:11:12 +0800 2011")))
    assert got == dt.datetime(2011, 1, 1, 10, 11, 12)
    assert value(spark, times.parse_api_date(F.lit("yesterday"))) is None


@pytest.mark.parametrize(
    "text_date, utc",
    [
        ("Mon, 01 Jan 2024 10:00:00 +0800", dt.datetime(2024, 1, 1, 2)),
        ("1 Jan 2024 10:00:00 -0330", dt.datetime(2024, 1, 1, 13, 30)),
        ("Mon, 01 Jan 2024 10:00 GMT", dt.datetime(2024, 1, 1, 10)),
        ("Mon, 01 Jan 2024 10:00:00 EST", dt.datetime(2024, 1, 1, 15)),
        ("2024/01/01 10:00:00", dt.datetime(2024, 1, 1, 2)),
        ("2024-01-01", dt.datetime(2023, 12, 31, 16)),
        ("soon", None),
    ],
)
def test_feed_dates(spark, text_date, utc):
    assert value(spark, times.parse_pubdate(F.lit(text_date))) == utc


def test_relative_period_clamps_month_ends(spark):
    def start(spec):
        return value(spark, times.period_start(F.lit(spec), F.lit("2024-03-31").cast("date")))

    assert start("1m") == dt.date(2024, 2, 29)
    assert start("2W") == dt.date(2024, 3, 17)
    assert start("xd") == dt.date(2024, 3, 30)
    assert start("3y") is None


def test_epoch_of_wall_clock(spark):
    ts = at("2011-01-01 08:00:00")
    assert value(spark, times.epoch(ts, "Asia/Hong_Kong", "ms")) == 1293840000000
    assert value(spark, times.epoch(ts)) == 1293868800


@pytest.mark.parametrize(
    "post, names",
    [
        ("好//@小明：同意//@bob: yes//@c d", ["小明", "bob", "c"]),
        ("//@a，b//@【x//@z-1//@w.", ["a", "", "z", "w"]),
        ("no chain @bob", []),
    ],
)
def test_mention_chain_stops_at_delimiters(spark, post, names):
    assert value(spark, text.mentions(F.lit(post))) == names


def test_hashtags_and_links(spark):
    post = F.lit("#tag1 [#b]#c# http://t.cn/aB_9?x http://sinaurl.cn/zz")
    assert value(spark, text.hashtags(post)) == ["tag1", "b", "c#"]
    assert tuple(value(spark, text.short_url(post))) == ("http://t.cn/aB_9", "t.cn", "aB_9")
    assert tuple(value(spark, text.short_url(F.lit("http://x.cn/1")))) == (None, None, None)
    assert tuple(value(spark, text.url_parts(F.lit("http://a.b-c.org/p/q?r")))) == ("a.b-c.org", "p/q?r")


def test_pg_arrays(spark):
    items = F.array(F.lit("a"), F.lit("b,c"), F.lit("d"))
    assert value(spark, text.format_pg_array(items)) == '{a,"b,c",d}'
    assert value(spark, text.parse_pg_array(F.lit('{a,"b,c",d}'))) == ["a", "b,c", "d"]
    assert value(spark, text.parse_pg_array(F.lit("{1,2}"), "bigint")) == [1, 2]


@pytest.mark.parametrize("spec, span", [("3-7", (3, 7)), ("3", (3, 3)), ("3-", (3, 3)), ("x", (None, None))])
def test_page_range(spark, spec, span):
    assert tuple(value(spark, text.page_range(F.lit(spec)))) == span


def test_tokens_mix_words_and_han_bigrams(spark):
    got = value(spark, text.tokens(F.lit("Hello 香港人, 我 ÉTÉ2 x")))
    assert got == ["hello", "香港", "港人", "我", "été2", "x"]
    assert value(spark, text.tokens(F.lit(" .,"))) == []


def test_term_counts(spark):
    got = value(spark, text.term_counts(F.array(*[F.lit(w) for w in "b a b c b a".split()])))
    assert [tuple(x) for x in got] == [("a", 2), ("b", 3), ("c", 1)]
    assert not value(spark, text.term_counts(F.array().cast("array<string>")))


def test_points(spark):
    assert value(spark, geo.wkt_point(F.lit(22.5), F.lit(114.0))) == "SRID=4326;POINT(114.0 22.5)"
    assert value(spark, geo.wkt_from_text(F.lit("22.5 114"))) == "SRID=4326;POINT(114 22.5)"
    assert value(spark, geo.wkt_from_text(F.lit("22.5"))) is None
    km = value(spark, geo.distance_km(F.lit(114.0), F.lit(22.0), F.lit(114.0), F.lit(23.0)))
    assert abs(km - 111.19) < 0.1


def test_csv_quote_and_last_component(spark):
    assert value(spark, text.csv_quote(F.lit('a "b"'))) == '"a ""b"""'
    place = F.lit("Wan Chai, Hong Kong, China")
    assert value(spark, text.last_components(place)) == "China"
    assert value(spark, text.last_components(place, 2)) == "Hong Kong,China"
    assert value(spark, text.last_components(F.lit("China"), 2)) == "China"
