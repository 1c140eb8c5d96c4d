"""Payload normalisers on single records with missing, odd and extra fields."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from ripplekit.operators import nested as N
from ripplekit.operators import normalize as P

NOW = "timestamp_ntz '2024-01-31'"


def payload(spark, schema, *records):
    return P.parse(spark.createDataFrame([(json.dumps(r),) for r in records], "j string"), "j", schema)


DATE = "Sat Jan 01 10:11:12 +0800 2011"


def test_status_with_and_without_nested_parts(spark):
    full = {
        "id": 1, "created_at": DATE, "text": "t", "user": {"id": 9, "screen_name": "s"}, "extra": 1,
        "geo": {"type": "Point", "coordinates": [22.5, 114.25]},
        "retweeted_status": {"id": 7, "created_at": DATE, "text": "o", "user": {"id": 5}},
    }
    bare = {"id": 2, "created_at": "junk", "geo": {"type": "Point", "coordinates": []},
            "retweeted_status": {"id": 8}}
    df = P.post_rows(payload(spark, P.STATUS_SCHEMA, full, bare))
    cols = ["id", "created_at", "user_id", "retweeted_status", "retweeted_status_user_id", "lon", "lat", "geo"]
    assert rows(df, *cols) == [
        (1, dt.datetime(2011, 1, 1, 10, 11, 12), 9, 7, 5, 114.25, 22.5, "SRID=4326;POINT(114.25 22.5)"),
        (2, None, None, 8, None, None, None, None),
    ]
    both = P.with_originals(payload(spark, P.STATUS_SCHEMA, full, bare))
    assert rows(both, "id", "embedded", "user_id", "retweeted_status") == [
        (1, False, 9, 7), (2, False, None, 8), (7, True, 5, None),
    ]


def test_tweet_reply_and_geo_rules(spark):
    df = P.tweet_rows(payload(
        spark, P.TWEET_SCHEMA,
        {"id": 1, "created_at": DATE, "in_reply_to_user_id": "[]", "geo": {"type": "Polygon", "coordinates": [1, 2]}},
        {"id": 2, "created_at": DATE, "in_reply_to_user_id": 12345, "geo": {"type": "Point", "coordinates": [1, 2]}},
        {"id": 3, "created_at": DATE, "geo": {"type": "Point", "coordinates": [1, 2, 3]}},
    ))
    assert rows(df, "id", "in_reply_to_user_id", "geo") == [
        (1, None, None), (2, 12345, "SRID=4326;POINT(2.0 1.0)"), (3, None, None),
    ]


@pytest.mark.parametrize(
    "record, expected",
    [
        ({"venue": {"id": "77", "street": "s"}, "likes": 3}, ("77", 3, 3)),
        ({"venue": {"street": "s", "city": "c"}, "fan_count": 4, "likes": 3}, ("s", 4, 4)),
        ({"venue": {"city": "c"}}, ('{"city":"c"}', 0, 0)),
        ({}, (None, 0, 0)),
    ],
)
def test_object_venue_and_likes(spark, record, expected):
    df = P.fb_object_rows(payload(spark, P.FB_OBJECT_SCHEMA, {"id": 1, **record}), "page", F.expr(NOW))
    assert rows(df, "venue", "likes", "fan_count") == [expected]


def test_wall_post_and_children(spark):
    post = {
        "id": "1_2", "from": {"id": 5}, "to": {"data": [{"id": 6}, {"id": 7}]}, "properties": [{"name": "n"}],
        "comments": {"data": [{"id": "c", "from": {"id": 8}, "message": "m"}]}, "likes": {"data": [{"id": 9}]},
    }
    lone = {"id": "3", "to": {"data": []}, "comments": {"count": 4}}
    df = payload(spark, P.FB_POST_SCHEMA, post, lone)
    assert rows(P.fb_post_rows(df, F.expr(NOW)), "id", "from", "to", "properties", "comments_count") == [
        ("1_2", 5, 6, '[{"name":"n"}]', 1), ("3", None, None, None, 4),
    ]
    comments, likes = N.post_children(df)
    assert rows(comments, "id", "from", "pid") == [("c", 8, "1_2")]
    assert rows(likes) == [(9, "1_2")]


def test_activity_attachments_without_key_are_skipped(spark):
    df = payload(spark, P.GPLUS_ACTIVITY_SCHEMA, {
        "id": "a", "geocode": "22.5 114", "actor": {"id": "u"},
        "access": {"kind": "k", "items": [{"type": "public"}, {"id": "x", "type": "circle"}]},
        "object": {"objectType": "note", "content": "", "replies": {"totalItems": 2},
                   "attachments": [{"url": "http://1", "image": {"url": "i", "height": 3}}, {"id": "2"}, {"objectType": "v"}]},
    }, {"id": "b", "geocode": "22.5"})
    assert rows(P.gplus_rows(df, "activity"), "id", "content", "replies_totalitems", "attachments_totalitems", "geocode") == [
        ("a", None, 2, 3, "SRID=4326;POINT(114 22.5)"), ("b", None, None, None, None),
    ]
    attached, bridge = N.attachments(df)
    assert rows(attached, "attachment_url", "image_url", "image_height") == [("2", None, None), ("http://1", "i", 3)]
    assert rows(bridge) == [("a", "2"), ("a", "http://1")]
    access, bridge = N.accesses(df)
    assert rows(access) == [("x", "circle")] and rows(bridge) == [("a", "x")]


def test_qq_prefixes_codes_and_empty_text(spark):
    df = P.qq_rows(payload(spark, P.QQ_POST_SCHEMA, {
        "id": 1, "text": "", "video": {"title": "v", "picurl": "p"}, "music": {"author": "m"}, "image": ["a,b", "c"],
    }), "post")
    assert rows(df, "text", "video_title", "video_picurl", "music_author", "image") == [(None, "v", "p", "m", ["a,b", "c"])]
    user = P.qq_rows(payload(spark, P.QQ_USER_SCHEMA, {"name": "n", "nick": "", "country_code": "x", "birth_year": "1980"}), "user")
    assert rows(user, "name", "nick", "country_code", "birth_year") == [("n", None, None, 1980)]


def test_geo_hits_fall_back_to_the_location(spark):
    hit = {"created_at": "Sat, 01 Jan 2011 10:11:12 +0000", "text": "t"}
    df = P.geo_rows(payload(
        spark, P.GEO_SEARCH_SCHEMA,
        {"id": 1, "geo": {"coordinates": [22.1, 114.1]}, "location": "x", **hit},
        {"id": 2, "location": "22.3,114.2", **hit}, {"id": 3, "location": "22 north", **hit},
        {"id": 4, "location": "Paris", **hit},
    ), "22")
    assert rows(df, "id", "lat", "lng", "created_at") == [
        (1, 22.1, 114.1, dt.datetime(2011, 1, 1, 10, 11, 12)), (2, 22.3, 114.2, dt.datetime(2011, 1, 1, 10, 11, 12)),
        (3, None, None, dt.datetime(2011, 1, 1, 10, 11, 12)),
    ]


def test_author_name_fallback_and_comment_text(spark):
    users = [{"screen_name": "s", "name": "n"}, {"name": "n", "domain": "d"}, {"domain": "d"}, {}]
    df = payload(spark, P.STATUS_SCHEMA, *[{"id": i, "user": u} for i, u in enumerate(users)])
    assert rows(df.select("id", P.author_name().alias("a"))) == [(0, "s"), (1, "n"), (2, "d"), (3, None)]
    comments = payload(spark, P.COMMENT_SCHEMA, {"id": 1, "created_at": DATE, "text": "", "user": {"id": 3}})
    assert rows(P.comment_rows(comments, F.lit(9)), "text", "user_id", "status_id") == [(None, 3, 9)]


def test_conform_and_members(spark):
    df = spark.createDataFrame([(1, "5", "x")], "id int, n string, unknown string")
    want = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("gone", T.StringType())])
    got = P.conform(df, want)
    assert rows(got) == [(1, 5, None)] and got.schema == want
    member = "STRUCT<data ARRAY<STRUCT<uid BIGINT, name STRING, rsvp_status STRING>>>"
    schema = "id BIGINT, " + ", ".join(f"{c} {member}" for c in N.EVENT_MEMBER_LISTS)
    event = payload(spark, schema, {"id": 1, "maybe": {"data": [{"uid": 3, "name": "m"}]}, "invited": {"data": [{"uid": 2, "name": "i", "rsvp_status": "unsure"}]}})
    users, bridge = N.members(event, "event", F.expr(NOW))
    assert rows(users) == [(2, "i"), (3, "m")]
    assert rows(bridge, "uid", "eid", "rsvp_status") == [(2, 1, "unsure"), (3, 1, None)]
