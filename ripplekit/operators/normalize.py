"""Payload -> row normalisers for the networks' nested JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplekit.functions.geo import wkt_from_text, wkt_point
from ripplekit.functions.times import parse_api_date
from ripplekit.operators.filters import geo_or_location

# Field names and types of the networks' payloads (Spark DDL).
STATUS_FIELDS = (
    "id BIGINT, created_at STRING, text STRING, source STRING, location STRING, "
    "thumbnail_pic STRING, bmiddle_pic STRING, original_pic STRING, "
    "in_reply_to_user_id BIGINT, in_reply_to_screen_name STRING, in_reply_to_status_id BIGINT, "
    "truncated BOOLEAN, reposts_count INT, comments_count INT, attitudes_count INT, mlevel INT, "
    "deleted STRING, geo STRUCT<type STRING, coordinates ARRAY<DOUBLE>>, "
    "user STRUCT<id BIGINT, screen_name STRING, name STRING, domain STRING>"
)
STATUS_SCHEMA = f"{STATUS_FIELDS}, retweeted_status STRUCT<{STATUS_FIELDS}>"
USER_SCHEMA = (
    "id BIGINT, created_at STRING, name STRING, screen_name STRING, location STRING, "
    "description STRING, profile_image_url STRING, url STRING, avatar_large STRING, "
    "verified_reason STRING, province INT, city INT, domain STRING, gender STRING, "
    "followers_count BIGINT, friends_count BIGINT, favourites_count INT, time_zone STRING, "
    "profile_background_image_url STRING, profile_use_background_image STRING, "
    "allow_all_act_msg BOOLEAN, geo_enabled BOOLEAN, verified BOOLEAN, following BOOLEAN, "
    "statuses_count BIGINT, allow_all_comment BOOLEAN, bi_followers_count INT, deleted STRING, "
    "verified_type INT, lang STRING, online_status INT"
)
COMMENT_SCHEMA = "id BIGINT, created_at STRING, text STRING, user STRUCT<id BIGINT>"
TWEET_SCHEMA = (
    "id BIGINT, created_at STRING, text STRING, in_reply_to_user_id STRING, "
    "in_reply_to_screen_name STRING, in_reply_to_status_id BIGINT, retweet_count STRING, "
    "source STRING, retweeted_status STRUCT<id BIGINT>, "
    "user STRUCT<id BIGINT, screen_name STRING>, "
    "geo STRUCT<type STRING, coordinates ARRAY<DOUBLE>>"
)
TWITTER_USER_SCHEMA = (
    "id BIGINT, name STRING, screen_name STRING, description STRING, profile_image_url STRING, "
    "url STRING, followers_count BIGINT, utc_offset INT, time_zone STRING, "
    "profile_background_image_url STRING, friends_count BIGINT, created_at STRING, "
    "favourites_count INT, notifications BOOLEAN, geo_enabled BOOLEAN, protected BOOLEAN, "
    "verified BOOLEAN, statuses_count BIGINT, lang STRING, contributors_enabled BOOLEAN, "
    "follow_request_sent BOOLEAN, listed_count INT, show_all_inline_media BOOLEAN, location STRING"
)
FB_OBJECT_SCHEMA = (
    "id BIGINT, type STRING, name STRING, first_name STRING, last_name STRING, "
    "description STRING, link STRING, location STRING, icon STRING, picture STRING, "
    "website STRING, products STRING, founded STRING, company_overview STRING, mission STRING, "
    "owner STRUCT<id BIGINT, name STRING>, venue STRING, fan_count BIGINT, likes BIGINT, "
    "members ARRAY<STRUCT<id BIGINT, name STRING>>"
)
FB_CHILD = "STRUCT<id STRING, from STRUCT<id BIGINT, name STRING>, message STRING, created_time STRING>"
FB_POST_SCHEMA = (
    "id STRING, type STRING, message STRING, name STRING, caption STRING, description STRING, "
    "link STRING, icon STRING, picture STRING, created_time STRING, updated_time STRING, "
    "from STRUCT<id BIGINT, name STRING>, to STRUCT<data ARRAY<STRUCT<id BIGINT, name STRING>>>, "
    f"properties STRING, comments STRUCT<count BIGINT, data ARRAY<{FB_CHILD}>>, "
    "likes STRUCT<data ARRAY<STRUCT<id BIGINT, name STRING>>>"
)
GPLUS_CHILD = (
    "STRUCT<value STRING, type STRING, name STRING, department STRING, title STRING, "
    "startdate STRING, enddate STRING, location STRING, description STRING, primary BOOLEAN>"
)
GPLUS_PERSON_SCHEMA = (
    "id STRING, displayName STRING, url STRING, objectType STRING, nickname STRING, "
    "tagline STRING, birthday STRING, currentLocation STRING, relationshipStatus STRING, "
    "hasApp BOOLEAN, aboutMe STRING, gender STRING, languagesSpoken ARRAY<STRING>, "
    "image STRUCT<url STRING>, "
    "name STRUCT<familyName STRING, givenName STRING, middleName STRING, honorificPrefix STRING, "
    "honorificSuffix STRING>, "
    f"urls ARRAY<{GPLUS_CHILD}>, emails ARRAY<{GPLUS_CHILD}>, placesLived ARRAY<{GPLUS_CHILD}>, "
    f"organizations ARRAY<{GPLUS_CHILD}>"
)
GPLUS_IMAGE = "STRUCT<url STRING, type STRING, height INT, width INT>"
GPLUS_ACTIVITY_SCHEMA = (
    "id STRING, title STRING, url STRING, verb STRING, annotation STRING, crosspostSource STRING, "
    "address STRING, placeId STRING, placeName STRING, geocode STRING, published STRING, "
    "updated STRING, image STRUCT<url STRING>, provider STRUCT<title STRING>, "
    "actor STRUCT<id STRING, displayName STRING>, "
    "access STRUCT<kind STRING, items ARRAY<STRUCT<id STRING, type STRING>>>, "
    "object STRUCT<objectType STRING, originalContent STRING, content STRING, "
    "replies STRUCT<totalItems BIGINT>, plusoners STRUCT<totalItems BIGINT>, "
    "resharers STRUCT<totalItems BIGINT>, "
    "attachments ARRAY<STRUCT<id STRING, objectType STRING, displayName STRING, content STRING, "
    f"url STRING, image {GPLUS_IMAGE}, fullImage {GPLUS_IMAGE}, embed {GPLUS_IMAGE}>>>"
)
GPLUS_COMMENT_SCHEMA = (
    "id STRING, verb STRING, published STRING, updated STRING, actor STRUCT<id STRING>, "
    "object STRUCT<objectType STRING, content STRING>, inReplyTo ARRAY<STRUCT<id STRING>>"
)
QQ_POST_SCHEMA = (
    "id BIGINT, timestamp BIGINT, text STRING, origtext STRING, name STRING, nick STRING, "
    "`from` STRING, location STRING, image ARRAY<STRING>, "
    "video STRUCT<picurl STRING, player STRING, realurl STRING, shorturl STRING, title STRING>, "
    "music STRUCT<author STRING, url STRING, title STRING>"
)
QQ_USER_SCHEMA = (
    "name STRING, nick STRING, location STRING, introduction STRING, verifyinfo STRING, "
    "email STRING, fansnum BIGINT, idolnum BIGINT, country_code STRING, province_code STRING, "
    "city_code STRING, birth_year STRING, birth_month STRING, birth_day STRING, "
    "tag ARRAY<STRUCT<id STRING, name STRING>>, edu ARRAY<STRUCT<id INT, name STRING>>"
)
GEO_SEARCH_SCHEMA = (
    "id BIGINT, from_user_id BIGINT, from_user STRING, location STRING, iso_language_code STRING, "
    "created_at STRING, text STRING, geo STRUCT<coordinates ARRAY<DOUBLE>>"
)

MINIMAL_PROFILE = ["id"]
BASE_PROFILE = ["id", "screen_name"]
EXTRA_PROFILE = [
    "name", "screen_name", "domain", "province", "city", "gender", "followers_count",
    "friends_count", "retrieved",
]


def parse(df: DataFrame, json_col: str, schema: str) -> DataFrame:
    """Parse a JSON text column into top-level payload columns."""
    return df.select(F.from_json(json_col, schema).alias("p")).select("p.*")


def _nonempty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _point(geo: str) -> tuple[Column, Column]:
    """Longitude and latitude of a payload ``[lat, lng]`` pair."""
    pair = F.col(f"{geo}.coordinates")
    ok = F.size(pair) >= 2
    return F.when(ok, F.get(pair, 1)), F.when(ok, F.get(pair, 0))


def author_name(user: str = "user") -> Column:
    return F.coalesce(F.col(f"{user}.screen_name"), F.col(f"{user}.name"), F.col(f"{user}.domain"))


def post_rows(payload: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    lon, lat = _point("geo")
    plain = [
        "id", "text", "source", "location", "thumbnail_pic", "bmiddle_pic", "original_pic",
        "in_reply_to_user_id", "in_reply_to_screen_name", "in_reply_to_status_id", "truncated",
        "reposts_count", "comments_count", "attitudes_count", "mlevel", "deleted",
    ]
    return payload.select(
        *plain,
        parse_api_date(F.col("created_at")).alias("created_at"),
        F.col("user.id").alias("user_id"),
        F.col("user.screen_name").alias("screen_name"),
        F.col("retweeted_status.id").alias("retweeted_status"),
        F.col("retweeted_status.user.id").alias("retweeted_status_user_id"),
        lon.alias("lon"),
        lat.alias("lat"),
        wkt_point(lat, lon).alias("geo"),
        *keep,
    )


def with_originals(payload: DataFrame) -> DataFrame:
    """Rows of the posts and of the originals embedded in them (when dated).

    Both come out of one pass over the payloads: each record becomes an array
    of itself and its original.
    """
    original = payload.schema["retweeted_status"].dataType
    fields = [f.name for f in original.fields]
    itself = F.struct(*fields, "retweeted_status", F.lit(False).alias("embedded"))
    inner = F.struct(
        *[F.col(f"retweeted_status.{f}").alias(f) for f in fields],
        F.lit(None).cast(original).alias("retweeted_status"),
        F.lit(True).alias("embedded"),
    )
    records = F.filter(F.array(itself, inner), lambda r: ~r["embedded"] | r["created_at"].isNotNull())
    return post_rows(payload.select(F.explode(records).alias("r")).select("r.*"), ("embedded",))


def user_rows(payload: DataFrame, as_of: Column) -> DataFrame:
    return payload.withColumns(
        {"created_at": parse_api_date(F.col("created_at")), "retrieved": as_of}
    )


def comment_rows(payload: DataFrame, status_id: Column) -> DataFrame:
    return payload.select(
        "id",
        parse_api_date(F.col("created_at")).alias("created_at"),
        _nonempty(F.col("text")).alias("text"),
        F.col("user.id").alias("user_id"),
        status_id.alias("status_id"),
    )


def tweet_rows(payload: DataFrame) -> DataFrame:
    lon, lat = _point("geo")
    is_point = (F.col("geo.type") == "Point") & (F.size("geo.coordinates") == 2)
    reply = F.col("in_reply_to_user_id")
    return payload.select(
        "id",
        parse_api_date(F.col("created_at")).alias("created_at"),
        "text",
        F.when(F.length(reply) != 2, reply).try_cast("bigint").alias("in_reply_to_user_id"),
        "in_reply_to_screen_name",
        "in_reply_to_status_id",
        "retweet_count",
        "source",
        F.col("retweeted_status.id").alias("retweeted_status"),
        F.col("user.id").alias("user_id"),
        F.col("user.screen_name").alias("screen_name"),
        F.when(is_point, wkt_point(lat, lon)).alias("geo"),
    )


def twitter_user_rows(payload: DataFrame, as_of: Column) -> DataFrame:
    return user_rows(payload, as_of)


def fb_object_rows(payload: DataFrame, kind: str, as_of: Column) -> DataFrame:
    """Page, group, event, application or user row of the declared ``kind``."""
    likes = F.coalesce("fan_count", "likes", F.lit(0))
    venue = F.coalesce(
        F.get_json_object("venue", "$.id"), F.get_json_object("venue", "$.street"), F.col("venue")
    )
    return payload.withColumns(
        {
            "type": F.lit(kind),
            "owner": F.col("owner.id"),
            "venue": venue,
            "likes": likes,
            "fan_count": likes,
            "members_count": F.when(F.col("members").isNotNull(), F.size("members")),
            "retrieved": as_of,
        }
    ).drop("members")


def fb_post_rows(payload: DataFrame, as_of: Column) -> DataFrame:
    comments_count = F.coalesce(
        F.col("comments.count"),
        F.when(F.col("comments.data").isNotNull(), F.size("comments.data")).cast("bigint"),
    )
    return payload.select(
        "id", "type", "message", "name", "caption", "description", "link", "icon", "picture",
        "created_time", "updated_time", "properties",
        F.col("from.id").alias("from"),
        F.get("to.data", F.lit(0))["id"].alias("to"),
        F.to_json("comments").alias("comments"),
        comments_count.alias("comments_count"),
        as_of.alias("retrieved"),
    )


def gplus_rows(payload: DataFrame, kind: str) -> DataFrame:
    """Person, activity or comment row; column names are lower-cased."""
    if kind == "person":
        names = ["familyName", "givenName", "middleName", "honorificPrefix", "honorificSuffix"]
        plain = [
            "displayName", "url", "objectType", "nickname", "tagline", "birthday",
            "currentLocation", "relationshipStatus", "hasApp", "aboutMe", "gender",
            "languagesSpoken",
        ]
        return payload.select(
            "id",
            *[F.col(c).alias(c.lower()) for c in plain],
            *[_nonempty(F.col(f"name.{c}")).alias(c.lower()) for c in names],
            F.col("image.url").alias("image_url"),
        )
    if kind == "comment":
        return payload.select(
            "id", "verb", "published", "updated",
            F.col("actor.id").alias("actor_id"),
            _nonempty(F.col("object.objectType")).alias("objecttype"),
            _nonempty(F.col("object.content")).alias("content"),
            F.filter(F.transform("inReplyTo", lambda x: x["id"]), lambda x: x.isNotNull()).alias(
                "inreplyto"
            ),
        )
    plain = [
        "title", "url", "verb", "annotation", "crosspostSource", "address", "placeId", "placeName",
        "published", "updated",
    ]
    return payload.select(
        "id",
        *[F.col(c).alias(c.lower()) for c in plain],
        F.col("image.url").alias("image_url"),
        F.col("provider.title").alias("provider_title"),
        F.col("actor.id").alias("actor_id"),
        F.col("access.kind").alias("access_kind"),
        *[
            _nonempty(F.col(f"object.{c}")).alias(c.lower())
            for c in ["objectType", "originalContent", "content"]
        ],
        *[
            F.col(f"object.{c}.totalItems").alias(f"{c}_totalitems")
            for c in ["replies", "plusoners", "resharers"]
        ],
        F.when(F.col("object.attachments").isNotNull(), F.size("object.attachments")).alias(
            "attachments_totalitems"
        ),
        wkt_from_text(F.col("geocode")).alias("geocode"),
    )


def qq_rows(payload: DataFrame, kind: str) -> DataFrame:
    """Post row with ``video_`` / ``music_`` columns, or user row with numeric codes."""
    if kind == "user":
        codes = ["country_code", "province_code", "city_code", "birth_year", "birth_month", "birth_day"]
        texts = ["name", "nick", "location", "introduction", "verifyinfo", "email"]
        return payload.select(
            *[_nonempty(F.col(c)).alias(c) for c in texts],
            "fansnum",
            "idolnum",
            *[F.col(c).try_cast("int").alias(c) for c in codes],
        )
    video = ["picurl", "player", "realurl", "shorturl", "title"]
    texts = ["text", "origtext", "name", "nick", "from", "location"]
    return payload.select(
        "id",
        "timestamp",
        *[_nonempty(F.col(c)).alias(c) for c in texts],
        F.when(F.size("image") > 0, F.col("image")).alias("image"),
        *[_nonempty(F.col(f"video.{c}")).alias(f"video_{c}") for c in video],
        *[_nonempty(F.col(f"music.{c}")).alias(f"music_{c}") for c in ["author", "url", "title"]],
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns only: missing ones as typed nulls, unknown ones dropped."""
    have = set(df.columns)
    return df.select(
        [
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def geo_rows(payload: DataFrame, lat_prefix: str) -> DataFrame:
    """Geo-search hits: coordinates from ``geo``, else from a "lat,lng" location."""
    parts = F.split("location", ",")
    from_text = F.col("geo").isNull() & F.col("location").startswith(lat_prefix) & (F.size(parts) > 1)

    def coordinate(i: int) -> Column:
        return F.coalesce(
            F.get("geo.coordinates", F.lit(i)),
            F.when(from_text, F.get(parts, F.lit(i)).try_cast("double")),
        )

    stamp = F.regexp_replace("created_at", r"^\w{3}, (.*) \+0000$", "$1")
    return geo_or_location(payload, lat_prefix).select(
        "id", "from_user_id", "from_user",
        coordinate(0).alias("lat"),
        coordinate(1).alias("lng"),
        F.coalesce("iso_language_code", F.lit("")).alias("iso_language_code"),
        F.try_to_timestamp(stamp, F.lit("dd MMM yyyy HH:mm:ss")).cast("timestamp_ntz").alias("created_at"),
        "text",
    )


def select_profile(df: DataFrame, users: DataFrame, extra: bool = False, minimal: bool = False) -> DataFrame:
    """Attach the chosen author columns; unused user columns are never scanned."""
    wanted = MINIMAL_PROFILE if minimal else EXTRA_PROFILE if extra else BASE_PROFILE
    have = [c for c in wanted if c in users.columns]
    profile = users.select(
        F.col("id").alias("user_id_ref"), *[F.col(c).alias(f"user_{c}") for c in have if c != "id"]
    )
    return df.join(profile, df["user_id"] == profile["user_id_ref"], "left")
