"""Payload projections (P) and generators (N, U5).

Each query spells whole-table rows out as JSON text, as the networks' APIs do,
then parses and normalises that text; the checking SQL selects the columns directly.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplekit.operators import nested as N
from ripplekit.operators import normalize as P
from ripplekit.plans.catalog.base import AS_OF, api_date, joined, ntz, query

C, L = F.col, F.lit


def text_of(**fields):
    """JSON text of a payload; null fields are absent, as in the API."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def obj(**fields):
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def if_set(cond, value):
    return F.when(cond, value)


def point(kind="Point"):
    return if_set(C("lat").isNotNull(), obj(type=L(kind), coordinates=F.array(C("lat"), C("lon"))))


def status_json():
    original = obj(
        id=C("retweeted_status"), created_at=api_date("o_created_at"), text=C("o_text"),
        user=if_set(C("o_user_id").isNotNull(), obj(id=C("o_user_id"), screen_name=C("o_screen_name"))),
    )
    return text_of(
        id=C("id"), created_at=api_date("created_at"), text=C("text"), geo=point(),
        user=obj(id=C("user_id"), screen_name=C("screen_name")),
        retweeted_status=if_set(C("retweeted_status").isNotNull(), original),
    )


def statuses(t):
    return P.parse(t.status.select(status_json().alias("j")), "j", P.STATUS_SCHEMA)


WKT = "'SRID=4326;POINT(' || CAST({lon} AS STRING) || ' ' || CAST({lat} AS STRING) || ')'"


@query("P1_post_rows", f"""
SELECT id, date_trunc('second', created_at) AS created_at, text, user_id, screen_name, retweeted_status,
  o_user_id AS retweeted_status_user_id, lon, lat, {WKT.format(lon='lon', lat='lat')} AS geo FROM r_status""")
def _(t):
    return P.post_rows(statuses(t)).select(
        "id", "created_at", "text", "user_id", "screen_name", "retweeted_status",
        "retweeted_status_user_id", "lon", "lat", "geo",
    )


@query("P2_embedded_repost_rows", """
SELECT id, date_trunc('second', created_at) AS created_at, text, user_id, retweeted_status, FALSE AS embedded FROM r_status
UNION ALL SELECT retweeted_status, date_trunc('second', o_created_at), o_text, o_user_id, NULL, TRUE FROM r_status
WHERE o_created_at IS NOT NULL""")
def _(t):
    return P.with_originals(statuses(t)).select(
        "id", "created_at", "text", "user_id", "retweeted_status", "embedded"
    )


def user_json(extra=None):
    fields = dict(
        id=C("id"), created_at=api_date("created_at"), name=F.concat(L("n"), C("id")),
        screen_name=C("screen_name"), province=C("province"), city=C("city"), gender=C("gender"),
        followers_count=C("followers_count"), verified=C("id") % 2 == 0,
    )
    return text_of(**fields)


@query("P3_user_rows", """
SELECT id, created_at, 'n' || CAST(id AS STRING) AS name, screen_name, province, city, gender, followers_count,
  id % 2 = 0 AS verified, TIMESTAMP '2024-01-31' AS retrieved FROM r_users""")
def _(t):
    payload = P.parse(t.users.select(user_json().alias("j")), "j", P.USER_SCHEMA)
    return P.user_rows(payload, ntz(AS_OF)).select(
        "id", "created_at", "name", "screen_name", "province", "city", "gender", "followers_count",
        "verified", "retrieved",
    )


@query("P4_comment_rows", """
SELECT id, date_trunc('second', created_at) AS created_at, CASE WHEN id % 4 <> 0 THEN 'c' || CAST(id AS STRING) END AS text,
  user_id, status_id FROM r_comments""")
def _(t):
    body = F.when(C("id") % 4 == 0, "").otherwise(F.concat(L("c"), C("id")))
    rows = t.comments.select(
        "status_id",
        text_of(id=C("id"), created_at=api_date("created_at"), text=body, user=obj(id=C("user_id"))).alias("j"),
    )
    payload = rows.select("status_id", F.from_json("j", P.COMMENT_SCHEMA).alias("p")).select("status_id", "p.*")
    return P.comment_rows(payload, C("status_id"))


@query("P5_screen_name_fallback", """
SELECT id, CASE id % 4 WHEN 0 THEN screen_name WHEN 1 THEN 'name' || CAST(id AS STRING) WHEN 2 THEN 'dom' END AS author FROM r_users""")
def _(t):
    k = C("id") % 4
    user = obj(
        id=C("id"), screen_name=if_set(k == 0, C("screen_name")),
        name=if_set(k <= 1, F.concat(L("name"), C("id"))), domain=if_set(k <= 2, L("dom")),
    )
    payload = P.parse(t.users.select(text_of(id=C("id"), user=user).alias("j")), "j", P.STATUS_SCHEMA)
    return payload.select("id", P.author_name().alias("author"))


@query("P6_tweet_rows", f"""
SELECT id, date_trunc('second', created_at) AS created_at, text, CASE WHEN id % 4 <> 0 AND length(CAST(user_id AS STRING)) <> 2 THEN user_id END AS in_reply_to_user_id,
  CASE WHEN id % 5 = 0 THEN '100+' ELSE '7' END AS retweet_count, retweeted_status, user_id, screen_name,
  {WKT.format(lon='lon', lat='lat')} AS geo FROM r_status""")
def _(t):
    reply = F.when(C("id") % 4 == 0, "[]").otherwise(C("user_id").cast("string"))
    j = text_of(
        id=C("id"), created_at=api_date("created_at"), text=C("text"), in_reply_to_user_id=reply,
        retweet_count=F.when(C("id") % 5 == 0, "100+").otherwise("7"), geo=point(),
        retweeted_status=if_set(C("retweeted_status").isNotNull(), obj(id=C("retweeted_status"))),
        user=obj(id=C("user_id"), screen_name=C("screen_name")),
    )
    return P.tweet_rows(P.parse(t.status.select(j.alias("j")), "j", P.TWEET_SCHEMA)).select(
        "id", "created_at", "text", "in_reply_to_user_id", "retweet_count", "retweeted_status",
        "user_id", "screen_name", "geo",
    )


@query("P7_twitter_user_rows", """
SELECT id, 'n' || CAST(id AS STRING) AS name, screen_name, followers_count, created_at, id % 2 = 0 AS verified,
  TIMESTAMP '2024-01-31' AS retrieved FROM r_users""")
def _(t):
    payload = P.parse(t.users.select(user_json().alias("j")), "j", P.TWITTER_USER_SCHEMA)
    return P.twitter_user_rows(payload, ntz(AS_OF)).select(
        "id", "name", "screen_name", "followers_count", "created_at", "verified", "retrieved"
    )


@query("P8_fb_object_rows", """
SELECT id, 'group' AS type, name, link, CASE WHEN id % 2 = 0 THEN id + 1 END AS owner,
  CASE id % 4 WHEN 0 THEN CAST(id AS STRING) WHEN 1 THEN 'street ' || CAST(id AS STRING) WHEN 2 THEN '{"city":"c"}' END AS venue,
  CASE id % 3 WHEN 0 THEN id WHEN 1 THEN 9 ELSE 0 END AS likes, CASE id % 3 WHEN 0 THEN id WHEN 1 THEN 9 ELSE 0 END AS fan_count,
  CASE WHEN id % 5 = 0 THEN 2 END AS members_count FROM r_objects""")
def _(t):
    k = C("id") % 4
    venue = obj(
        id=if_set(k == 0, C("id").cast("string")),
        street=if_set(k == 1, F.concat(L("street "), C("id"))), city=if_set(k == 2, L("c")),
    )
    people = F.array(obj(id=C("id"), name=L("a")), obj(id=C("id") + 1, name=L("b")))
    j = text_of(
        id=C("id"), name=C("name"), link=C("link"),
        owner=if_set(C("id") % 2 == 0, obj(id=C("id") + 1)), venue=if_set(k < 3, venue),
        fan_count=if_set(C("id") % 3 == 0, C("id")), likes=if_set(C("id") % 3 == 1, L(9)),
        members=if_set(C("id") % 5 == 0, people),
    )
    payload = P.parse(t.objects.select(j.alias("j")), "j", P.FB_OBJECT_SCHEMA)
    return P.fb_object_rows(payload, "group", ntz(AS_OF)).select(
        "id", "type", "name", "link", "owner", "venue", "likes", "fan_count", "members_count"
    )


def wall_posts(t):
    """Wall posts with up to two comments and likes each."""
    k = C("id") % 3
    comment = lambda n: obj(
        id=F.concat(C("id"), L(f"_{n}")), message=F.concat(L(f"m{n} "), C("screen_name")),
        **{"from": obj(id=C("user_id") + n, name=C("screen_name"))},
    )
    comments = obj(
        count=if_set(C("id") % 2 == 0, L(8)),
        data=F.when(k == 1, F.array(comment(1))).when(k == 2, F.array(comment(1), comment(2))),
    )
    likes = if_set(k == 2, obj(data=F.array(obj(id=C("user_id")), obj(id=C("user_id") + 1))))
    j = text_of(
        id=C("id").cast("string"), message=C("text"), type=L("status"),
        properties=if_set(k == 0, F.array(obj(name=L("p"), text=C("screen_name")))),
        to=if_set(k == 1, obj(data=F.array(obj(id=C("user_id") * 2), obj(id=L(1))))),
        comments=comments, likes=likes, **{"from": obj(id=C("user_id"), name=C("screen_name"))},
    )
    return P.parse(t.posts.select(j.alias("j")), "j", P.FB_POST_SCHEMA)


@query("P9_fb_post_rows", """
SELECT CAST(id AS STRING) AS id, text AS message, user_id AS "from", CASE WHEN id % 3 = 1 THEN user_id * 2 END AS "to",
  CASE WHEN id % 3 = 0 THEN '[{"name":"p","text":"' || screen_name || '"}]' END AS properties,
  CASE WHEN id % 2 = 0 THEN 8 WHEN id % 3 = 0 THEN NULL ELSE id % 3 END AS comments_count FROM r_posts""")
def _(t):
    return P.fb_post_rows(wall_posts(t), ntz(AS_OF)).select(
        "id", "message", "from", "to", "properties", "comments_count"
    )


def people(t):
    j = text_of(
        id=C("id").cast("string"), displayName=C("screen_name"), gender=C("gender"),
        aboutMe=F.concat(L("about "), C("id")),
        image=if_set(C("id") % 2 == 0, obj(url=F.concat(L("http://img/"), C("id")))),
        name=obj(familyName=F.concat(L("f"), C("id")), givenName=F.when(C("id") % 3 == 0, "").otherwise("g")),
        urls=F.array(
            obj(value=F.concat(L("http://a/"), C("id")), type=L("home"), primary=C("id") % 2 == 0),
            obj(value=F.concat(L("http://b/"), C("id")), type=L("work"), primary=L(False)),
        ),
        emails=if_set(C("id") % 4 == 0, F.array(obj(value=F.concat(C("id"), L("@x.org")), type=L("home")))),
        placesLived=F.array(obj(value=F.concat(L("city"), C("city")), primary=C("city") == 1)),
        organizations=if_set(
            C("id") % 5 == 0, F.array(obj(name=L("org"), title=F.concat(L("t"), C("id")), department=L("d")))
        ),
    )
    return P.parse(t.users.select(j.alias("j")), "j", P.GPLUS_PERSON_SCHEMA)


@query("P10_gplus_rows_person", """
SELECT CAST(id AS STRING) AS id, screen_name AS displayname, gender, 'about ' || CAST(id AS STRING) AS aboutme,
  CASE WHEN id % 2 = 0 THEN 'http://img/' || CAST(id AS STRING) END AS image_url, 'f' || CAST(id AS STRING) AS familyname,
  CASE WHEN id % 3 <> 0 THEN 'g' END AS givenname FROM r_users""")
def _(t):
    return P.gplus_rows(people(t), "person").select(
        "id", "displayname", "gender", "aboutme", "image_url", "familyname", "givenname"
    )


def activities(t):
    image = obj(url=F.concat(L("http://thumb/"), C("user_id")), type=L("image/jpeg"), height=L(90), width=L(120))
    no_text, no_image = L(None).cast("string"), if_set(L(False), image)
    item = lambda kind, id, url, image: obj(objectType=L(kind), id=id, url=url, image=image)
    photo = item("photo", no_text, F.concat(L("http://photo/"), C("user_id")), image)
    article = item("article", F.concat(L("a"), C("user_id")), no_text, no_image)
    unkeyed = item("video", no_text, no_text, no_image)
    k = C("id") % 3
    j = text_of(
        id=C("id").cast("string"), title=C("screen_name"), verb=L("post"),
        actor=obj(id=C("user_id").cast("string"), displayName=C("screen_name")),
        provider=if_set(C("id") % 2 == 0, obj(title=L("web"))),
        geocode=if_set(C("lat").isNotNull(), F.concat(C("lat").cast("string"), L(" "), C("lon").cast("string"))),
        access=obj(
            kind=L("acl"),
            items=F.array(
                obj(id=F.concat(L("acl"), C("user_id") % 10), type=L("public")), obj(id=no_text, type=L("circle"))
            ),
        ),
        object=obj(
            objectType=L("note"), content=F.when(C("id") % 2 == 0, "").otherwise(C("text")),
            replies=obj(totalItems=C("id") % 7), plusoners=if_set(k > 0, obj(totalItems=C("id") % 5)),
            resharers=obj(totalItems=C("id") % 3),
            attachments=F.when(k == 1, F.array(photo)).when(k == 2, F.array(article, unkeyed)),
        ),
    )
    return P.parse(t.status.select(j.alias("j")), "j", P.GPLUS_ACTIVITY_SCHEMA)


@query("P10_gplus_rows", f"""
SELECT CAST(id AS STRING) AS id, screen_name AS title, 'post' AS verb, CAST(user_id AS STRING) AS actor_id,
  CASE WHEN id % 2 = 0 THEN 'web' END AS provider_title, 'acl' AS access_kind, 'note' AS objecttype,
  CASE WHEN id % 2 <> 0 THEN text END AS content, id % 7 AS replies_totalitems, CASE WHEN id % 3 > 0 THEN id % 5 END AS plusoners_totalitems,
  id % 3 AS resharers_totalitems, CAST(CASE id % 3 WHEN 1 THEN 1 WHEN 2 THEN 2 END AS INT) AS attachments_totalitems,
  {WKT.format(lon='lon', lat='lat')} AS geocode FROM r_status""")
def _(t):
    return P.gplus_rows(activities(t), "activity").select(
        "id", "title", "verb", "actor_id", "provider_title", "access_kind", "objecttype", "content",
        "replies_totalitems", "plusoners_totalitems", "resharers_totalitems",
        "attachments_totalitems", "geocode",
    )


def gplus_comments(t):
    replies = F.array(
        obj(id=if_set(C("id") % 2 == 0, F.concat(L("z"), C("status_id")))), obj(id=C("status_id").cast("string"))
    )
    j = text_of(
        id=C("id").cast("string"), verb=L("post"), actor=obj(id=C("user_id").cast("string")),
        object=obj(objectType=L("comment"), content=F.concat(L("c"), C("id"))), inReplyTo=replies,
    )
    return P.parse(t.comments.select(j.alias("j")), "j", P.GPLUS_COMMENT_SCHEMA)


REPLIES = "CASE WHEN id % 2 = 0 THEN 'z' || CAST(status_id AS STRING) || ',' ELSE '' END || CAST(status_id AS STRING)"


@query("P10_gplus_rows_comment", f"""
SELECT CAST(id AS STRING) AS id, CAST(user_id AS STRING) AS actor_id, 'comment' AS objecttype, 'c' || CAST(id AS STRING) AS content,
  {REPLIES} AS inreplyto FROM r_comments""")
def _(t):
    return P.gplus_rows(gplus_comments(t), "comment").select(
        "id", "actor_id", "objecttype", "content", joined(C("inreplyto")).alias("inreplyto")
    )


@query("P11_qq_rows", """
SELECT id, CAST(floor(epoch(created_at)) AS BIGINT) AS timestamp, text, CASE WHEN id % 2 = 0 THEN screen_name END AS nick,
  CASE WHEN id % 3 = 0 THEN 'v' || CAST(id AS STRING) END AS video_title, CASE WHEN id % 3 = 1 THEN 'm' || CAST(id AS STRING) END AS music_author,
  CASE WHEN id % 3 = 2 THEN 'p,' || CAST(id AS STRING) END AS image FROM r_posts""")
def _(t):
    k = C("id") % 3
    j = text_of(
        id=C("id"), timestamp=F.unix_seconds(C("created_at").cast("timestamp")), text=C("text"),
        nick=F.when(C("id") % 2 == 0, C("screen_name")).otherwise(""),
        video=if_set(k == 0, obj(title=F.concat(L("v"), C("id")))),
        music=if_set(k == 1, obj(author=F.concat(L("m"), C("id")), title=L(""))),
        image=F.when(k == 2, F.array(L("p"), C("id").cast("string"))).otherwise(F.array().cast("array<string>")),
    )
    return P.qq_rows(P.parse(t.posts.select(j.alias("j")), "j", P.QQ_POST_SCHEMA), "post").select(
        "id", "timestamp", "text", "nick", "video_title", "music_author", joined(C("image")).alias("_i"),
        (C("image").isNotNull()).alias("_has"),
    ).withColumn("image", F.when(C("_has"), C("_i"))).drop("_i", "_has")


def qq_users(t):
    k = C("id") % 4
    tag = lambda n: obj(id=F.concat(L("t"), (C("id") + n) % 30), name=F.concat(L("tag"), (C("id") + n) % 30))
    edu = obj(id=(C("id") % 11).cast("int"), name=F.concat(L("school"), C("id") % 11))
    j = text_of(
        name=F.concat(L("q"), C("id")), nick=F.when(k == 0, "").otherwise(C("screen_name")),
        fansnum=C("followers_count"), country_code=F.when(k == 1, "x1").otherwise(C("province").cast("string")),
        birth_year=(C("id") % 50 + 1950).cast("string"), tag=if_set(k > 0, F.array(tag(0), tag(7))),
        edu=if_set(k > 1, F.array(edu)),
    )
    return P.parse(t.users.select(j.alias("j")), "j", P.QQ_USER_SCHEMA)


@query("P11_qq_rows_user", """
SELECT 'q' || CAST(id AS STRING) AS name, CASE WHEN id % 4 <> 0 THEN screen_name END AS nick, followers_count AS fansnum,
  CASE WHEN id % 4 <> 1 THEN province END AS country_code, CAST(id % 50 + 1950 AS INT) AS birth_year FROM r_users""")
def _(t):
    return P.qq_rows(qq_users(t), "user").select("name", "nick", "fansnum", "country_code", "birth_year")


@query("P12_conform_schema", """
SELECT id, screen_name, CAST(NULL AS BIGINT) AS statuses_count, CAST(followers_count AS DOUBLE) AS followers_count FROM r_users""")
def _(t):
    target = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("screen_name", T.StringType()),
        T.StructField("statuses_count", T.LongType()), T.StructField("followers_count", T.DoubleType()),
    ])
    return P.conform(t.users, target)


@query("P13_geo_search_rows", """
SELECT id, user_id AS from_user_id, screen_name AS from_user,
  CASE WHEN lat IS NOT NULL THEN lat ELSE 22.5 END AS lat, CASE WHEN lat IS NOT NULL THEN lon ELSE 114.25 END AS lng,
  CASE WHEN id % 2 = 0 THEN 'zh' ELSE '' END AS iso_language_code, date_trunc('second', created_at) AS created_at, text
FROM r_status WHERE lat IS NOT NULL OR id % 3 = 1""")
def _(t):
    j = text_of(
        id=C("id"), from_user_id=C("user_id"), from_user=C("screen_name"), text=C("text"), geo=point(),
        location=F.when(C("id") % 3 == 1, "22.5,114.25").otherwise("Kowloon"),
        iso_language_code=if_set(C("id") % 2 == 0, L("zh")),
        created_at=F.date_format("created_at", "EEE, dd MMM yyyy HH:mm:ss '+0000'"),
    )
    return P.geo_rows(P.parse(t.status.select(j.alias("j")), "j", P.GEO_SEARCH_SCHEMA), "22")


@query("P14_optional_columns", """
SELECT p.id, u.id AS user_id_ref, u.screen_name AS user_screen_name, u.province AS user_province, u.city AS user_city,
  u.gender AS user_gender, u.followers_count AS user_followers_count FROM r_posts p LEFT JOIN r_users u ON p.user_id = u.id""")
def _(t):
    return P.select_profile(t.posts.select("id", "user_id"), t.users, extra=True).drop("user_id")


@query("P14_optional_columns_minimal", """
SELECT p.id, p.user_id, u.id AS user_id_ref FROM r_posts p LEFT JOIN r_users u ON p.user_id = u.id""")
def _(t):
    return P.select_profile(t.posts.select("id", "user_id"), t.users, minimal=True)


ENTITY_SQL = {
    "urls": """
SELECT CAST(id AS STRING) AS parent_id, 'people' AS parent_type, 'http://a/' || CAST(id AS STRING) AS value, 'home' AS type,
  CASE WHEN id % 2 = 0 THEN TRUE END AS is_primary FROM r_users
UNION ALL SELECT CAST(id AS STRING), 'people', 'http://b/' || CAST(id AS STRING), 'work', NULL FROM r_users""",
    "emails": """
SELECT CAST(id AS STRING) AS parent_id, 'people' AS parent_type, CAST(id AS STRING) || '@x.org' AS value, 'home' AS type,
  CAST(NULL AS BOOLEAN) AS is_primary FROM r_users WHERE id % 4 = 0""",
    "placesLived": """
SELECT CAST(id AS STRING) AS parent_id, 'people' AS parent_type, 'city' || CAST(city AS STRING) AS value, CAST(NULL AS STRING) AS type,
  CASE WHEN city = 1 THEN TRUE END AS is_primary FROM r_users""",
}


@query("N1_person_entities", "\nUNION ALL\n".join(ENTITY_SQL.values()))
def _(t):
    cols = ["parent_id", "parent_type", "value", "type", "is_primary"]
    parts = [N.person_entities(people(t), k).select(cols) for k in ENTITY_SQL]
    return parts[0].union(parts[1]).union(parts[2])


@query("N1_person_organizations", """
SELECT CAST(id AS STRING) AS parent_id, 'org' AS name, 't' || CAST(id AS STRING) AS title, 'd' AS department FROM r_users WHERE id % 5 = 0""")
def _(t):
    return N.person_entities(people(t), "organizations").select("parent_id", "name", "title", "department")


@query("N2_activity_attachments", """
SELECT DISTINCT 'http://photo/' || CAST(user_id AS STRING) AS attachment_url, 'photo' AS objecttype,
  'http://thumb/' || CAST(user_id AS STRING) AS image_url, CAST(90 AS INT) AS image_height FROM r_posts WHERE id % 3 = 1
UNION ALL SELECT DISTINCT 'a' || CAST(user_id AS STRING), 'article', NULL, NULL FROM r_posts WHERE id % 3 = 2""")
def _(t):
    return N.attachments(activities(t))[0].select("attachment_url", "objecttype", "image_url", "image_height")


@query("N2_activity_attachments_bridge", """
SELECT CAST(id AS STRING) AS activities_id, CASE id % 3 WHEN 1 THEN 'http://photo/' ELSE 'a' END || CAST(user_id AS STRING) AS attachment_url
FROM r_posts WHERE id % 3 > 0""")
def _(t):
    return N.attachments(activities(t))[1]


@query("N3_activity_access", """
SELECT CAST(id AS STRING) AS activities_id, 'acl' || CAST(user_id % 10 AS STRING) AS accesses_id FROM r_posts
UNION ALL SELECT DISTINCT 'public', 'acl' || CAST(user_id % 10 AS STRING) FROM r_posts""")
def _(t):
    rows, bridge = N.accesses(activities(t))
    return bridge.union(rows.select("type", "id"))


@query("N4_user_tags_edus", """
WITH tg AS (SELECT 'q' || CAST(id AS STRING) AS user_name, (id + n) % 30 AS tag FROM r_users CROSS JOIN (VALUES (0), (7)) v(n) WHERE id % 4 > 0)
SELECT 'usertag' AS kind, user_name, 't' || CAST(tag AS STRING) AS item, CAST(NULL AS STRING) AS name FROM tg
UNION ALL SELECT DISTINCT 'tag', NULL, 't' || CAST(tag AS STRING), 'tag' || CAST(tag AS STRING) FROM tg
UNION ALL SELECT 'useredu', 'q' || CAST(id AS STRING), CAST(id % 11 AS STRING), NULL FROM r_users WHERE id % 4 > 1
UNION ALL SELECT DISTINCT 'edu', NULL, CAST(id % 11 AS STRING), 'school' || CAST(id % 11 AS STRING) FROM r_users WHERE id % 4 > 1""")
def _(t):
    payload = qq_users(t)
    tags, usertags = N.user_tags(payload)
    edus, useredus = N.user_edus(payload)
    none = L(None).cast("string")
    shape = lambda df, kind, user, item, name: df.select(
        L(kind).alias("kind"), user.alias("user_name"), item.cast("string").alias("item"), name.alias("name")
    )
    return (
        shape(usertags, "usertag", C("user_name"), C("tag_id"), none)
        .union(shape(tags, "tag", none, C("id"), C("name")))
        .union(shape(useredus, "useredu", C("user_name"), C("edu_id"), none))
        .union(shape(edus, "edu", none, C("id"), C("name")))
    )


@query("N5_post_comments_likes", """
SELECT 'comment' AS kind, CAST(id AS STRING) AS pid, user_id + 1 AS uid, 'm1 ' || screen_name AS message FROM r_posts WHERE id % 3 > 0
UNION ALL SELECT 'comment', CAST(id AS STRING), user_id + 2, 'm2 ' || screen_name FROM r_posts WHERE id % 3 = 2
UNION ALL SELECT 'like', CAST(id AS STRING), user_id, NULL FROM r_posts WHERE id % 3 = 2
UNION ALL SELECT 'like', CAST(id AS STRING), user_id + 1, NULL FROM r_posts WHERE id % 3 = 2""")
def _(t):
    comments, likes = N.post_children(wall_posts(t))
    return comments.select(L("comment").alias("kind"), "pid", C("from").alias("uid"), "message").union(
        likes.select(L("like"), "pid", "uid", L(None).cast("string"))
    )


@query("N6_edge_explode", """
SELECT source_id, target_id, 'followers' AS direction, TIMESTAMP '2024-01-31' AS retrieved FROM r_edges""")
def _(t):
    # Id pages as the API returns them, at most fifty ids each.
    pages = t.edges.groupBy("source_id", F.floor(C("target_id") / 50)).agg(
        F.collect_list("target_id").alias("ids")
    )
    payload = P.parse(
        pages.select(text_of(user=C("source_id"), ids=C("ids")).alias("j")), "j", "user BIGINT, ids ARRAY<BIGINT>"
    )
    return N.edges(payload, ntz(AS_OF))


@query("N7_reply_ids", f"SELECT CAST(id AS STRING) AS id, {REPLIES} AS inreplyto FROM r_comments")
def _(t):
    return N.reply_ids(gplus_comments(t)).select("id", joined(C("inreplyto")).alias("inreplyto"))


MEMBER = "STRUCT<uid BIGINT, name STRING, rsvp_status STRING>"
EVENT_SCHEMA = (
    "id BIGINT, members STRUCT<data ARRAY<STRUCT<uid BIGINT, name STRING>>>, "
    + ", ".join(f"{c} STRUCT<data ARRAY<{MEMBER}>>" for c in N.EVENT_MEMBER_LISTS)
)


def member_payload(t):
    who = lambda n, s: obj(uid=C("id") + n, name=F.concat(L("m"), C("id") + n), rsvp_status=L(s))
    j = text_of(
        id=C("id"),
        members=obj(data=F.array(obj(uid=C("id"), name=F.concat(L("m"), C("id"))), obj(uid=C("id") + 1, name=F.concat(L("m"), C("id") + 1)))),
        attending=obj(data=F.array(who(1, "attending"), who(2, "attending"))),
        declined=if_set(C("id") % 2 == 0, obj(data=F.array(who(3, "declined")))),
        maybe=obj(data=F.array(who(4, "unsure"))),
    )
    return P.parse(t.entities.select(j.alias("j")), "j", EVENT_SCHEMA)


@query("N8_group_event_members", """
SELECT 'group' AS kind, id AS owner, id + n AS uid, CAST(NULL AS STRING) AS rsvp_status FROM r_entities CROSS JOIN (VALUES (0), (1)) v(n)
UNION ALL SELECT 'event', id, id + n, s FROM r_entities CROSS JOIN (VALUES (1, 'attending'), (2, 'attending'), (3, 'declined'), (4, 'unsure')) v(n, s)
  WHERE n <> 3 OR id % 2 = 0
UNION ALL SELECT DISTINCT 'user', NULL, id + n, NULL FROM r_entities CROSS JOIN (VALUES (0), (1)) v(n)""")
def _(t):
    payload = member_payload(t)
    users, groups = N.members(payload, "group", ntz(AS_OF))
    _, events = N.members(payload, "event", ntz(AS_OF))
    none = L(None).cast("string")
    return (
        groups.select(L("group").alias("kind"), C("gid").alias("owner"), "uid", none.alias("rsvp_status"))
        .union(events.select(L("event"), "eid", "uid", "rsvp_status"))
        .union(users.select(L("user"), L(None).cast("bigint"), "id", none))
    )


@query("U5_concat_member_lists", """
SELECT id, id + n AS uid, s AS rsvp_status FROM r_entities CROSS JOIN (VALUES (1, 'attending'), (2, 'attending'), (3, 'declined'), (4, 'unsure')) v(n, s)
WHERE n <> 3 OR id % 2 = 0""")
def _(t):
    return N.event_members(member_payload(t)).select("id", "uid", "rsvp_status")
