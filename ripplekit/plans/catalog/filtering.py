"""Filters (F)."""

import datetime as dt

from pyspark.sql import functions as F

from ripplekit.operators import aggregates as A
from ripplekit.operators import filters as fl
from ripplekit.operators import joins as J
from ripplekit.operators.areas import in_areas
from ripplekit.plans.catalog.base import AS_OF, END, START, query


@query("F1_period_filter", """
SELECT id, created_at, 'closed' AS kind FROM r_posts
WHERE created_at >= TIMESTAMP '2024-01-05' AND created_at <= TIMESTAMP '2024-01-25'
UNION ALL SELECT id, created_at, 'open' FROM r_posts
WHERE created_at >= TIMESTAMP '2024-01-05' AND created_at < TIMESTAMP '2024-01-25'""")
def _(t):
    p = t.posts.select("id", "created_at")
    closed = fl.in_period(p, "created_at", START, END).withColumn("kind", F.lit("closed"))
    return closed.union(
        fl.in_period(p, "created_at", START, END, closed=False).withColumn("kind", F.lit("open"))
    )


@query("F2_reposts_only", "SELECT id, retweeted_status FROM r_posts WHERE retweeted_status IS NOT NULL")
def _(t):
    return fl.reposts(t.posts).select("id", "retweeted_status")


@query("F3_province_maxfollowers", """
SELECT s.id, s.retweeted_status, u.province, ru.followers_count AS original_followers_count
FROM r_posts s JOIN r_users u ON s.user_id = u.id JOIN r_posts rs ON s.retweeted_status = rs.id
JOIN r_users ru ON rs.user_id = ru.id WHERE u.province = 7 AND ru.followers_count < 5000""")
def _(t):
    star = J.repost_star(t.posts, t.users)
    return fl.filter_audience(star, 7, 5000).select(
        "id", "retweeted_status", "province", "original_followers_count"
    )


@query("F4_list_filter", """
SELECT id, user_id FROM r_posts WHERE user_id IN (SELECT user_id FROM r_userlist WHERE list_id IN (1, 6))""")
def _(t):
    return fl.filter_lists(t.posts, t.userlist, [1, 6]).select("id", "user_id")


@query("F5_min_account_age", """
SELECT s.retweeted_status, MIN(u.created_at) AS min_user_created_at FROM r_posts s JOIN r_users u ON s.user_id = u.id
WHERE s.retweeted_status IS NOT NULL GROUP BY s.retweeted_status HAVING MIN(u.created_at) <= TIMESTAMP '1995-02-01'""")
def _(t):
    who = t.users.select(F.col("id").alias("user_id"), F.col("created_at").alias("user_created_at"))
    grouped = A.repost_pairs(t.posts).join(who, "user_id").groupBy("retweeted_status").agg(
        F.min("user_created_at").alias("min_user_created_at")
    )
    return fl.min_account_age(grouped, dt.datetime(1995, 2, 1))


@query("F6_id_in_list", """
SELECT id, text, 'literal' AS how FROM r_posts WHERE id IN (3, 50, 77)
UNION ALL SELECT id, text, 'table' FROM r_posts WHERE id IN (SELECT retweeted_status FROM r_posts)""")
def _(t):
    p = t.posts.select("id", "text")
    wanted = t.posts.select("retweeted_status")
    return fl.by_ids(p, [3, 50, 77]).withColumn("how", F.lit("literal")).union(
        fl.by_ids(p, wanted).withColumn("how", F.lit("table"))
    )


@query("F7_not_in_spam_posts", """
SELECT id, retweeted_status FROM r_posts WHERE retweeted_status IS NOT NULL
AND retweeted_status NOT IN (SELECT status_id FROM r_comments WHERE user_id = 1)""")
def _(t):
    spam = t.comments.filter("user_id = 1").select("status_id")
    return fl.drop_spam(t.posts.select("id", "retweeted_status"), spam, "retweeted_status")


def elsewhere_sql() -> str:
    """Condition: a group or page is placed by name or link, an event by description, location or name."""
    placed = lambda c: f"(({c} ILIKE '%taiwan%' OR {c} ILIKE '%taipei%') AND {c} NOT ILIKE '%hong%kong%')"
    link = "(type <> 'event' AND (link ILIKE '%.tw%' OR link ILIKE '%tw.%') AND link NOT ILIKE '%.hk%' AND link NOT ILIKE '%hongkong%')"
    event = f"(type = 'event' AND ({placed('description')} OR {placed('location')}))"
    return f"watching IS NOT FALSE AND ({placed('name')} OR {link} OR {event})"


@query("F8_region_keyword_rule", f"SELECT id, name, link FROM r_objects WHERE {elsewhere_sql()}")
def _(t):
    return fl.elsewhere_by_type(t.objects).select("id", "name", "link")


@query("F8_region_rule_any_column", """
SELECT id, name, link FROM r_objects WHERE watching IS NOT FALSE AND (
 ((name ILIKE '%taiwan%' OR name ILIKE '%taipei%') AND name NOT ILIKE '%hong%kong%')
 OR ((link ILIKE '%.tw%' OR link ILIKE '%tw.%') AND link NOT ILIKE '%.hk%' AND link NOT ILIKE '%hongkong%'))""")
def _(t):
    return fl.keyword_rule(t.objects, ["name"], ("link",)).select("id", "name", "link")


@query("F9_tristate_flag", """
SELECT id, 'is null' AS state FROM r_entities WHERE watching IS NULL
UNION ALL SELECT id, 'is true' FROM r_entities WHERE watching IS TRUE
UNION ALL SELECT id, 'is not false' FROM r_entities WHERE watching IS NOT FALSE""")
def _(t):
    parts = [
        fl.by_watch_state(t.entities, s).select("id", F.lit(s).alias("state"))
        for s in ["is null", "is true", "is not false"]
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query("F10_stale_rules", """
SELECT id, type, 'stop' AS verdict FROM r_objects WHERE
 (type = 'event' AND end_time < TIMESTAMP '2024-01-24' AND watching IS NOT FALSE)
 OR (type <> 'event' AND retrieved < TIMESTAMP '2023-12-31' AND watching IS NULL)
UNION ALL SELECT id, type, 'eligible' FROM r_objects WHERE watching IS NULL AND retrieved < TIMESTAMP '2024-01-29 12:00:00'""")
def _(t):
    cols = ["id", "type"]
    eligible = fl.past_grace(fl.by_watch_state(t.objects, "is null"), AS_OF)
    return fl.stale(t.objects, AS_OF).select(*cols, F.lit("stop").alias("verdict")).union(
        eligible.select(*cols, F.lit("eligible").alias("verdict"))
    )


@query("F11_insert_date_filter", """
SELECT id, dbinserted FROM r_dated WHERE CAST(dbinserted AS DATE) = DATE '2024-01-10' OR dbinserted IS NULL""")
def _(t):
    d = t.dated.select("id", "dbinserted")
    return fl.by_insert_date(d, dt.date(2024, 1, 10)).union(fl.by_insert_date(d, None))


_LOCATED = """
SELECT id, CASE WHEN city = 0 THEN lat END AS geo,
       CASE WHEN city = 1 THEN CAST(lat AS STRING) || ',' || CAST(lon AS STRING) ELSE 'somewhere' END AS location
FROM r_places"""


@query("F12_geo_or_location", f"""
SELECT id, geo, location FROM ({_LOCATED}) x WHERE geo IS NOT NULL OR starts_with(location, '22')""")
def _(t):
    return fl.geo_or_location(t.sql(_LOCATED), "22")


@query("F13_spam_site_match", """
SELECT page_id, url, EXISTS (SELECT 1 FROM r_sites s WHERE s.site <> ''
  AND regexp_matches(p.url, '^http://[^/]*' || regexp_escape(s.site))) AS is_spam
FROM pages p""")
def _(t):
    return fl.flag_spam(t.table("pages").select("page_id", "url"), t.sites, "url")


@query("F14_type_guard", """
SELECT id, declared_type, type FROM r_objects
WHERE type IS NULL OR type = declared_type OR type IN ('video', 'link', 'status', 'photo', 'music')""")
def _(t):
    return fl.type_guard(t.objects).select("id", "declared_type", "type")


_BOXES = """
SELECT n_nationkey AS provid, 113.995 AS lon0, 114.012 AS lon1,
       21.995 + n_nationkey / CAST(100 AS DOUBLE) AS lat0, 22.025 + n_nationkey / CAST(100 AS DOUBLE) AS lat1 FROM nation"""


@query("F15_point_in_bbox", f"""
SELECT p.id, b.provid FROM r_places p JOIN ({_BOXES}) b
ON p.lon BETWEEN b.lon0 AND b.lon1 AND p.lat BETWEEN b.lat0 AND b.lat1""")
def _(t):
    boxes = t.sql(_BOXES).selectExpr(
        "provid", "double(lon0) lon0", "double(lon1) lon1", "double(lat0) lat0", "double(lat1) lat1"
    )
    return fl.in_bbox(t.places.select("id", "lon", "lat"), boxes).select("id", "provid")


# Areas of several shapes: slanted boxes with a square hole, and thin slivers across the map; vertices are dyadic.
_RINGS = """
SELECT n_nationkey AS area, 0 AS ring, 114 + n_nationkey / CAST(64 AS DOUBLE) AS x, 22 + n_nationkey / CAST(128 AS DOUBLE) AS y,
       1 / CAST(32 AS DOUBLE) AS w, 1 / CAST(64 AS DOUBLE) AS h, 1 / CAST(128 AS DOUBLE) AS skew FROM nation
UNION ALL SELECT n_nationkey, 1, 114 + n_nationkey / CAST(64 AS DOUBLE) + 1 / CAST(128 AS DOUBLE), 22 + n_nationkey / CAST(128 AS DOUBLE) + 1 / CAST(256 AS DOUBLE),
       1 / CAST(128 AS DOUBLE), 1 / CAST(256 AS DOUBLE), 0 / CAST(1 AS DOUBLE) FROM nation
UNION ALL SELECT 100 + n_nationkey, 0, 113.5, 21.75 + n_nationkey / CAST(64 AS DOUBLE), 1 / CAST(1024 AS DOUBLE), 0.5, 1.25 FROM nation"""
_SPOTS = """
SELECT event_id AS id, 113.75 + (event_id * 37 % 1024) / CAST(1024 AS DOUBLE) AS lon, 21.75 + (event_id * 91 % 512) / CAST(1024 AS DOUBLE) AS lat FROM events"""
_EDGES = f"""
SELECT area, x AS xa, y AS ya, x + w AS xb, y AS yb FROM ({_RINGS}) a UNION ALL SELECT area, x + w, y, x + w + skew, y + h FROM ({_RINGS}) b
UNION ALL SELECT area, x + w + skew, y + h, x + skew, y + h FROM ({_RINGS}) c UNION ALL SELECT area, x + skew, y + h, x, y FROM ({_RINGS}) d"""


@query("F15_point_in_polygon", f"""
WITH e AS (SELECT area, CASE WHEN ya <= yb THEN xa ELSE xb END AS x1, least(ya, yb) AS y1, CASE WHEN ya <= yb THEN xb ELSE xa END AS x2, greatest(ya, yb) AS y2
           FROM ({_EDGES}) v WHERE ya <> yb)
SELECT s.id, e.area FROM ({_SPOTS}) s JOIN e ON e.y1 <= s.lat AND s.lat < e.y2 AND s.lon < (e.x2 - e.x1) * (s.lat - e.y1) / (e.y2 - e.y1) + e.x1
GROUP BY s.id, e.area HAVING count(*) % 2 = 1""")
def _(t):
    corner = lambda dx, dy: F.struct(F.expr(dx).cast("double").alias("x"), F.expr(dy).cast("double").alias("y"))
    ring = F.array(corner("x", "y"), corner("x + w", "y"), corner("x + w + skew", "y + h"), corner("x + skew", "y + h"))
    rings = t.sql(_RINGS).select("area", "ring", ring.alias("vertices"))
    spots = t.sql(_SPOTS).withColumns({c: F.col(c).cast("double") for c in ("lon", "lat")})
    return in_areas(spots, rings).select("id", "area")


@query("F15_within_radius", """
SELECT id, round(d, 6) AS distance_km FROM (
  SELECT id, 2 * 6371.0 * asin(sqrt(pow(sin(radians(22.1 - lat) / 2), 2)
    + cos(radians(lat)) * cos(radians(22.1)) * pow(sin(radians(114.0 - lon) / 2), 2))) AS d FROM r_places) x
WHERE d <= 9.0""")
def _(t):
    near = fl.within_radius(t.places, 114.0, 22.1, 9.0)
    return near.select("id", F.round("distance_km", 6).alias("distance_km"))
