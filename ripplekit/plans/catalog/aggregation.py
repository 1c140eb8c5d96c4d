"""Aggregations (A), top-k and sorting (L), composed reports (T8-T11)."""

import datetime as dt

from pyspark.sql import functions as F

from ripplekit.operators import aggregates as A
from ripplekit.operators import watch as WT
from ripplekit.plans import reports as R
from ripplekit.plans.catalog.base import AS_OF, END, START, joined, ntz, query
from ripplekit.plans.catalog.joining import MENTIONS_SQL
from ripplekit.session import settle, shared_dir

MOST_REPOSTED = """
SELECT f.retweeted_status, f.retweeted_count, f.distinct_users, f.min_user_created_at, p.id, p.created_at FROM (
  SELECT s.retweeted_status, COUNT(*) AS retweeted_count, COUNT(DISTINCT u.id) AS distinct_users,
         MIN(u.created_at) AS min_user_created_at
  FROM r_posts s LEFT JOIN r_users u ON s.user_id = u.id
  WHERE s.retweeted_status IS NOT NULL AND s.created_at >= TIMESTAMP '2024-01-01' AND s.created_at <= TIMESTAMP '2024-01-31'
  {extra}
  GROUP BY s.retweeted_status HAVING MIN(u.created_at) <= TIMESTAMP '1995-01-20'
  ORDER BY distinct_users DESC, s.retweeted_status {k}) f
LEFT JOIN r_posts p ON f.retweeted_status = p.id"""
JAN = (dt.datetime(2024, 1, 1), AS_OF)
AGE = dt.datetime(1995, 1, 20)
TOP_COLUMNS = [
    "retweeted_status", "retweeted_count", "distinct_users", "min_user_created_at", "id", "created_at",
]


@query("A1_most_reposted", MOST_REPOSTED.format(extra="", k="LIMIT 2000"))
def _(t):
    return A.most_reposted(t.posts, t.users, *JAN, min_account_cutoff=AGE, limit=2000).select(TOP_COLUMNS)


@query("A1_most_reposted_all", MOST_REPOSTED.format(extra="", k=""))
def _(t):
    return A.most_reposted(t.posts, t.users, *JAN, min_account_cutoff=AGE).select(TOP_COLUMNS)


LISTS = """
  string_agg(CAST(id AS STRING), ',' ORDER BY created_at, id) AS ids,
  string_agg(CAST(user_id AS STRING), ',' ORDER BY created_at, id) AS user_ids,
  string_agg(coalesce(gender, '~'), ',' ORDER BY created_at, id) AS genders,
  string_agg(coalesce(CAST(followers_count AS STRING), '~'), ',' ORDER BY created_at, id) AS followers_counts"""
# Reposts with their day and the part of it they fall in, for chunks of {chunk}.
PARTED = """
WITH s AS (SELECT p.retweeted_status, p.id, p.created_at, p.user_id, u.gender, u.followers_count, CAST(p.created_at AS DATE) AS day
           FROM r_posts p LEFT JOIN r_users u ON p.user_id = u.id WHERE p.retweeted_status IS NOT NULL),
n AS (SELECT retweeted_status, day, COUNT(*) * 2 // {chunk} + 1 AS parts FROM s GROUP BY 1, 2),
c AS (SELECT s.*, CAST('0x' || substr(md5(CAST(s.id AS STRING)), 1, 7) AS BIGINT) % n.parts AS part
      FROM s JOIN n ON s.retweeted_status = n.retweeted_status AND s.day = n.day)"""


@query("A1_ranked_with_reposters", PARTED.format(chunk=4) + """,
top AS (SELECT s.retweeted_status, COUNT(*) AS retweeted_count, COUNT(DISTINCT u.id) AS distinct_users
  FROM r_posts s LEFT JOIN r_users u ON s.user_id = u.id WHERE s.retweeted_status IS NOT NULL
  GROUP BY 1 ORDER BY distinct_users DESC, 1 LIMIT 30),
l AS (SELECT retweeted_status, CAST(day AS STRING) AS day, part,""" + LISTS + """
  FROM c GROUP BY retweeted_status, day, part)
SELECT top.retweeted_count, top.distinct_users, l.* FROM top JOIN l ON top.retweeted_status = l.retweeted_status""")
def _(t):
    top = A.rank_reposted(t.posts, t.users, dt.datetime(1970, 1, 1), limit=30)
    chunks = A.with_reposters(top.select("retweeted_status", "retweeted_count", "distinct_users"), t.posts, t.users, 4)
    return chunks.select(
        "retweeted_count", "distinct_users", "retweeted_status", F.col("day").cast("string").alias("day"), "part",
        *[joined(F.col(c)).alias(c) for c in ["ids", "user_ids", "genders", "followers_counts"]],
    )


@query("A1_most_reposted_province", MOST_REPOSTED.format(extra="AND u.province = 7", k="LIMIT 200"))
def _(t):
    return A.most_reposted(
        t.posts, t.users, *JAN, province=7, min_account_cutoff=AGE, limit=200
    ).select(TOP_COLUMNS)


@query("A1_most_reposted_lists", MOST_REPOSTED.format(
    extra="AND s.user_id IN (SELECT user_id FROM r_userlist WHERE list_id IN (2, 6))", k="LIMIT 200"))
def _(t):
    return A.most_reposted(
        t.posts, t.users, *JAN, userlist=t.userlist, lists=[2, 6], min_account_cutoff=AGE, limit=200
    ).select(TOP_COLUMNS)


@query("A1_most_reposted_small_authors", MOST_REPOSTED.format(
    extra="AND s.retweeted_status IN (SELECT o.id FROM r_posts o JOIN r_users ru ON o.user_id = ru.id"
    " WHERE ru.followers_count < 5000)", k="LIMIT 2000"))
def _(t):
    return A.most_reposted(
        t.posts, t.users, *JAN, max_followers=5000, min_account_cutoff=AGE, limit=2000
    ).select(TOP_COLUMNS)


@query("A2_most_retweeted_lists", """
SELECT f.rts, f.retweeted_statuses_count, p.id, p.created_at, p.user_id, p.text FROM (
  SELECT retweeted_status AS rts, COUNT(DISTINCT id) AS retweeted_statuses_count FROM r_posts
  WHERE retweeted_status IS NOT NULL AND created_at >= TIMESTAMP '2024-01-05' AND created_at < TIMESTAMP '2024-01-25'
    AND user_id IN (SELECT user_id FROM r_userlist WHERE list_id IN (1, 6))
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 200) f LEFT JOIN r_posts p ON f.rts = p.id""")
def _(t):
    top = A.most_retweeted(t.userlist, t.posts, START, END, [1, 6], 200)
    return top.select("rts", "retweeted_statuses_count", "id", "created_at", "user_id", "text")


@query("A3_aligned_arrays", PARTED.format(chunk=2) + """
SELECT retweeted_status, CAST(day AS STRING) AS day, part,""" + LISTS + """
FROM c GROUP BY retweeted_status, day, part""")
def _(t):
    chunks = A.collect_reposts(t.posts, t.users, chunk=2)
    return chunks.select(
        "retweeted_status", F.col("day").cast("string").alias("day"), "part",
        *[joined(F.col(c)).alias(c) for c in ["ids", "user_ids", "genders", "followers_counts"]],
    )


@query("A4_gender_counts", """
SELECT p.retweeted_status, COUNT(*) FILTER (u.gender = 'm') AS male_count, COUNT(*) FILTER (u.gender = 'f') AS female_count
FROM r_posts p LEFT JOIN r_users u ON p.user_id = u.id WHERE p.retweeted_status IS NOT NULL GROUP BY 1""")
def _(t):
    return A.gender_split(t.posts, t.users)


@query("A5_distinct_gender_counts", """
SELECT p.retweeted_status, COUNT(DISTINCT p.user_id) AS distinct_users_count,
  COUNT(DISTINCT CASE WHEN u.gender = 'm' THEN p.user_id END) AS distinct_male_count,
  COUNT(DISTINCT CASE WHEN u.gender = 'f' THEN p.user_id END) AS distinct_female_count
FROM r_posts p LEFT JOIN r_users u ON p.user_id = u.id WHERE p.retweeted_status IS NOT NULL GROUP BY 1""")
def _(t):
    return A.distinct_gender_split(t.posts, t.users)


@query("A6_time_bucket_counts", """
SELECT retweeted_status, date_trunc('hour', created_at) AS time, COUNT(*) AS count, COUNT(DISTINCT user_id) AS users
FROM r_posts WHERE retweeted_status IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return A.trend(t.posts, "h")


@query("A7_top_links", r"""
WITH rt AS (SELECT * FROM r_posts WHERE retweeted_status IS NOT NULL AND created_at >= TIMESTAMP '2024-01-05'
            AND user_id IN (SELECT user_id FROM r_userlist WHERE list_id = 1)),
l AS (SELECT id, regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 1) AS "full",
      regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 2) AS base,
      regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 3) AS hash FROM r_posts)
SELECT l.full, l.base, l.hash, COUNT(DISTINCT rt.id) AS distinct_posts, COUNT(DISTINCT rt.user_id) AS distinct_users,
       MIN(rt.retweeted_status) AS rt_status_id
FROM rt JOIN l ON rt.retweeted_status = l.id WHERE l.hash <> ''
GROUP BY 1, 2, 3 ORDER BY distinct_users DESC, l.full LIMIT 20""")
def _(t):
    return A.top_links(t.posts, t.userlist, START, k=20)


@query("A8_top_hashtags", r"""
SELECT hashtag, COUNT(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '#([^\s\[\]]+)', 1)) AS hashtag FROM r_posts
  WHERE created_at >= TIMESTAMP '2024-01-05' AND created_at < TIMESTAMP '2024-01-25'
  AND user_id IN (SELECT user_id FROM r_userlist WHERE list_id IN (1, 2))) x
GROUP BY 1 ORDER BY n DESC, hashtag LIMIT 200""")
def _(t):
    return A.top_hashtags(t.posts, START, END, t.userlist, [1, 2], 200)


@query("A9_rsvp_pivot", """
SELECT eid, COUNT(*) FILTER (rsvp_status = 'attending') AS attending_count,
  COUNT(*) FILTER (rsvp_status = 'declined') AS declined_count,
  COUNT(*) FILTER (rsvp_status = 'not_replied') AS notreplied_count,
  COUNT(*) FILTER (rsvp_status = 'unsure') AS unsure_count FROM r_rsvp GROUP BY eid""")
def _(t):
    return A.rsvp_counts(t.rsvp)


@query("A10_group_members_count", """
SELECT e.id AS gid, COUNT(r.uid) AS members_count, TIMESTAMP '2024-01-31' AS retrieved
FROM r_entities e LEFT JOIN r_rsvp r ON e.id = r.eid WHERE e.type = 'group' GROUP BY e.id""")
def _(t):
    groups = t.entities.filter("type = 'group'")
    bridge = t.rsvp.select("uid", F.col("eid").alias("gid"))
    return A.member_counts(groups, bridge, ntz(AS_OF))


@query("A11_reposts_per_post", """
SELECT p.id, coalesce(CASE WHEN p.user_id < 20 THEN 7 END, c.n, 0) AS reposts FROM r_posts p LEFT JOIN (
  SELECT retweeted_status, COUNT(*) AS n FROM r_posts WHERE retweeted_status IS NOT NULL GROUP BY 1) c
ON p.id = c.retweeted_status""")
def _(t):
    stored = F.when(F.col("user_id") < 20, 7)
    return A.repost_counts(t.posts.withColumn("reposts_count", stored))


@query("A12_comments_per_post", """
SELECT p.id, coalesce(CASE WHEN p.user_id < 20 THEN 7 END, c.n, 0) AS comments FROM r_posts p LEFT JOIN (
  SELECT status_id, COUNT(*) AS n FROM r_comments GROUP BY 1) c ON p.id = c.status_id""")
def _(t):
    stored = F.when(F.col("user_id") < 20, 7)
    return A.comment_counts(t.posts.withColumn("comments_count", stored), t.comments)


@query("A13_global_count", "SELECT COUNT(*) AS n FROM r_posts WHERE created_at >= TIMESTAMP '2024-01-05'")
def _(t):
    return A.count_since(t.posts, START)


@query("A14_degree_counts", "SELECT source_id, COUNT(*) AS degree FROM r_edges GROUP BY source_id")
def _(t):
    return A.degree(t.edges)


@query("A15_partition_minmax", """
SELECT CAST(isoyear(created_at) AS INT) AS iso_year, CAST(week(created_at) AS INT) AS iso_week,
       MIN(id) AS min_id, MAX(id) AS max_id FROM r_posts GROUP BY 1, 2""")
def _(t):
    return A.partition_minmax(t.posts)


@query("A16_post_counters", """
SELECT p.id, coalesce(c.n, 0) AS comments_count, coalesce(l.n, 5) AS likes FROM r_posts p
LEFT JOIN (SELECT status_id, COUNT(*) AS n FROM r_comments GROUP BY 1) c ON p.id = c.status_id
LEFT JOIN (SELECT eid, COUNT(*) AS n FROM r_rsvp GROUP BY 1) l ON p.id = l.eid""")
def _(t):
    posts = t.posts.select("id", F.lit(0).alias("comments_count"), F.lit(5).alias("likes"))
    comments = t.comments.select(F.col("status_id").alias("pid"))
    likes = t.rsvp.select("uid", F.col("eid").alias("pid"))
    return A.post_counters(posts, comments, likes)


@query("A17_load_summary", """
SELECT COUNT(*) AS count, COUNT(*) FILTER (e.event_type = 'signup') AS deleted_count,
  COUNT(*) FILTER (e.event_type <> 'signup' AND k.id IS NOT NULL) AS already_exists_count,
  COUNT(*) FILTER (e.event_type <> 'signup' AND k.id IS NULL) AS newly_added
FROM events e LEFT JOIN r_known k ON e.event_id = k.id""")
def _(t):
    batch = t.table("events").select(
        F.col("event_id").alias("id"), (F.col("event_type") == "signup").alias("deleted")
    )
    return A.load_summary(batch, t.known)


@query("A18_distinct_by_group", "SELECT eid FROM r_snapshots GROUP BY eid")
def _(t):
    return A.distinct_keys(t.snapshots, "eid")


@query("L1_topk_distinct_users", """
SELECT retweeted_status, COUNT(DISTINCT user_id) AS distinct_users FROM r_posts WHERE retweeted_status IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 40""")
def _(t):
    counted = A.repost_pairs(t.posts).groupBy("retweeted_status").agg(
        F.count("user_id").alias("distinct_users")
    )
    return A.topk(counted, 40)


DECLARED = "CASE WHEN n > 50 THEN '50+' ELSE CAST(n AS STRING) END"


@query("L2_two_key_sort_cast", f"""
WITH c AS (SELECT retweeted_status AS rts, COUNT(*) AS n FROM r_posts WHERE retweeted_status IS NOT NULL GROUP BY 1),
d AS (SELECT rts, n AS retweeted_statuses_count, {DECLARED} AS retweet_count FROM c)
SELECT rts, retweeted_statuses_count, retweet_count, declared_count FROM (
  SELECT *, CAST(replace(retweet_count, '+', '') AS INT) AS declared_count FROM d) x
ORDER BY retweeted_statuses_count DESC, declared_count DESC, rts LIMIT 50""")
def _(t):
    counted = t.posts.filter("retweeted_status IS NOT NULL").groupBy(
        F.col("retweeted_status").alias("rts")
    ).agg(F.count("*").alias("n"))
    report = counted.select(
        "rts", F.col("n").alias("retweeted_statuses_count"), F.expr(DECLARED).alias("retweet_count")
    )
    return A.rank_by_declared(report).limit(50)


UNCHECKED = "SELECT id, type, retrieved FROM r_objects WHERE watching IS NULL AND retrieved < TIMESTAMP '2024-01-29 12:00:00'"


@query("L3_recent_unchecked", UNCHECKED)
def _(t):
    return WT.worklist(t.objects, AS_OF).select("id", "type", "retrieved")


@query("L3_recent_unchecked_per_type", f"""
SELECT id, type, retrieved FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY type ORDER BY retrieved DESC, id) AS rn FROM ({UNCHECKED}) u) x WHERE rn <= 6""")
def _(t):
    return WT.worklist(t.objects, AS_OF, 6).select("id", "type", "retrieved")


@query("L5_cascade_order", """
SELECT id, created_at, user_id FROM r_posts WHERE retweeted_status = 7 ORDER BY id""")
def _(t):
    return R.cascade(t.posts, 7).select("id", "created_at", "user_id")


@query("T8_repost_edges", MENTIONS_SQL + """,
names AS (SELECT screen_name, MIN(id) AS uid FROM r_users GROUP BY 1),
done AS (SELECT r.id, r.pos, r.name, coalesce(r.ref_user_id, n.uid) AS ref_id FROM refs r LEFT JOIN names n ON r.name = n.screen_name),
lists AS (SELECT id, string_agg(name || '=' || coalesce(CAST(ref_id AS STRING), '~'), ',' ORDER BY pos) AS refs,
          coalesce(string_agg(CASE WHEN ref_id IS NULL THEN name END, ',' ORDER BY pos), '') AS missing FROM done GROUP BY id)
SELECT p.retweeted_status, p.id, p.user_id, coalesce(l.refs, '') AS refs, coalesce(l.missing, '') AS missing
FROM r_posts p LEFT JOIN lists l ON p.id = l.id WHERE p.retweeted_status IS NOT NULL""")
def _(t):
    shown = F.transform(
        "references",
        lambda r: F.concat(r["name"], F.lit("="), F.coalesce(r["id"].cast("string"), F.lit("~"))),
    )
    return R.trace(t.posts, t.users).select(
        "retweeted_status", "id", "user_id", F.concat_ws(",", shown).alias("refs"),
        F.concat_ws(",", "missing_users").alias("missing"),
    )


@query("T8_trace_totals", MENTIONS_SQL + """,
names AS (SELECT screen_name, MIN(id) AS uid FROM r_users GROUP BY 1),
done AS (SELECT r.id, coalesce(r.ref_user_id, n.uid) AS ref_id FROM refs r LEFT JOIN names n ON r.name = n.screen_name),
per AS (SELECT id, COUNT(*) AS n, COUNT(*) FILTER (ref_id IS NULL) AS m FROM done GROUP BY id)
SELECT p.retweeted_status, COUNT(*) AS reposts_count, CAST(SUM(coalesce(per.n, 0)) AS BIGINT) AS references_count,
  CAST(SUM(coalesce(per.m, 0)) AS BIGINT) AS missing_users_count
FROM r_posts p LEFT JOIN per ON p.id = per.id WHERE p.retweeted_status IS NOT NULL GROUP BY 1""")
def _(t):
    return R.trace_totals(R.trace(t.posts, t.users))


@query("T9_trend_series", """
WITH c AS (SELECT retweeted_status, date_trunc('day', created_at) AS time, COUNT(*) AS n, COUNT(DISTINCT user_id) AS u
  FROM r_posts WHERE retweeted_status IS NOT NULL GROUP BY 1, 2),
s AS (SELECT retweeted_status, MIN(time) AS t0, MAX(time) AS t1 FROM c GROUP BY 1),
d AS (SELECT retweeted_status, unnest(generate_series(t0, t1, INTERVAL 1 DAY)) AS time FROM s)
SELECT d.retweeted_status, CAST(d.time AS TIMESTAMP) AS time, coalesce(c.n, 0) AS count, coalesce(c.u, 0) AS users
FROM d LEFT JOIN c ON d.retweeted_status = c.retweeted_status AND d.time = c.time""")
def _(t):
    return R.trend_series(t.posts, t.users, "d")


@query("T9_trend_series_province", """
WITH c AS (SELECT retweeted_status, date_trunc('hour', created_at) + INTERVAL 1 MINUTE * CAST(20 * round_even(minute(created_at) / 20.0, 0) AS INT) AS time,
    COUNT(*) AS n, COUNT(DISTINCT user_id) AS u
  FROM r_posts WHERE retweeted_status IS NOT NULL AND created_at >= TIMESTAMP '2024-01-25'
    AND user_id IN (SELECT id FROM r_users WHERE province = 17) AND user_id IN (SELECT user_id FROM r_userlist WHERE list_id = 5)
  GROUP BY 1, 2),
s AS (SELECT retweeted_status, TIMESTAMP '2024-01-25' AS t0, MAX(time) AS t1 FROM c GROUP BY 1),
d AS (SELECT retweeted_status, unnest(generate_series(t0, t1, INTERVAL 20 MINUTE)) AS time FROM s)
SELECT d.retweeted_status, CAST(d.time AS TIMESTAMP) AS time, coalesce(c.n, 0) AS count, coalesce(c.u, 0) AS users
FROM d LEFT JOIN c ON d.retweeted_status = c.retweeted_status AND d.time = c.time""")
def _(t):
    return R.trend_series(t.posts, t.users, "20m", None, END, 17, t.userlist, 5)


def _trend_sql(minutes: int) -> str:
    """The series of one province and list since END; every counted bucket stays."""
    bucketed = f"INTERVAL 1 MINUTE * CAST({minutes} * round_even(minute(created_at) / {minutes}.0, 0) AS INT)"
    return f"""
WITH c AS (SELECT retweeted_status, date_trunc('hour', created_at) + {bucketed} AS time,
    COUNT(*) AS n, COUNT(DISTINCT user_id) AS u
  FROM r_posts WHERE retweeted_status IS NOT NULL AND created_at >= TIMESTAMP '2024-01-25'
    AND user_id IN (SELECT id FROM r_users WHERE province = 17) AND user_id IN (SELECT user_id FROM r_userlist WHERE list_id = 5)
  GROUP BY 1, 2),
s AS (SELECT retweeted_status, TIMESTAMP '2024-01-25' AS t0, MAX(time) AS t1 FROM c GROUP BY 1),
h AS (SELECT *, unnest(generate_series(t0, date_trunc('hour', t1), INTERVAL 1 HOUR)) AS hour FROM s),
k AS (SELECT *, unnest(range(CAST(round_even(59 / {minutes}.0, 0) AS INT) + 1)) AS i FROM h),
d AS (SELECT DISTINCT retweeted_status, hour + INTERVAL 1 MINUTE * CAST({minutes} * i AS INT) AS time, t1 FROM k)
SELECT coalesce(d.retweeted_status, c.retweeted_status) AS retweeted_status, CAST(coalesce(d.time, c.time) AS TIMESTAMP) AS time,
  coalesce(c.n, 0) AS count, coalesce(c.u, 0) AS users
FROM (SELECT * FROM d WHERE time <= t1) d FULL OUTER JOIN c ON d.retweeted_status = c.retweeted_status AND d.time = c.time"""


def _trend_minutes(t, minutes):
    return R.trend_series(t.posts, t.users, f"{minutes}m", None, END, 17, t.userlist, 5)


for _minutes in (7, 25, 45):
    query(f"T9_trend_series_{_minutes}m", _trend_sql(_minutes))(lambda t, m=_minutes: _trend_minutes(t, m))


REPORT_SQL = """
WITH top AS (
  SELECT s.retweeted_status, COUNT(*) AS n, COUNT(DISTINCT u.id) AS du FROM r_posts s LEFT JOIN r_users u ON s.user_id = u.id
  WHERE s.retweeted_status IS NOT NULL AND s.created_at >= TIMESTAMP '2024-01-05' AND s.created_at <= TIMESTAMP '2024-01-25'
  GROUP BY 1 ORDER BY du DESC, 1 LIMIT 200),
g AS (SELECT s.retweeted_status, COUNT(*) FILTER (u.gender = 'm') AS male_count, COUNT(*) FILTER (u.gender = 'f') AS female_count,
    COUNT(DISTINCT s.user_id) AS distinct_users_count,
    COUNT(DISTINCT CASE WHEN u.gender = 'm' THEN s.user_id END) AS distinct_male_count,
    COUNT(DISTINCT CASE WHEN u.gender = 'f' THEN s.user_id END) AS distinct_female_count
  FROM r_posts s LEFT JOIN r_users u ON s.user_id = u.id
  WHERE s.created_at >= TIMESTAMP '2024-01-05' AND s.created_at <= TIMESTAMP '2024-01-25' GROUP BY 1),
rep AS (SELECT p.id, p.user_id, a.screen_name AS user_name, a.followers_count, a.friends_count, a.statuses_count,
  a.profile_image_url, a.province, a.city, a.verified, p.thumbnail_pic, p.bmiddle_pic, p.original_pic, p.text,
  p.reposts_count, p.comments_count, p.mlevel, top.n AS count,
  epoch_us(p.created_at - INTERVAL 8 HOUR) // 1000 AS created_at_ms, epoch_us(a.created_at - INTERVAL 8 HOUR) // 1000 AS user_created_at_ms,
  pv.provname, c.cityname, c.name_en AS cityname_en, split_part(pv.name_en, ', ', 2) || ',' || split_part(pv.name_en, ', ', 3) AS provname_en,
  g.male_count, g.female_count, g.distinct_users_count, g.distinct_male_count, g.distinct_female_count
FROM top JOIN r_media p ON top.retweeted_status = p.id LEFT JOIN r_profiles a ON p.user_id = a.id
LEFT JOIN r_provinces pv ON a.province = pv.provid AND pv.cityid = 1
LEFT JOIN r_provinces c ON a.province = c.provid AND a.city = c.cityid
LEFT JOIN g ON top.retweeted_status = g.retweeted_status)
"""


def report(t):
    return R.most_reposted_report(t.media, t.profiles, t.provinces, START, END, 200)


@query("T10_report_enrich", REPORT_SQL + "SELECT * FROM rep")
def _(t):
    return report(t)


@query("L4_report_sort", REPORT_SQL + """
SELECT 'json' AS mode, id, user_id, count FROM rep UNION ALL SELECT 'csv', id, user_id, count FROM rep""")
def _(t):
    cols = ["id", "user_id", "count"]
    built = settle(report(t).select(cols), "report")
    by_count = R.order_report(built).select(F.lit("json").alias("mode"), *cols)
    return by_count.union(R.order_report(built, "csv").select(F.lit("csv").alias("mode"), *cols))


@query("T10_report_lists", PARTED.format(chunk=6) + """,
top AS (SELECT retweeted_status AS id, COUNT(*) AS count FROM r_posts WHERE retweeted_status IS NOT NULL GROUP BY 1)
SELECT top.id, top.count, CAST(c.day AS STRING) AS day, c.part,
  string_agg(CAST(c.user_id AS STRING), ',' ORDER BY c.created_at, c.id) AS users,
  string_agg(strftime(c.created_at, '%Y-%m-%d %H:%M:%S'), ',' ORDER BY c.created_at, c.id) AS times,
  string_agg(coalesce(c.gender, '~'), ',' ORDER BY c.created_at, c.id) AS genders
FROM top JOIN c ON top.id = c.retweeted_status GROUP BY 1, 2, 3, 4""")
def _(t):
    ranked = A.rank_reposted(t.posts, t.users, dt.datetime(1970, 1, 1))
    rows = ranked.select(F.col("retweeted_status").alias("id"), F.col("retweeted_count").alias("count"))
    times = F.transform("times", lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss"))
    return R.report_lists(rows, t.posts, t.users, 6).select(
        "id", "count", F.col("day").cast("string").alias("day"), "part",
        joined(F.col("users")).alias("users"), joined(times).alias("times"), joined(F.col("genders")).alias("genders"),
    )

def _interval_sql(days: int, who: str) -> str:
    return f"""
SELECT * FROM (SELECT {days} AS days, s.retweeted_status, COUNT(*) AS retweeted_count, COUNT(DISTINCT u.id) AS distinct_users,
  COUNT(*) FILTER (u.gender = 'm') AS male_count, COUNT(*) FILTER (u.gender = 'f') AS female_count,
  COUNT(DISTINCT s.user_id) AS distinct_users_count,
  COUNT(DISTINCT CASE WHEN u.gender = 'm' THEN s.user_id END) AS distinct_male_count,
  COUNT(DISTINCT CASE WHEN u.gender = 'f' THEN s.user_id END) AS distinct_female_count,
  CAST(ROW_NUMBER() OVER (ORDER BY COUNT(DISTINCT u.id) DESC, s.retweeted_status) AS INT) AS rank
FROM r_posts s LEFT JOIN r_users u ON s.user_id = u.id
WHERE s.retweeted_status IS NOT NULL AND s.created_at >= TIMESTAMP '2024-01-31' - INTERVAL {days} DAY
  AND s.created_at <= TIMESTAMP '2024-01-31' {who}
GROUP BY 2) x"""


INTERVALS = (1, 3, 7, 30)
RANK_COLUMNS = ["days", "retweeted_status", "retweeted_count", "distinct_users", "rank"]


@query("T11_interval_reports", "\nUNION ALL\n".join(
    f"SELECT {', '.join(RANK_COLUMNS)} FROM ({_interval_sql(d, '')}) r WHERE rank <= 50" for d in INTERVALS))
def _(t):
    return R.reports_for_intervals(t.posts, t.users, AS_OF, [*INTERVALS], 50).select(RANK_COLUMNS)


def _whole_days_sql(days: int) -> str:
    return _interval_sql(days, "AND s.created_at < TIMESTAMP '2024-01-31'")


@query("T11_from_partials", "\nUNION ALL\n".join(f"SELECT * FROM ({_whole_days_sql(d)}) r WHERE rank <= 50" for d in INTERVALS))
def _(t):
    """Posts counted once as they come, in three batches of which one comes again; intervals from the stored counts."""
    table = R.partials_table(t.spark, shared_dir(t.spark, "partials"))
    for batch, mine in enumerate(("id % 3 = 0", "id % 3 = 1", "id % 3 = 2")):
        R.add_partials(table, t.posts.filter(mine), batch)
    R.add_partials(table, t.posts.filter("id % 3 = 2"), 2)
    R.merge_partials(table, [202403, 202404], 3)
    return R.reports_from_partials(table, t.users, AS_OF.date(), [*INTERVALS], 50)


@query("T11_interval_reports_full", "WITH top AS (" + "\nUNION ALL\n".join(
    f"SELECT * FROM ({_interval_sql(d, 'AND u.province IN (7)')}) r WHERE rank <= 40" for d in INTERVALS) + """)
SELECT p.id, p.user_id, a.screen_name AS user_name, a.followers_count, a.friends_count, a.statuses_count,
  a.profile_image_url, a.province, a.city, a.verified, p.thumbnail_pic, p.bmiddle_pic, p.original_pic, p.text,
  p.reposts_count, p.comments_count, p.mlevel, top.retweeted_count AS count,
  epoch_us(p.created_at - INTERVAL 8 HOUR) // 1000 AS created_at_ms, epoch_us(a.created_at - INTERVAL 8 HOUR) // 1000 AS user_created_at_ms,
  pv.provname, c.cityname, c.name_en AS cityname_en, split_part(pv.name_en, ', ', 2) || ',' || split_part(pv.name_en, ', ', 3) AS provname_en,
  top.days, top.male_count, top.female_count, top.distinct_users_count, top.distinct_male_count, top.distinct_female_count, top.rank
FROM top JOIN r_media p ON top.retweeted_status = p.id LEFT JOIN r_profiles a ON p.user_id = a.id
LEFT JOIN r_provinces pv ON a.province = pv.provid AND pv.cityid = 1
LEFT JOIN r_provinces c ON a.province = c.provid AND a.city = c.cityid""")
def _(t):
    ranked = R.reports_for_intervals(t.posts, t.users, AS_OF, [*INTERVALS], 40, province=7)
    return R.report_for(ranked, t.media, t.profiles, t.provinces)


@query("A7_link_report", r"""
WITH rt AS (SELECT * FROM r_posts WHERE retweeted_status IS NOT NULL AND created_at >= TIMESTAMP '2024-01-05'
            AND user_id IN (SELECT user_id FROM r_userlist WHERE list_id = 1)),
l AS (SELECT id, regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 1) AS "full",
      regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 2) AS base,
      regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 3) AS hash FROM r_posts),
top AS (SELECT l.full, l.base, l.hash, COUNT(DISTINCT rt.id) AS distinct_posts, COUNT(DISTINCT rt.user_id) AS distinct_users,
       MIN(rt.retweeted_status) AS rt_status_id
  FROM rt JOIN l ON rt.retweeted_status = l.id WHERE l.hash <> '' GROUP BY 1, 2, 3)
SELECT top.*, m.location, EXISTS (SELECT 1 FROM r_sites s WHERE s.site <> ''
    AND regexp_matches(m.location, '^http://[^/]*' || regexp_escape(s.site))) AS is_spam
FROM top LEFT JOIN r_urlmap m ON top.base = m.base AND top.hash = m.hash
WHERE top.rt_status_id NOT IN (SELECT status_id FROM r_comments WHERE user_id % 9 = 1)""")
def _(t):
    spam = t.comments.filter("user_id % 9 = 1").select("status_id")
    return R.link_report(t.posts, t.userlist, t.urlmap, spam, t.sites, START)


@query("T8_trace_document", MENTIONS_SQL + """,
names AS (SELECT screen_name, MIN(id) AS uid FROM r_users GROUP BY 1),
done AS (SELECT r.id, r.pos, r.name, coalesce(r.ref_user_id, n.uid) AS ref_id FROM refs r LEFT JOIN names n ON r.name = n.screen_name),
lists AS (SELECT id, string_agg(name || '=' || coalesce(CAST(ref_id AS STRING), '~'), ',' ORDER BY pos) AS refs FROM done GROUP BY id)
SELECT p.retweeted_status, p.id, p.created_at, p.user_id, p.screen_name, p.text, coalesce(l.refs, '') AS refs, u.id AS user_id_ref,
  u.screen_name AS user_screen_name, u.province AS user_province, u.city AS user_city, u.gender AS user_gender,
  u.followers_count AS user_followers_count, u.friends_count AS user_friends_count
FROM r_posts p LEFT JOIN lists l ON p.id = l.id LEFT JOIN r_profiles u ON p.user_id = u.id AND u.id % 6 <> 5
WHERE p.retweeted_status IS NOT NULL""".replace("FROM r_users GROUP BY 1", "FROM r_users WHERE id % 6 <> 5 GROUP BY 1"))
def _(t):
    shown = F.transform(
        "references",
        lambda r: F.concat(r["name"], F.lit("="), F.coalesce(r["id"].cast("string"), F.lit("~"))),
    )
    # Some users are not stored yet.
    traced = R.trace_document(t.posts, t.profiles.filter("id % 6 <> 5"))
    return traced.withColumn("refs", F.concat_ws(",", shown)).drop("references", "missing_users")


@query("T8_unknown_reposters", """
SELECT DISTINCT p.user_id FROM r_posts p WHERE p.retweeted_status IS NOT NULL
AND p.user_id NOT IN (SELECT id FROM r_users WHERE id % 6 <> 5)""")
def _(t):
    traced = R.trace_document(t.posts, t.users.filter("id % 6 <> 5"), extra=False)
    return R.unknown_reposters(traced)
