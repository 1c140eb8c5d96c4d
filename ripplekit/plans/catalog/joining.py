"""Joins (J), window questions (W), set operations (U)."""

from pyspark.sql import functions as F

from ripplekit.operators import aggregates as A
from ripplekit.operators import joins as J
from ripplekit.operators import sets as S
from ripplekit.operators import windows as W
from ripplekit.operators.filters import by_watch_state
from ripplekit.operators.watch import worklist
from ripplekit.plans.catalog.base import AS_OF, BEFORE, END, START, ntz, query
from ripplekit.session import shared_dir
from ripplekit.sources.writers import replace_weeks


@query("J1_repost_author_original", """
SELECT s.id, s.retweeted_status, u.id AS author_id, u.gender, rs.id AS original_id, rs.created_at AS original_created_at,
       ru.id AS original_author_id, ru.followers_count AS original_followers_count
FROM r_posts s LEFT JOIN r_users u ON s.user_id = u.id LEFT JOIN r_posts rs ON s.retweeted_status = rs.id
LEFT JOIN r_users ru ON rs.user_id = ru.id WHERE s.retweeted_status IS NOT NULL""")
def _(t):
    return J.repost_star(t.posts, t.users).select(
        "id", "retweeted_status", "author_id", "gender", "original_id", "original_created_at",
        "original_author_id", "original_followers_count",
    )


@query("J2_list_to_posts", """
SELECT l.list_id, p.id, p.user_id FROM r_userlist l JOIN r_posts p ON l.user_id = p.user_id""")
def _(t):
    return J.list_posts(t.userlist, t.posts).select("list_id", "id", "user_id")


@query("J3_topk_hydrate", """
SELECT f.retweeted_status, f.n, p.id, p.created_at, p.user_id FROM (
  SELECT retweeted_status, COUNT(*) AS n FROM r_posts WHERE retweeted_status IS NOT NULL
  GROUP BY 1 ORDER BY n DESC, retweeted_status LIMIT 40) f LEFT JOIN r_posts p ON f.retweeted_status = p.id""")
def _(t):
    counted = t.posts.filter("retweeted_status IS NOT NULL").groupBy("retweeted_status").agg(
        F.count("*").alias("n")
    )
    return J.hydrate(A.topk(counted, 40, "n"), t.posts.select("id", "created_at", "user_id"))


@query("J4_geo_dimension", """
SELECT u.id, p.provname, c.cityname, c.name_en AS cityname_en FROM r_users u
LEFT JOIN r_provinces p ON u.province = p.provid AND p.cityid = 1
LEFT JOIN r_provinces c ON u.province = c.provid AND u.city = c.cityid""")
def _(t):
    return J.add_geo(t.users.select("id", "province", "city"), t.provinces).select(
        "id", "provname", "cityname", "cityname_en"
    )


MENTIONS_SQL = r"""
WITH m AS (SELECT id, created_at, retweeted_status,
             regexp_extract_all(text, '//@([^:：。./@\-，,【\[ ]*)', 1) AS names
           FROM r_posts WHERE retweeted_status IS NOT NULL),
probes AS (SELECT id, created_at, retweeted_status, unnest(names) AS name, unnest(range(len(names))) AS pos FROM m),
cands AS (SELECT retweeted_status, screen_name, created_at, user_id FROM r_posts WHERE retweeted_status IS NOT NULL),
refs AS (SELECT p.id, CAST(p.pos AS INT) AS pos, p.retweeted_status, p.name, c.user_id AS ref_user_id
         FROM probes p ASOF LEFT JOIN cands c
         ON p.retweeted_status = c.retweeted_status AND p.name = c.screen_name AND p.created_at > c.created_at)
"""


@query("J5_asof_screen_name", MENTIONS_SQL + "SELECT id, pos, retweeted_status, name, ref_user_id FROM refs")
def _(t):
    return J.resolve_mentions(J.mention_rows(t.posts), t.posts).drop("created_at")


@query("J5_asof_null_names", MENTIONS_SQL.replace("screen_name, created_at, user_id FROM r_posts",
    "CASE WHEN id % 5 < 2 THEN screen_name END AS screen_name, created_at, user_id FROM r_posts")
    + "SELECT id, pos, retweeted_status, name, ref_user_id FROM refs")
def _(t):
    # More than half of the reposts carry no name.
    posts = t.posts.withColumn("screen_name", F.when(F.col("id") % 5 < 2, F.col("screen_name")))
    return J.resolve_mentions(J.mention_rows(posts), posts).drop("created_at")


@query("J6_id_partition_range", """
WITH mm AS (SELECT isoyear(created_at) AS iso_year, week(created_at) AS iso_week, MIN(id) AS min_id, MAX(id) + 300 AS max_id
            FROM r_posts GROUP BY 1, 2),
hit AS (SELECT i.id, mm.iso_year, mm.iso_week, ROW_NUMBER() OVER (PARTITION BY i.id ORDER BY mm.iso_year, mm.iso_week) AS nth
        FROM (SELECT DISTINCT id FROM r_posts) i JOIN mm ON i.id BETWEEN mm.min_id AND mm.max_id)
SELECT id, CAST(iso_year AS INT) AS iso_year, CAST(iso_week AS INT) AS iso_week, CAST(nth AS INT) AS nth FROM hit WHERE nth <= 2""")
def _(t):
    # Ranges that overlap their neighbours, as late arrivals make them.
    minmax = A.partition_minmax(t.posts).withColumn("max_id", F.col("max_id") + 300)
    return J.locate_partitions(t.posts.select("id"), minmax)


@query("J6_fetch_by_ids", """
SELECT id, user_id, created_at FROM r_posts WHERE id IN (SELECT retweeted_status FROM r_posts WHERE user_id % 10 = 3)""")
def _(t):
    """Originals fetched from the weekly table, whose other weeks are not opened."""
    path, posts = shared_dir(t.spark, "weekly"), t.posts.select("id", "user_id", "created_at")
    replace_weeks(posts, path)
    wanted = t.posts.filter("user_id % 10 = 3 AND retweeted_status IS NOT NULL").select(F.col("retweeted_status").alias("id"))
    weekly = t.spark.read.parquet(path)
    return J.fetch_by_ids(wanted, A.partition_minmax(posts), weekly).select("id", "user_id", "created_at")


@query("J7_short_url_lookup", r"""
SELECT l.id, l.full, l.base, l.hash, m.location FROM (
  SELECT id, regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 1) AS "full",
         regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 2) AS base,
         regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 3) AS hash FROM r_posts) l
LEFT JOIN r_urlmap m ON l.base = m.base AND l.hash = m.hash WHERE l.hash <> ''""")
def _(t):
    return J.resolve_urls(J.post_links(t.posts), t.urlmap)


PAIR_SQL = """
WITH pair AS (
  SELECT eid, MAX(CASE WHEN retrieved <= DATE '2024-01-20' THEN retrieved END) AS old_retrieved,
         MAX(CASE WHEN retrieved >= DATE '2024-01-28' THEN retrieved END) AS new_retrieved
  FROM r_snapshots GROUP BY eid),
pairs AS (SELECT p.eid, p.old_retrieved, o.cnt AS old_cnt, p.new_retrieved, n.cnt AS new_cnt FROM pair p
  LEFT JOIN r_snapshots o ON p.eid = o.eid AND p.old_retrieved = o.retrieved
  LEFT JOIN r_snapshots n ON p.eid = n.eid AND p.new_retrieved = n.retrieved)
"""


def snapshot_pairs(t):
    return J.snapshot_pair(t.snapshots, F.lit("2024-01-20").cast("date"), F.lit("2024-01-28").cast("date"))


@query("J8_snapshot_asof", PAIR_SQL + """
SELECT eid, CAST(old_retrieved AS TIMESTAMP) AS old_retrieved, old_cnt, CAST(new_retrieved AS TIMESTAMP) AS new_retrieved, new_cnt
FROM pairs""")
def _(t):
    times = {c: F.col(c).cast("timestamp_ntz") for c in ["old_retrieved", "new_retrieved"]}
    return snapshot_pairs(t).withColumns(times)


@query("J9_semi_watched_unset", """
SELECT id, type FROM r_entities WHERE watching IS NULL AND id IN (SELECT eid FROM r_snapshots)""")
def _(t):
    return J.checked_unset(t.snapshots, t.entities).select("id", "type")


@query("J10_anti_missing_rows", """
SELECT DISTINCT retweeted_status AS missing_id, 'post' AS kind FROM r_posts
WHERE retweeted_status IS NOT NULL AND retweeted_status NOT IN (SELECT id FROM r_posts)
UNION ALL SELECT DISTINCT user_id, 'user' FROM r_posts WHERE user_id NOT IN (SELECT id FROM r_users)""")
def _(t):
    posts = J.missing(t.posts, "retweeted_status", t.posts).withColumn("kind", F.lit("post"))
    return posts.union(J.missing(t.posts, "user_id", t.users).withColumn("kind", F.lit("user")))


@query("J11_anti_exclusion_list", """
SELECT id, screen_name FROM r_users WHERE id NOT IN (SELECT user_id FROM r_userlist WHERE list_id = 6)""")
def _(t):
    never = t.userlist.filter("list_id = 6").select("user_id")
    return J.exclude(t.users.select("id", "screen_name"), never)


@query("J12_fk_check", """
SELECT e.source_id, e.target_id FROM r_edges e WHERE e.target_id NOT IN (SELECT user_id FROM r_posts)
UNION ALL SELECT id, retweeted_status FROM r_posts WHERE retweeted_status IS NOT NULL
  AND retweeted_status NOT IN (SELECT id FROM r_posts)""")
def _(t):
    authors = t.posts.select(F.col("user_id").alias("author"))
    edges = J.orphans(t.edges, authors, "target_id", "author").select("source_id", "target_id")
    stored = t.posts.select(F.col("id").alias("stored"))
    posts = J.orphans(t.posts, stored, "retweeted_status", "stored")
    return edges.union(posts.select("id", "retweeted_status"))


@query("J13_attach_users_to_report", """
SELECT p.id, p.user_id, p.created_at, u.created_at AS u_created_at, u.gender, u.followers_count
FROM r_posts p LEFT JOIN r_users u ON p.user_id = u.id""")
def _(t):
    report = t.posts.select("id", "user_id", "created_at")
    return J.attach_users(report, t.users).select(
        "id", "user_id", "created_at", "u_created_at", "gender", "followers_count"
    )


@query("W1_latest_per_key", """
SELECT eid, CAST(retrieved AS TIMESTAMP) AS retrieved, cnt FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY eid ORDER BY retrieved DESC) AS rn FROM r_snapshots) x WHERE rn = 1""")
def _(t):
    return W.latest(t.snapshots, "eid", "retrieved").withColumn("retrieved", F.col("retrieved").cast("timestamp_ntz"))


CUT_SQL = """
WITH b AS (SELECT p.id, p.user_id, p.created_at, k.id IS NOT NULL AS known FROM r_posts p LEFT JOIN r_known k ON p.id = k.id),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY created_at DESC, id DESC) AS rn,
             SUM(CASE WHEN known THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY created_at DESC, id DESC) AS run FROM b),
n AS (SELECT *, SUM(CASE WHEN known THEN 1 ELSE 0 END) OVER (PARTITION BY user_id{run} ORDER BY rn) AS nth FROM r),
c AS (SELECT user_id, MIN(rn) AS cut FROM n WHERE known AND nth = {n} GROUP BY user_id)
SELECT r.id, r.user_id, r.known FROM r LEFT JOIN c ON r.user_id = c.user_id WHERE c.cut IS NULL OR r.rn <= c.cut"""


@query("W2_stop_at_known", CUT_SQL.format(run=", run", n=5))
def _(t):
    batch = t.posts.select("id", "user_id", "created_at")
    return W.incremental_cutoff(batch, t.known, 5, reset=True).select("id", "user_id", "known")


@query("W2_stop_at_known_page", CUT_SQL.format(run="", n=10))
def _(t):
    batch = t.posts.select("id", "user_id", "created_at")
    return W.incremental_cutoff(batch, t.known, 10, reset=False).select("id", "user_id", "known")


GROWTH_SQL = PAIR_SQL + """, g AS (SELECT *, CASE WHEN old_cnt <> 0 THEN (new_cnt * 100) // old_cnt END AS ratio_hundredths,
  new_cnt - old_cnt AS diff FROM pairs)
"""


@query("W3_growth_delta", GROWTH_SQL + """
SELECT eid, old_cnt, new_cnt, CAST(ratio_hundredths AS BIGINT) AS ratio_hundredths,
       ratio_hundredths / CAST(100 AS DOUBLE) AS ratio, diff FROM g""")
def _(t):
    return W.growth(snapshot_pairs(t)).select(
        "eid", "old_cnt", "new_cnt", "ratio_hundredths", "ratio", "diff"
    )


@query("W4_first_name_binding", """
SELECT screen_name, arg_min(user_id, id) AS user_id FROM r_posts WHERE retweeted_status IS NOT NULL GROUP BY screen_name""")
def _(t):
    return W.first_binding(t.posts.filter("retweeted_status IS NOT NULL"))


@query("W5_dedupe_first", """
SELECT user_id, id, created_at FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY created_at, id) AS rn FROM r_posts) x
WHERE rn = 1""")
def _(t):
    return W.dedupe_first(t.posts.select("user_id", "id", "created_at"), ["user_id"], ["created_at", "id"])


@query("W6_last_post_touch", """
SELECT u.id, p.last_post_date, CASE WHEN p.last_post_date IS NOT NULL THEN TIMESTAMP '2024-01-31' END AS posts_updated
FROM r_users u LEFT JOIN (SELECT user_id, MAX(created_at) AS last_post_date FROM r_posts GROUP BY user_id) p ON u.id = p.user_id""")
def _(t):
    return W.touch_users(t.posts, t.users.select("id"), ntz(AS_OF))


@query("U1_union_distinct", """
SELECT id, created_at, user_id FROM r_posts WHERE created_at < TIMESTAMP '2024-01-25'
UNION SELECT id, created_at, user_id FROM r_posts WHERE created_at >= TIMESTAMP '2024-01-05'""")
def _(t):
    p = t.posts.select("id", "created_at", "user_id")
    return S.union_weeks([p.filter(F.col("created_at") < ntz(END)), p.filter(F.col("created_at") >= ntz(START))])


WORKLISTS_SQL = """
WITH fresh AS (SELECT id, type FROM r_objects WHERE watching IS NULL AND retrieved < TIMESTAMP '2024-01-29 12:00:00'),
yet AS (SELECT id, type FROM r_objects WHERE watching IS NULL AND id IN (SELECT eid FROM r_snapshots))
SELECT id, type, 'notwatching' AS state FROM fresh
UNION ALL SELECT id, type, 'notwatchingyet' FROM yet
UNION ALL SELECT id, type, 'watching' FROM r_objects WHERE watching IS TRUE
UNION ALL SELECT id, type, 'hongkong' FROM r_objects WHERE state = 'hongkong'"""


@query("U2_union_all_worklists", WORKLISTS_SQL)
def _(t):
    o = t.objects
    return S.union_all([
        S.tag_worklist(worklist(o, AS_OF), "notwatching"),
        S.tag_worklist(J.checked_unset(t.snapshots, o), "notwatchingyet"),
        S.tag_worklist(by_watch_state(o, "is true"), "watching"),
        S.tag_worklist(o.filter("state = 'hongkong'"), "hongkong"),
    ])


@query("U3_union_ids_numeric", """
SELECT DISTINCT id FROM (SELECT user_id AS id FROM r_posts UNION ALL SELECT target_id FROM r_edges) x""")
def _(t):
    return S.merge_id_files([t.posts.select("user_id"), t.edges.select("target_id")])


@query("U4_except_ids", """
SELECT retweeted_status AS id FROM r_posts WHERE retweeted_status IS NOT NULL EXCEPT SELECT id FROM r_posts""")
def _(t):
    wanted = t.posts.filter("retweeted_status IS NOT NULL").select(F.col("retweeted_status").alias("id"))
    return S.minus(wanted, t.posts)
