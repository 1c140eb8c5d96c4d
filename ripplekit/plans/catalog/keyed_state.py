"""Keyed writes and watch state (K)."""

from functools import partial

from pyspark.sql import functions as F

from ripplekit.operators import keyed as K
from ripplekit.operators import watch as WT
from ripplekit.plans.catalog.aggregation import REPORT_SQL, report
from ripplekit.plans.catalog.base import AS_OF, ntz, query
from ripplekit.plans.catalog.filtering import elsewhere_sql
from ripplekit.plans.catalog.joining import GROWTH_SQL, snapshot_pairs
from ripplekit.session import shared_dir
from ripplekit.sources.parts import KeyedTable


def stored_posts(t):
    """What the earlier crawl had, as rows."""
    return t.posts.join(t.known.withColumnRenamed("id", "_k"), F.col("id") == F.col("_k"), "left_semi").select(
        "id", "user_id", "text"
    )


# A re-crawl: every post again with a changed text, and once more in upper case.
RECRAWL = """
SELECT id, user_id, 'again ' || text AS text, 1 AS seq FROM r_posts
UNION ALL SELECT id, user_id, upper(text), 2 FROM r_posts"""


@query("K1_insert_ignore", """
SELECT id, user_id, text FROM r_posts WHERE id IN (SELECT id FROM r_known)
UNION ALL SELECT id, user_id, 'again ' || text FROM r_posts WHERE id NOT IN (SELECT id FROM r_known)""")
def _(t):
    return K.insert_ignore(stored_posts(t), t.sql(RECRAWL), ["id"], ["seq"])


def kept_table(t, purpose, rows, keys=("id",), buckets=16):
    """A stored table of these rows, in buckets by key."""
    table = KeyedTable(t.spark, shared_dir(t.spark, purpose), rows.schema, list(keys), buckets)
    table.load(rows, 0)
    return table


@query("K1_write_back", """
SELECT id, user_id, text FROM r_posts WHERE id IN (SELECT id FROM r_known)
UNION ALL SELECT id, user_id, 'again ' || text FROM r_posts WHERE id NOT IN (SELECT id FROM r_known)""")
def _(t):
    """Three batches written back, one of them twice; what is stored stays."""
    table, batch = kept_table(t, "posts", stored_posts(t)), t.sql(RECRAWL)
    for number, mine in ((1, "id % 3 = 0"), (2, "id % 3 = 1"), (2, "id % 3 = 1"), (3, "id % 3 > 0")):
        table.write_back(batch.filter(mine), number, partial(K.insert_ignore, keys=["id"], order=["seq"]))
    return table.read().select("id", "user_id", "text")


# Profiles seen in posts: several per user, half of the ids not stored yet.
PROFILES = """
SELECT user_id * 20 AS id, id AS seq, 'n' || CAST(id AS STRING) AS screen_name,
       CASE WHEN id % 2 = 0 THEN 'x' END AS gender, id % 3 AS kind FROM r_posts"""
STORE_COLUMNS = ["id", "screen_name", "gender", "followers_count"]

UPSERT_SQL = f"""
WITH b AS ({PROFILES}),
l AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM b) x WHERE rn = 1)
SELECT coalesce(u.id, l.id) AS id, CASE WHEN l.id IS NOT NULL THEN l.screen_name ELSE u.screen_name END AS screen_name,
       CASE WHEN l.id IS NOT NULL THEN l.gender ELSE u.gender END AS gender, u.followers_count
FROM r_users u FULL OUTER JOIN l ON u.id = l.id"""


@query("K2_insert_or_update", UPSERT_SQL)
def _(t):
    return K.upsert(t.users.select(STORE_COLUMNS), t.sql(PROFILES), ["id"], ["seq"])


@query("K2_write_back", UPSERT_SQL)
def _(t):
    """The profiles in three batches, oldest first; a batch rewrites the buckets of its keys, then outdated files go."""
    table, batch = kept_table(t, "users", t.users.select(STORE_COLUMNS)), t.sql(PROFILES)
    last = batch.agg(F.max("seq")).scalar()
    for number in range(3):
        mine = batch.filter(F.col("seq") > last * number / 3).filter(F.col("seq") <= last * (number + 1) / 3)
        table.write_back(mine, number + 1, partial(K.upsert, keys=["id"], order=["seq"]))
    table.tidy()
    return table.read().select(STORE_COLUMNS)


@query("K2_insert_or_update_partial", f"""
WITH b AS ({PROFILES}),
l AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM b) x WHERE rn = 1),
g AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM b WHERE kind <> 0) x WHERE rn = 1)
SELECT coalesce(u.id, l.id) AS id, CASE WHEN l.id IS NOT NULL THEN l.screen_name ELSE u.screen_name END AS screen_name,
       CASE WHEN g.id IS NOT NULL THEN g.gender ELSE u.gender END AS gender, u.followers_count
FROM r_users u FULL OUTER JOIN l ON u.id = l.id LEFT JOIN g ON l.id = g.id""")
def _(t):
    carried = F.when(F.col("kind") == 0, F.array(F.lit("screen_name"))).otherwise(
        F.array(F.lit("screen_name"), F.lit("gender"))
    )
    batch = t.sql(PROFILES).withColumn("carried", carried)
    return K.upsert(t.users.select(STORE_COLUMNS), batch, ["id"], ["seq"], "carried")


@query("K3_update_or_insert", UPSERT_SQL)
def _(t):
    return K.update_or_insert(t.users.select(STORE_COLUMNS), t.sql(PROFILES), ["id"], ["seq"])


@query("K4_upsert_flags", f"""
SELECT b.id, b.seq, (k.id IS NOT NULL OR b.seq > 1) AS already_exists, NOT (k.id IS NOT NULL OR b.seq > 1) AS success
FROM ({RECRAWL}) b LEFT JOIN r_known k ON b.id = k.id""")
def _(t):
    return K.upsert_outcome(t.known, t.sql(RECRAWL), ["id"], ["seq"]).select(
        "id", "seq", "already_exists", "success"
    )


MARKED = """
SELECT id, user_id, CASE WHEN user_id < 10 THEN TIMESTAMP '2024-01-30' END AS deleted,
       CAST(NULL AS BOOLEAN) AS permission_denied FROM r_posts"""
GONE = "SELECT status_id AS id, user_id > 75 AS permission_denied FROM r_comments"


@query("K5_tombstone", f"""
WITH d AS (SELECT id, bool_or(permission_denied) AS denied FROM ({GONE}) x GROUP BY id)
SELECT p.id, CASE WHEN p.deleted IS NULL AND d.id IS NOT NULL THEN TIMESTAMP '2024-01-31' ELSE p.deleted END AS deleted,
       CASE WHEN p.deleted IS NULL AND d.denied THEN TRUE ELSE p.permission_denied END AS permission_denied
FROM ({MARKED}) p LEFT JOIN d ON p.id = d.id""")
def _(t):
    stored = t.sql(MARKED).withColumn("deleted", F.col("deleted").cast("timestamp_ntz"))
    return K.tombstone(stored, t.sql(GONE), ntz(AS_OF)).select("id", "deleted", "permission_denied")


@query("K5_write_back", f"""
WITH d AS (SELECT id, bool_or(permission_denied) AS denied FROM ({GONE}) x GROUP BY id)
SELECT p.id, CASE WHEN p.deleted IS NULL AND d.id IS NOT NULL THEN TIMESTAMP '2024-01-31' ELSE p.deleted END AS deleted,
       CASE WHEN p.deleted IS NULL AND d.denied THEN TRUE ELSE p.permission_denied END AS permission_denied
FROM ({MARKED}) p LEFT JOIN d ON p.id = d.id""")
def _(t):
    stored = t.sql(MARKED).withColumn("deleted", F.col("deleted").cast("timestamp_ntz")).select("id", "deleted", "permission_denied")
    table, gone = kept_table(t, "marked", stored), t.sql(GONE)
    for number in range(2):
        table.write_back(gone.filter(F.col("id") % 2 == number), number + 1, partial(K.tombstone, as_of=ntz(AS_OF)))
    return table.read().select("id", "deleted", "permission_denied")


@query("K6_suspended_flag", """
SELECT id, CASE WHEN id IN (SELECT user_id FROM r_comments) THEN TIMESTAMP '2024-01-31'
                WHEN province = 3 THEN TIMESTAMP '2023-06-01' END AS suspended FROM r_users""")
def _(t):
    earlier = F.when(F.col("province") == 3, F.lit("2023-06-01").cast("timestamp_ntz"))
    users = t.users.withColumn("suspended", earlier)
    return K.mark_suspended(users, t.comments.select("user_id"), ntz(AS_OF)).select("id", "suspended")


@query("K7_touch_posts_updated", """
SELECT id, CASE WHEN id IN (SELECT user_id FROM r_posts) THEN TIMESTAMP '2024-01-31' END AS posts_updated FROM r_users""")
def _(t):
    return K.touch(t.users, t.posts.select("user_id"), ntz(AS_OF)).select("id", "posts_updated")


@query("K8_snapshot_append", """
SELECT eid, CAST(retrieved AS TIMESTAMP) AS retrieved, cnt FROM r_snapshots
UNION ALL SELECT eid, TIMESTAMP '2024-01-31', COUNT(uid) FROM r_rsvp GROUP BY eid""")
def _(t):
    counts = t.rsvp.groupBy("eid").agg(F.count("uid").alias("cnt"))
    series = t.snapshots.withColumn("retrieved", F.col("retrieved").cast("timestamp_ntz"))
    return K.append_snapshot(series, counts, ntz(AS_OF))


DECISION_SQL = GROWTH_SQL + """,
chk AS (SELECT e.id, e.type, e.state, g.old_cnt, g.new_cnt, CAST(g.ratio_hundredths AS BIGINT) AS ratio_hundredths, g.diff FROM g JOIN r_entities e ON g.eid = e.id
  WHERE g.old_cnt IS NOT NULL AND g.old_cnt <> 0 AND (g.new_cnt IS NOT NULL OR e.state = 'watching')),
dec AS (SELECT *, CASE
  WHEN state = 'watching' THEN CASE
    WHEN diff < 10 AND new_cnt > 1000 THEN FALSE WHEN ratio_hundredths < 102 AND new_cnt > 100 THEN FALSE
    WHEN ratio_hundredths > 120 THEN TRUE END
  WHEN state = 'notwatching' THEN CASE
    WHEN old_cnt < 100 AND new_cnt < 100 THEN NULL WHEN diff > 30 THEN TRUE
    WHEN ratio_hundredths > 115 AND new_cnt > 100 THEN TRUE WHEN diff < -10 THEN FALSE
    WHEN ratio_hundredths <= 103 THEN FALSE END
  WHEN state = 'hongkong' THEN CASE WHEN ratio_hundredths > 100 OR diff > 0 THEN TRUE END END AS decision FROM chk)
"""


def decisions(t):
    return WT.watch_decision(snapshot_pairs(t), t.entities)


@query("K9_watch_decision", DECISION_SQL + """
SELECT *, CASE WHEN decision THEN CASE state WHEN 'hongkong' THEN 'hongkongwatching' WHEN 'notwatching' THEN 'newlywatching' END END AS list FROM dec""")
def _(t):
    return decisions(t)


@query("K10_watch_apply", DECISION_SQL + """
SELECT e.id, e.type, coalesce(d.decision, e.watching) AS watching FROM r_entities e LEFT JOIN dec d ON e.id = d.id""")
def _(t):
    return WT.apply_watch(t.entities, decisions(t)).select("id", "type", "watching")


@query("K10_watch_cleanup", f"""
SELECT id, type, CASE WHEN ({elsewhere_sql()})
  OR (type = 'event' AND end_time < TIMESTAMP '2024-01-24' AND watching IS NOT FALSE)
  OR (type <> 'event' AND retrieved < TIMESTAMP '2023-12-31' AND watching IS NULL) THEN FALSE ELSE watching END AS watching FROM r_objects""")
def _(t):
    return WT.clean_up(t.objects, AS_OF).select("id", "type", "watching")


@query("K11_profile_from_posts", """
WITH s AS (SELECT DISTINCT user_id FROM r_posts)
SELECT coalesce(u.id, s.user_id) AS id, CASE WHEN s.user_id IS NOT NULL THEN 'u' || CAST(s.user_id AS STRING) ELSE u.screen_name END AS screen_name,
  u.gender, CASE WHEN s.user_id IS NOT NULL THEN TIMESTAMP '2024-01-31' END AS retrieved
FROM r_users u FULL OUTER JOIN s ON u.id = s.user_id""")
def _(t):
    return K.users_from_posts(t.posts, t.users, ntz(AS_OF)).select("id", "screen_name", "gender", "retrieved")


@query("K12_deleted_recheck_set", REPORT_SQL + "SELECT id FROM rep")
def _(t):
    return K.recheck_ids(report(t))
