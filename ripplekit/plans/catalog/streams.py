"""Streams (ST): the event table read as a stream, drained, then read back."""

from pyspark.sql import functions as F

from ripplekit.plans.catalog.base import query
from ripplekit.plans.catalog.joining import CUT_SQL, GROWTH_SQL
from ripplekit.plans.catalog.keyed_state import DECISION_SQL
from ripplekit.plans.roles import TABLE_SCHEMAS
from ripplekit.session import settle, shared_dir
from ripplekit.sources.parts import KeyedTable, unfolded
from ripplekit.streaming import streams as ST



def number_of():
    return F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")


def event_stream(t):
    return (
        t.spark.readStream.schema(TABLE_SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(t.dir)
    )


def post_stream(t):
    """The posts of the event stream; watermarks need a zoned timestamp."""
    k = number_of()
    target = F.when(k % 10 == 9, k + 1000000).otherwise(k)
    is_repost = F.col("event_type").isin("view", "click", "purchase") & (k < F.col("event_id"))
    return event_stream(t).select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("created_at"), "user_id",
        F.when(is_repost, target).alias("retweeted_status"),
    )


@query("ST1_stream_insert_ignore", "SELECT id, created_at, user_id, retweeted_status FROM r_posts")
def _(t):
    out, state = shared_dir(t.spark, "ingested"), shared_dir(t.spark, "state")
    # The same pages fetched twice: every id arrives two times.
    twice = post_stream(t).union(post_stream(t))
    ST.run_available(ST.stream_ingest(twice, "2 hours"), out, state)
    return t.spark.read.parquet(out).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("ST2_stream_upsert", """
WITH l AS (SELECT * FROM (SELECT user_id, id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY id DESC) AS rn FROM r_posts) x WHERE rn = 1)
SELECT coalesce(u.id, l.user_id) AS id, CASE WHEN l.id IS NOT NULL THEN 'n' || CAST(l.id AS STRING) ELSE u.screen_name END AS screen_name, u.gender
FROM r_users u FULL OUTER JOIN l ON u.id = l.user_id""")
def _(t):
    log, state = shared_dir(t.spark, "profiles"), shared_dir(t.spark, "state")
    seen = event_stream(t).select(
        F.col("user_id").alias("id"), F.concat(F.lit("n"), F.col("event_id")).alias("screen_name"),
        F.col("event_id").alias("seq"),
    )
    ST.stream_upsert(seen, log, state)
    store = t.users.select("id", "screen_name", "gender")
    return ST.current_rows(store, ST.read_log(t.spark, log), ["id"], ["seq"])


def in_files(t, rows, order, files=4):
    """A stream of rows that come as several files, in order, one micro-batch each."""
    # Written once by all tasks; the one task that writes a file then reads these columns only.
    rows = settle(rows, "in-order")
    path, last = shared_dir(t.spark, "files"), rows.agg(F.max(order)).scalar()
    for n in range(files):
        mine = rows.filter(F.col(order) > last * n / files if n else F.lit(True)).filter(F.col(order) <= last * (n + 1) / files)
        mine.coalesce(1).write.mode("append").parquet(path)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("ST2_stream_folded", """
WITH l AS (SELECT * FROM (SELECT user_id, id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY id DESC) AS rn FROM r_posts) x WHERE rn = 1)
SELECT coalesce(u.id, l.user_id) AS id, CASE WHEN l.id IS NOT NULL THEN 'n' || CAST(l.id AS STRING) ELSE u.screen_name END AS screen_name, u.gender
FROM r_users u FULL OUTER JOIN l ON u.id = l.user_id""")
def _(t):
    """Every third micro-batch the log is written back to the stored table and its entries are deleted; the rest is read on top."""
    log, state = shared_dir(t.spark, "profiles"), shared_dir(t.spark, "state")
    seen = t.posts.select(F.col("user_id").alias("id"), F.concat(F.lit("n"), "id").alias("screen_name"), F.col("id").alias("seq"))
    store = t.users.select("id", "screen_name", "gender")
    table = KeyedTable(t.spark, shared_dir(t.spark, "users"), store.schema, ["id"], 16)
    table.load(store, -1)
    ST.run_folded(in_files(t, seen, "seq"), log, state, table, ST.last_change(["id"], ["seq"]), every=3)
    return ST.current_rows(table.read().drop("part"), unfolded(table, log), ["id"], ["seq"])


@query("ST3_stream_trend", """
SELECT date_trunc('hour', created_at) AS window_start, retweeted_status, COUNT(*) AS count FROM r_posts
WHERE retweeted_status IS NOT NULL GROUP BY 1, 2""")
def _(t):
    log, state = shared_dir(t.spark, "trend"), shared_dir(t.spark, "state")
    ST.run_to_log(ST.stream_trend(post_stream(t), "1 hour"), log, state, "update")
    counts = ST.latest_of(ST.read_log(t.spark, log), ["window_start", "retweeted_status"])
    return counts.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "retweeted_status", "count")


@query("ST4_stream_most_reposted", """
WITH w AS (SELECT unnest(generate_series(date_trunc('hour', created_at) - INTERVAL 23 HOUR, date_trunc('hour', created_at), INTERVAL 1 HOUR)) AS window_start,
  retweeted_status FROM r_posts WHERE retweeted_status IS NOT NULL),
c AS (SELECT window_start, retweeted_status, COUNT(*) AS count FROM w GROUP BY 1, 2)
SELECT * FROM (SELECT CAST(window_start AS TIMESTAMP) AS window_start, retweeted_status, count,
  CAST(ROW_NUMBER() OVER (PARTITION BY window_start ORDER BY count DESC, retweeted_status) AS INT) AS rank FROM c) x WHERE rank <= 3""")
def _(t):
    log, state = shared_dir(t.spark, "steps"), shared_dir(t.spark, "state")
    ST.run_to_log(ST.stream_top(post_stream(t), "1 hour"), log, state, "update")
    steps = ST.latest_of(ST.read_log(t.spark, log), ["window_start", "retweeted_status"])
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    top = ST.top_per_window(ST.sliding_counts(steps, hour, 24), 3)
    return top.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("W2_stream_until_known", CUT_SQL.format(run=", run", n=5))
def _(t):
    """Pages fetched newest first, in five micro-batches that split them anywhere."""
    posts = t.posts.select("id", "user_id", "created_at")
    newest = posts.agg(F.max("id")).scalar()
    pages = in_files(t, posts.withColumn("turn", newest - F.col("id")), "turn", 5).drop("turn")
    log, state = shared_dir(t.spark, "pages"), shared_dir(t.spark, "state")
    ST.run_to_log(ST.stream_until_known(pages, t.known, 5), log, state)
    return ST.read_log(t.spark, log).select("id", "user_id", "known")


@query("ST4_stream_ranked", """
WITH w AS (SELECT unnest(generate_series(date_trunc('hour', created_at) - INTERVAL 23 HOUR, date_trunc('hour', created_at), INTERVAL 1 HOUR)) AS window_start,
  retweeted_status FROM r_posts WHERE retweeted_status IS NOT NULL),
c AS (SELECT window_start, retweeted_status, COUNT(*) AS count FROM w GROUP BY 1, 2)
SELECT * FROM (SELECT CAST(window_start AS TIMESTAMP) AS window_start, retweeted_status, count,
  CAST(ROW_NUMBER() OVER (PARTITION BY window_start ORDER BY count DESC, retweeted_status) AS INT) AS rank FROM c) x WHERE rank <= 3""")
def _(t):
    """Ranked while the stream runs, in four micro-batches, instead of after it."""
    posts = t.posts.select("id", F.col("created_at").cast("timestamp").alias("created_at"), "retweeted_status")
    table = ST.ranked_table(t.spark, shared_dir(t.spark, "ranked"))
    ST.stream_ranked(in_files(t, posts, "id"), table, "24 hours", "1 hour", 3, shared_dir(t.spark, "state"), late="40 days")
    return table.read().select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "retweeted_status", "count", "rank")


@query("ST5_stream_watch", DECISION_SQL + """
SELECT e.id, e.type, coalesce(d.decision, e.watching) AS watching FROM r_entities e LEFT JOIN dec d ON e.id = d.id""")
def _(t):
    src, snaps, decided, state = (
        shared_dir(t.spark, p) for p in ("snapshots-in", "snapshots", "decisions", "state")
    )
    t.snapshots.write.parquet(src)
    stream = t.spark.readStream.schema("eid BIGINT, retrieved DATE, cnt BIGINT").parquet(src)
    ST.stream_watch(
        stream, t.entities, F.lit("2024-01-20").cast("date"), F.lit("2024-01-28").cast("date"),
        snaps, decided, state,
    )
    return ST.current_watch(t.entities, ST.read_log(t.spark, decided)).select("id", "type", "watching")


@query("ST6_stream_tombstones", """
WITH d AS (SELECT status_id AS id, MIN(created_at) AS at, arg_min(user_id, created_at) > 75 AS denied FROM r_comments GROUP BY 1)
SELECT p.id, CASE WHEN p.user_id < 10 THEN TIMESTAMP '2024-01-30' ELSE d.at END AS deleted,
  CASE WHEN p.user_id >= 10 AND d.denied THEN TRUE END AS permission_denied FROM r_posts p LEFT JOIN d ON p.id = d.id""")
def _(t):
    log, state = shared_dir(t.spark, "deletions"), shared_dir(t.spark, "state")
    gone = event_stream(t).filter("event_type = 'error'").select(
        number_of().alias("id"), F.col("ts").alias("deleted_at"), (F.col("user_id") > 75).alias("permission_denied")
    )
    ST.stream_tombstones(gone, log, state)
    store = t.posts.select(
        "id",
        F.when(F.col("user_id") < 10, F.lit("2024-01-30").cast("timestamp_ntz")).alias("deleted"),
        F.lit(None).cast("boolean").alias("permission_denied"),
    )
    return ST.current_tombstones(store, ST.read_log(t.spark, log))


@query("ST6_stream_folded", """
WITH d AS (SELECT status_id AS id, MIN(created_at) AS at, arg_min(user_id, created_at) > 75 AS denied FROM r_comments GROUP BY 1)
SELECT p.id, CASE WHEN p.user_id < 10 THEN TIMESTAMP '2024-01-30' ELSE d.at END AS deleted,
  CASE WHEN p.user_id >= 10 AND d.denied THEN TRUE END AS permission_denied FROM r_posts p LEFT JOIN d ON p.id = d.id""")
def _(t):
    """Deletions written back to the stored posts every second micro-batch, and their log entries deleted."""
    log, state = shared_dir(t.spark, "deletions"), shared_dir(t.spark, "state")
    gone = t.comments.select(
        F.col("status_id").alias("id"), F.col("created_at").alias("deleted_at"), (F.col("user_id") > 75).alias("permission_denied"),
        F.col("id").alias("seq"),
    )
    store = t.posts.select(
        "id",
        F.when(F.col("user_id") < 10, F.lit("2024-01-30").cast("timestamp_ntz")).alias("deleted"),
        F.lit(None).cast("boolean").alias("permission_denied"),
    )
    table = KeyedTable(t.spark, shared_dir(t.spark, "posts"), store.schema, ["id"], 16)
    table.load(store, -1)
    ST.run_folded(in_files(t, gone, "seq"), log, state, table, ST.current_tombstones, every=2)
    return ST.current_tombstones(table.read().drop("part"), unfolded(table, log))
