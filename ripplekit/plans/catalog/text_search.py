"""Tokens, postings and search (T1-T7)."""

import datetime as dt

from pyspark.sql import functions as F

from ripplekit.functions.times import with_iso_week
from ripplekit.operators import search as S
from ripplekit.operators import search_index as SI
from ripplekit.plans.catalog.base import joined, query
from ripplekit.session import settle, shared_dir
from ripplekit.sources.readers import read_csv, scan_period
from ripplekit.sources.writers import write_csv

# The checking SQL's tokens: words, with runs of Han characters as bigrams.
TOKENS = r"""
flatten(list_transform(
  list_filter(string_split_regex(regexp_replace(lower({text}), '(\p{{Han}}+)', ' \1 ', 'g'), '[^\p{{L}}\p{{N}}\p{{M}}]+'), lambda w: w <> ''),
  lambda w: CASE WHEN regexp_matches(w, '^\p{{Han}}') AND length(w) > 1
       THEN list_transform(range(1, length(w)), lambda i: substr(w, i, 2)) ELSE [w] END))"""


def tokens_sql(text):
    return TOKENS.format(text=text)


QUERY = "the que ein"
TERMS = "('the', 'que', 'ein')"
START, END = 1704067200, 1704067200 + 86400 * 2


def forum_hits(where="TRUE", k=200, offset=0):
    cut = "" if k is None else f"LIMIT {k} OFFSET {offset}"
    return f"""
WITH hit AS (SELECT pid, uid, tid, time_secs FROM r_forum WHERE ({where}))
SELECT pid, uid, tid, time_secs, (SELECT COUNT(*) FROM hit) AS total_hits FROM hit ORDER BY time_secs DESC, pid {cut}"""


HAS_TERM = f"len(list_filter({tokens_sql('content')}, lambda x: x IN {TERMS})) > 0"
FOLDERS = 16


def forum_index(t):
    """The forum's stored index, built anew by each query, so that it is never older than the tables."""
    path = shared_dir(t.spark, "forum-index")
    S.write_postings(S.build_postings(t.forum, "pid", "content"), path, FOLDERS)
    return t.spark.read.schema("term STRING, doc_id BIGINT, tf INT, term_bucket INT").parquet(path)


COLS = ["pid", "uid", "tid", "time_secs", "total_hits"]


def forum_search(t, q, *args, **options):
    shown = t.forum.select("pid", "uid", "tid", "time_secs")
    found = S.search(
        forum_index(t), shown, q, *args, doc_id="pid", user="uid", ts="time_secs", buckets=FOLDERS, **options
    )
    return found.select(COLS)


@query("T1_keyword_search", forum_hits(f"{HAS_TERM} AND time_secs BETWEEN {START} AND {END}"))
def _(t):
    return forum_search(t, QUERY, START, END, k=200)


@query("T1_keyword_search_all", forum_hits(f"{HAS_TERM} AND time_secs >= {START + 7000}", None))
def _(t):
    return forum_search(t, QUERY, START + 7000)


@query("T1_keyword_search_page", forum_hits(f"{HAS_TERM} AND time_secs <= {END}", 20, 40))
def _(t):
    return forum_search(t, QUERY, None, END, k=20, offset=40)


@query("T2_search_by_users", forum_hits(
    f"{HAS_TERM} AND time_secs BETWEEN {START} AND {END} AND uid IN (SELECT user_id FROM r_userlist WHERE list_id IN (1, 2))"))
def _(t):
    people = t.userlist.filter("list_id IN (1, 2)").select("user_id")
    return forum_search(t, QUERY, START, END, people, k=200)


@query("T2_search_no_users", forum_hits(f"{HAS_TERM} AND time_secs BETWEEN {START} AND {END}"))
def _(t):
    return forum_search(t, QUERY, START, END, [], k=200)


def time_index(t):
    """The forum's index by time, built by the query that searches it."""
    table = SI.index_table(t.spark, shared_dir(t.spark, "time-index"))
    table.add(SI.postings(t.forum, "pid", "content", "time_secs", "uid", span=SPAN), 0)
    return table


SPAN = 3600


def newest(t, q, k, *args, **options):
    """The newest hits by the index alone, then their threads; and the number of all hits."""
    table = time_index(t)
    top = settle(SI.newest_hits(table, q, k, *args, span=SPAN, **options), "top")
    options.pop("offset", None)
    total = SI.all_hits(table, q, *args, span=SPAN, **options).agg(F.count("*").alias("n")).scalar()
    return SI.with_documents(top, t.forum, "pid").select("pid", "uid", "tid", "time_secs").withColumn("total_hits", total)


@query("T1_newest_by_index", forum_hits(f"{HAS_TERM} AND time_secs BETWEEN {START} AND {END}"))
def _(t):
    return newest(t, QUERY, 200, START, END)


@query("T1_newest_by_index_page", forum_hits(f"{HAS_TERM} AND time_secs <= {END}", 20, 40))
def _(t):
    return newest(t, QUERY, 20, None, END, offset=40)


@query("T2_newest_by_index", forum_hits(
    f"{HAS_TERM} AND time_secs BETWEEN {START} AND {END} AND uid IN (SELECT user_id FROM r_userlist WHERE list_id IN (1, 2))"))
def _(t):
    people = t.userlist.filter("list_id IN (1, 2)").select("user_id")
    return newest(t, QUERY, 200, START, END, people)


@query("T3_forum_search", forum_hits(
    f"{HAS_TERM} AND time_secs BETWEEN {START} AND {END} AND floor BETWEEN 2 AND 5 AND uid IN (1, 2, 3, 10, 11, 12, 40, 41)"))
def _(t):
    return S.search_forum(
        forum_index(t), t.forum, QUERY, START, END, "2-5", [1, 2, 3, 10, 11, 12, 40, 41], 200, buckets=FOLDERS
    )


@query("T4_range_only_search", forum_hits(f"time_secs BETWEEN {START} AND {END} AND floor BETWEEN 1 AND 3"))
def _(t):
    return S.search_forum(None, t.forum, "", START, END, "1-3", k=200)


@query("T5_token_column", f"""
SELECT doc_id, array_to_string(list_sort(list_distinct({tokens_sql('text')})), ',') AS token_set FROM documents""")
def _(t):
    return S.with_tokens(t.table("documents"), "text").select("doc_id", joined(F.col("token_set")).alias("token_set"))


@query("T6_build_postings", f"""
SELECT term, doc_id, CAST(COUNT(*) AS INT) AS tf FROM (SELECT doc_id, unnest({tokens_sql('text')}) AS term FROM documents) x GROUP BY 1, 2""")
def _(t):
    # The given table is one row group.
    return S.build_postings(t.table("documents"), "doc_id", "text", spread=t.spark.sparkContext.defaultParallelism)


STAMPED = """
SELECT pid, content, time_secs, CASE WHEN pid % 13 = 0 THEN NULL
  ELSE TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * CAST(tid % 3 AS INT) END AS dbinserted FROM r_forum"""


@query("T7_incremental_index", f"""
SELECT term, doc_id, CAST(COUNT(*) AS INT) AS tf FROM (SELECT pid AS doc_id, unnest({tokens_sql('content')}) AS term
  FROM ({STAMPED}) s WHERE CAST(dbinserted AS DATE) IN (DATE '2024-01-02', DATE '2024-01-03')) x GROUP BY 1, 2""")
def _(t):
    # Each day's increment is appended to the stored index.
    docs, path = t.sql(STAMPED), shared_dir(t.spark, "increments")
    for day in (2, 3):
        found = S.index_increment(docs, "pid", "content", "time_secs", dt.date(2024, 1, day))
        S.write_postings(found.drop("time_secs"), path, FOLDERS)
    return t.spark.read.parquet(path).select("term", "doc_id", "tf")


@query("T7_day_again", f"""
SELECT term, doc_id, CAST(COUNT(*) AS INT) AS tf FROM (SELECT pid AS doc_id, unnest({tokens_sql('content')}) AS term
  FROM ({STAMPED}) s WHERE dbinserted IS NULL OR CAST(dbinserted AS DATE) IN (DATE '2024-01-02', DATE '2024-01-03')) x GROUP BY 1, 2""")
def _(t):
    """Days indexed again, one of them with other rows at first: the index holds what came last."""
    docs, table = t.sql(STAMPED), SI.index_table(t.spark, shared_dir(t.spark, "days"))
    found = SI.postings(docs.withColumn("user", F.lit(None)), "pid", "content", "time_secs", "user", "dbinserted", SPAN)
    wrong = SI.postings(docs.withColumns({"user": F.lit(1), "content": F.lit("wrong")}), "pid", "content", "time_secs", "user", "dbinserted", SPAN)
    second, third = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    for batch, (rows, day) in enumerate([(wrong, second), (found, third), (found, None), (found, second), (found, third)]):
        SI.index_day(table, rows, day, batch)
    return table.read().select("term", "doc_id", "tf")


def postings_of(where):
    return f"""
SELECT term, doc_id, CAST(COUNT(*) AS INT) AS tf FROM (SELECT id AS doc_id, unnest({tokens_sql('text')}) AS term
  FROM r_posts WHERE {where}) x GROUP BY 1, 2"""


@query("T7_index_by_ids", postings_of("id IN (SELECT retweeted_status FROM r_posts)"))
def _(t):
    wanted = t.posts.filter("retweeted_status IS NOT NULL").select("retweeted_status")
    return S.index_ids(t.posts, wanted, "id", "text", "created_at").drop("created_at")


@query("T7_index_from_csv", postings_of("user_id % 3 = 0"))
def _(t):
    path = shared_dir(t.spark, "to-index")
    write_csv(t.posts.filter("user_id % 3 = 0").select("id", "text", "created_at"), path)
    listed = read_csv(t.spark, path, "id BIGINT, text STRING, created_at TIMESTAMP_NTZ")
    return S.index_rows(listed, "id", "text", "created_at").drop("created_at")


@query("T7_incremental_index_week", f"""
SELECT term, doc_id, CAST(COUNT(*) AS INT) AS tf FROM (SELECT id AS doc_id, unnest({tokens_sql('text')}) AS term
  FROM r_posts WHERE isoyear(created_at) = 2024 AND week(created_at) = 2) x GROUP BY 1, 2""")
def _(t):
    week = scan_period(
        with_iso_week(t.posts), dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 14), ["id", "text", "created_at"]
    )
    return S.index_rows(week, "id", "text", "created_at").drop("created_at")
