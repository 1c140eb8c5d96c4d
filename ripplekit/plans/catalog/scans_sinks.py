"""Sources and sinks (S): each query writes files Spark derives from whole
tables into the shared folder and reads them back through the operator."""

import datetime as dt

from pyspark.sql import functions as F

from ripplekit.operators import aggregates as A
from ripplekit.operators import normalize as P
from ripplekit.plans.catalog.aggregation import REPORT_SQL, report
from ripplekit.plans.catalog.base import END, START, query
from ripplekit.plans.catalog.payloads import C, L, status_json, text_of
from ripplekit.session import shared_dir
from ripplekit.sources import parts as PT
from ripplekit.sources import readers as RD
from ripplekit.sources import writers as WR


@query("S1_json_payload_scan", """
SELECT id, date_trunc('second', created_at) AS created_at, text, user_id, retweeted_status FROM r_status""")
def _(t):
    path = shared_dir(t.spark, "payloads")
    page = F.floor(C("id") / 100)
    rows = t.status.select(page.alias("page"), status_json().alias("j"))
    # Every third page is an array document, the others one object per line;
    # each page also leaves one line cut off in the middle.
    arrays = rows.filter("page % 3 = 0").groupBy("page").agg(
        F.concat(L("["), F.array_join(F.collect_list("j"), ","), L("]")).alias("value")
    )
    singles = rows.filter("page % 3 <> 0").select(C("j").alias("value"))
    broken = rows.groupBy("page").agg(F.substring(F.max("j"), 1, 20).alias("value"))
    arrays.select("value").union(singles).union(broken.select("value")).write.text(path)
    return P.post_rows(RD.read_payloads(t.spark, path, P.STATUS_SCHEMA)).select(
        "id", "created_at", "text", "user_id", "retweeted_status"
    )


@query("S2_payload_error_split", """
SELECT id, 'ok' AS kind, CAST(NULL AS STRING) AS error_code, CAST(NULL AS BOOLEAN) AS fatal FROM r_posts WHERE user_id % 10 > 3
UNION ALL SELECT id, 'error', CASE user_id % 10 WHEN 0 THEN '40302' WHEN 1 THEN '40023' WHEN 2 THEN '40031' ELSE '50000' END,
  user_id % 10 < 3 FROM r_posts WHERE user_id % 10 <= 3""")
def _(t):
    k = C("user_id") % 10
    error = (
        F.when(k == 0, "40302:Error: auth failed").when(k == 1, "40023:Error: spam")
        .when(k == 2, "40031:Error: gone")
    )
    message = F.when(k == 3, "50000:Error: busy")
    payload = P.parse(
        t.posts.select(text_of(id=C("id"), error=error, error_msg=message).alias("j")), "j",
        "id BIGINT, error STRING, error_msg STRING",
    )
    ok, errors = RD.split_errors(payload, ("error", "error_msg"))
    none = L(None)
    return ok.select(
        "id", L("ok").alias("kind"), none.cast("string").alias("error_code"), none.cast("boolean").alias("fatal")
    ).union(errors.select("id", L("error"), "error_code", "fatal"))


# Whole texts, some null, empty, or with quotes, backslashes and line breaks of both kinds.
AWKWARD_SQL = r"""CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' "' || text || '\n\b", \' || chr(13) || chr(10) || '\N' ELSE text END"""


def awkward_text():
    k = C("doc_id") % 10
    odd = F.concat(L(' "'), C("text"), L('\\n\\b", \\'), L("\r\n"), L("\\N"))
    return F.when(k == 1, "").when(k == 2, odd).when(k != 0, C("text"))


@query("S3_csv_scan", f"SELECT doc_id, {AWKWARD_SQL} AS text, lang FROM documents")
def _(t):
    path = shared_dir(t.spark, "csv")
    WR.write_csv(t.table("documents").select("doc_id", awkward_text().alias("text"), "lang"), path)
    return RD.read_csv(t.spark, path, "doc_id BIGINT, text STRING, lang STRING")


@query("S3_csv_unreadable", """
SELECT id, 'read' AS kind FROM r_posts WHERE id % 3 <> 0 UNION ALL SELECT id, 'unreadable' FROM r_posts WHERE id % 3 = 0""")
def _(t):
    path, schema = shared_dir(t.spark, "csv"), "id BIGINT, user_id BIGINT, name STRING"
    line = F.concat(C("id").cast("string"), F.when(C("id") % 3 != 0, ",7,").otherwise(",seven,"), C("screen_name"))
    t.posts.select(line).write.text(path)
    good = RD.read_csv(t.spark, path, schema, header=False).select("id", L("read").alias("kind"))
    bad = RD.unreadable_csv(t.spark, path, schema, header=False)
    return good.union(bad.select(F.split_part("record", L(","), L(1)).cast("bigint"), L("unreadable")))


@query("S4_idlist_scan", "SELECT id FROM r_posts WHERE user_id % 3 < 2")
def _(t):
    path = shared_dir(t.spark, "ids")
    k, i = C("user_id") % 3, C("id").cast("string")
    line = F.when(k == 0, i).when(k == 1, F.concat(i, L(",group,watching"))).otherwise(F.concat(L("x"), i))
    t.posts.select(line.alias("value")).write.text(path)
    return RD.read_ids(t.spark, path)


def feeds(t):
    """Feeds of 50 posts; dates with two-digit years, offsets, names, an unknown zone, or none."""
    i, k = C("id").cast("string"), C("user_id") % 7
    long, short = (F.date_format("created_at", f"EEE, dd MMM {y} HH:mm:ss") for y in ("yyyy", "yy"))
    date = (
        F.when(k == 1, F.concat(short, L(" +0800"))).when(k == 2, F.concat(long, L(" JST")))
        .when(k == 3, F.concat(long, L(" XYZ"))).when(k != 0, F.concat(long, L(" +0800")))
    )
    item = F.concat(
        L("<item><title>post "), i, L("</title><link>http://blog/"), i, L("</link><description><![CDATA["),
        C("text"), L("]]></description>"),
        F.when(C("id") % 2 == 0, F.concat(L("<author>"), C("screen_name"), L("</author>"))).otherwise(""),
        F.coalesce(F.concat(L("<pubDate>"), date, L("</pubDate>")), L("")),
        L("</item>"),
    )
    return t.posts.groupBy(F.floor(C("id") / 50).alias("blogid")).agg(
        F.concat(L("<rss><channel>"), F.array_join(F.collect_list(item), "\n"), L("</channel></rss>")).alias("feed")
    )


@query("S5_rss_items_scan", """
SELECT id // 50 AS blogid, 'post ' || CAST(id AS STRING) AS title, 'http://blog/' || CAST(id AS STRING) AS link,
  text AS description, CASE WHEN id % 2 = 0 THEN screen_name END AS author,
  date_trunc('second', created_at) - INTERVAL 1 HOUR * (CASE user_id % 7 WHEN 2 THEN 9 ELSE 8 END) AS pubdate
FROM r_posts WHERE user_id % 7 NOT IN (0, 3)""")
def _(t):
    return RD.read_rss(feeds(t), "feed").select("blogid", "title", "link", "description", "author", "pubdate")


@query("S5_rss_undated_items", """
SELECT id // 50 AS blogid, 'http://blog/' || CAST(id AS STRING) AS link,
  CASE user_id % 7 WHEN 3 THEN strftime(created_at, '%a, %d %b %Y %H:%M:%S XYZ') END AS written
FROM r_posts WHERE user_id % 7 IN (0, 3)""")
def _(t):
    return RD.undated_items(feeds(t), "feed").select("blogid", "link", "written")


@query("S6_week_partition_scan", """
SELECT id, created_at, user_id FROM r_posts
WHERE isoyear(created_at) * 100 + week(created_at) BETWEEN isoyear(TIMESTAMP '2024-01-05') * 100 + week(TIMESTAMP '2024-01-05')
  AND isoyear(TIMESTAMP '2024-01-25') * 100 + week(TIMESTAMP '2024-01-25')""")
def _(t):
    path = shared_dir(t.spark, "weekly")
    WR.write_weekly(t.posts, path)
    return RD.scan_period(t.spark.read.parquet(path), START, END, ["id", "created_at", "user_id"])


@query("S7_multi_table_union_scan", """
SELECT 'weibo' AS network, id, text FROM r_dated WHERE CAST(dbinserted AS DATE) = DATE '2024-01-12'
UNION ALL SELECT 'forum', pid, content FROM r_forum WHERE tid % 20 = 11""")
def _(t):
    tables = {
        "weibo": t.dated.select("id", "text", "dbinserted"),
        "forum": t.sql("""SELECT pid AS id, content AS text,
          TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * CAST(tid % 20 AS INT) AS dbinserted FROM r_forum"""),
    }
    parts = [RD.scan_network(tables, n, dt.date(2024, 1, 12)).select("network", "id", "text") for n in tables]
    return parts[0].union(parts[1])


WEEKLY_SQL = """
SELECT id, created_at, CAST(isoyear(created_at) AS INT) AS iso_year, CAST(week(created_at) AS INT) AS iso_week FROM r_posts"""
WEEKLY = ["id", "created_at", "iso_year", "iso_week"]


@query("S8_partitioned_write", WEEKLY_SQL)
def _(t):
    path = shared_dir(t.spark, "weekly")
    WR.write_weekly(t.posts.select("id", "created_at"), path)
    return t.spark.read.parquet(path).select(WEEKLY)


@query("S8_late_rows", WEEKLY_SQL)
def _(t):
    """Rows that come late join the weeks already stored; a batch that comes again changes nothing."""
    path, posts = shared_dir(t.spark, "weekly"), t.posts.select("id", "created_at")
    WR.write_weekly(posts.filter("id % 5 <> 0"), path)
    for _ in range(2):
        WR.write_weekly(posts.filter("id % 5 < 2"), path)
    return t.spark.read.parquet(path).select(WEEKLY)


@query("S8_empty_first_batch", WEEKLY_SQL)
def _(t):
    """A first batch without rows leaves a table that later ones join."""
    path, posts = shared_dir(t.spark, "weekly"), t.posts.select("id", "created_at")
    WR.write_weekly(posts.filter("id IS NULL"), path)
    WR.write_weekly(posts, path)
    return t.spark.read.parquet(path).select(WEEKLY)


@query("S8_staged_batches", WEEKLY_SQL)
def _(t):
    """Batches committed one by one; one stops after writing, one comes again, one has only rows that are known."""
    posts = t.posts.select("id", "created_at")
    table = PT.PartTable(t.spark, shared_dir(t.spark, "weeks"), "id BIGINT, created_at TIMESTAMP_NTZ, iso_year INT, iso_week INT")
    PT.insert_weeks(table, posts.filter("id % 5 <> 0"), 0)
    table.stage(posts.filter("id % 5 = 0").selectExpr("*", "0 AS iso_year", "0 AS iso_week", "0 AS part"), 1)  # never committed
    for batch, rows in ((1, posts.filter("id % 5 < 2")), (1, posts), (2, posts.filter("id % 5 = 3"))):
        PT.insert_weeks(table, rows, batch)
    return table.read().select(WEEKLY)


@query("S8_replace_weeks", WEEKLY_SQL + """
WHERE created_at < TIMESTAMP '2024-01-22' OR user_id % 2 = 0""")
def _(t):
    path, posts = shared_dir(t.spark, "weekly"), t.posts.select("id", "created_at", "user_id")
    WR.replace_weeks(posts, path)
    WR.replace_weeks(posts.filter(C("created_at") >= L(dt.datetime(2024, 1, 22)).cast("timestamp_ntz")).filter("user_id % 2 = 0"), path)
    return t.spark.read.parquet(path).select(WEEKLY)


@query("S9_csv_report_sink", REPORT_SQL + "SELECT id, user_name, text, count, provname_en FROM rep")
def _(t):
    path = shared_dir(t.spark, "report")
    WR.write_csv(report(t).select("id", "user_name", "text", "count", "provname_en"), path, "\t")
    schema = "id BIGINT, user_name STRING, text STRING, count BIGINT, provname_en STRING"
    return RD.read_csv(t.spark, path, schema, sep="\t")


@query("S10_json_report_sink", REPORT_SQL + """
SELECT '{"rts":[' || string_agg('{"count":' || CAST(count AS STRING) || ',"id":' || CAST(id AS STRING) || ',"user_name":"' || user_name || '"}', ','
  ORDER BY count DESC, id DESC) || '],"dategen":1706659200000}' AS document FROM rep""")
def _(t):
    top = report(t).select("count", "id", "user_name")
    return WR.report_json(top, L(1706659200000), 200)


@query("S11_count_files_sink", """
WITH r AS (SELECT retweeted_status AS id, COUNT(*) AS n FROM r_posts WHERE retweeted_status IS NOT NULL GROUP BY 1),
c AS (SELECT status_id AS id, COUNT(*) AS n FROM r_comments GROUP BY 1)
SELECT coalesce(r.id, c.id) AS id, coalesce(r.n, 0) AS reposts, coalesce(c.n, 0) AS comments FROM r FULL OUTER JOIN c ON r.id = c.id""")
def _(t):
    path = shared_dir(t.spark, "counts")
    WR.write_counts(A.engagement_counts(t.posts, t.comments), path)
    return t.spark.read.parquet(path).drop("bucket")


@query("S12_log_append_sink", """
SELECT id, 'spam' AS kind FROM r_posts WHERE retweeted_status IS NULL UNION ALL SELECT id, 'query' FROM r_comments""")
def _(t):
    path = shared_dir(t.spark, "log")
    WR.append_log(t.posts.filter("retweeted_status IS NULL").select("id", L("spam").alias("kind")), path)
    WR.append_log(t.comments.select("id", L("query").alias("kind")), path)
    return t.spark.read.parquet(path)
