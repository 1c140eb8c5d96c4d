"""Scalar expressions (X) over whole tables."""

from pyspark.sql import functions as F

from ripplekit.functions import geo as G
from ripplekit.functions import text as X
from ripplekit.functions import times as TM
from ripplekit.plans.catalog.base import api_date, joined, query

C, L = F.col, F.lit


@query("X1_iso_year_week", """
SELECT o_orderkey, CAST(isoyear(o_orderdate) AS INT) AS iso_year, CAST(week(o_orderdate) AS INT) AS iso_week FROM orders""")
def _(t):
    d = C("o_orderdate")
    return t.table("orders").select("o_orderkey", TM.iso_year(d).alias("iso_year"), TM.iso_week(d).alias("iso_week"))


@query("X2_multi_format_timestamp", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('minute', ts) END AS ts FROM events""")
def _(t):
    k = C("event_id") % 3
    s = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd")).when(
        k == 1, F.date_format("ts", "yyyy-MM-dd HH:mm")
    ).otherwise("soon")
    return t.table("events").select(
        "event_id", TM.parse_first(s, ["yyyy-MM-dd", "yyyy-MM-dd HH:mm"]).cast("timestamp_ntz").alias("ts")
    )


@query("X3_api_date", "SELECT event_id, date_trunc('second', ts) AS ts FROM events")
def _(t):
    return t.table("events").select("event_id", TM.parse_api_date(api_date("ts")).alias("ts"))


@query("X4_rss_pubdate", """
SELECT event_id, date_trunc('second', ts) - INTERVAL 1 MINUTE * (CASE event_id % 7 WHEN 0 THEN 480 WHEN 1 THEN 0 WHEN 2 THEN -300 WHEN 4 THEN 540 WHEN 6 THEN 0 ELSE 480 END)
  * (CASE WHEN event_id % 7 = 5 THEN NULL ELSE 1 END) AS pubdate FROM events""")
def _(t):
    rfc = F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss")
    k = C("event_id") % 7
    s = (
        F.when(k == 0, F.concat(rfc, L(" +0800")))
        .when(k == 1, F.concat(rfc, L(" GMT")))
        .when(k == 2, F.concat(F.date_format("ts", "d MMM yyyy HH:mm:ss"), L(" EST")))
        .when(k == 4, F.concat(rfc, L(" JST")))
        .when(k == 5, F.concat(rfc, L(" NOWHERE")))
        .when(k == 6, F.concat(F.date_format("ts", "dd MMM yy HH:mm:ss"), L(" GMT")))
        .otherwise(F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
    )
    return t.table("events").select("event_id", TM.parse_pubdate(s).alias("pubdate"))


@query("X5_time_bucket", """
SELECT event_id, date_trunc('hour', ts) AS h, date_trunc('hour', ts) + INTERVAL 10 MINUTE * CAST(floor(minute(ts) / 10) AS INT) AS m10,
  date_trunc('hour', ts) + INTERVAL 4 MINUTE * CAST(round_even(minute(ts) / 4.0, 0) AS INT) AS m4, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS d FROM events""")
def _(t):
    ts = C("ts")
    return t.table("events").select(
        "event_id", TM.bucket(ts, "h").alias("h"), TM.bucket(ts, "10m").alias("m10"),
        TM.bucket(ts, "4m").alias("m4"), TM.bucket(ts, "d").alias("d"),
    )


@query("X6_relative_period", """
SELECT o_orderkey, CAST(CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderdate AS DATE) - INTERVAL 1 DAY * CAST(o_orderkey % 40 + 1 AS INT)
  WHEN 1 THEN CAST(o_orderdate AS DATE) - INTERVAL 7 DAY * CAST(o_orderkey % 40 + 1 AS INT)
  ELSE CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH * CAST(o_orderkey % 40 + 1 AS INT) END AS TIMESTAMP) AS start_at FROM orders""")
def _(t):
    k = C("o_orderkey") % 3
    spec = F.concat((C("o_orderkey") % 40 + 1).cast("string"), F.when(k == 0, "d").when(k == 1, "W").otherwise("m"))
    start = TM.period_start(spec, F.to_date("o_orderdate"))
    return t.table("orders").select("o_orderkey", start.cast("timestamp_ntz").alias("start_at"))


@query("X7_epoch_conversions", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS utc_s, epoch_us(ts - INTERVAL 8 HOUR) // 1000 AS hkt_ms FROM events""")
def _(t):
    return t.table("events").select(
        "event_id", TM.epoch(C("ts")).alias("utc_s"), TM.epoch(C("ts"), "Asia/Hong_Kong", "ms").alias("hkt_ms")
    )


@query("X8_mention_chain", r"""
SELECT id, array_to_string(regexp_extract_all(text, '//@([^:：。./@\-，,【\[ ]*)', 1), ',') AS mentions FROM r_posts""")
def _(t):
    return t.posts.select("id", joined(X.mentions(C("text"))).alias("mentions"))


@query("X9_hashtags", r"""
SELECT id, array_to_string(regexp_extract_all(text, '#([^\s\[\]]+)', 1), ',') AS hashtags FROM r_posts
UNION ALL SELECT doc_id, array_to_string(regexp_extract_all(text, '#([^\s\[\]]+)', 1), ',') FROM documents""")
def _(t):
    tags = joined(X.hashtags(C("text"))).alias("hashtags")
    return t.posts.select("id", tags).union(t.table("documents").select("doc_id", tags))


@query("X10_short_urls", r"""
SELECT id, nullif(regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 1), '') AS "full",
  nullif(regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 2), '') AS base,
  nullif(regexp_extract(text, '(http://(sinaurl\.cn|t\.cn)/(\w+))', 3), '') AS hash FROM r_posts""")
def _(t):
    return t.posts.select("id", X.short_url(C("text")).alias("u")).select("id", "u.*")


@query("X11_url_split", r"""
SELECT page_id, nullif(regexp_extract(url, '^http://([a-zA-Z0-9\-.]+)/(.*)$', 1), '') AS base,
  nullif(regexp_extract(url, '^http://([a-zA-Z0-9\-.]+)/(.*)$', 2), '') AS path FROM pages""")
def _(t):
    return t.table("pages").select("page_id", X.url_parts(C("url")).alias("u")).select("page_id", "u.*")


@query("X12_last_component", """
SELECT provid, cityid, split_part(name_en, ', ', 3) AS province_en FROM r_provinces""")
def _(t):
    return t.provinces.select("provid", "cityid", X.last_components(C("name_en")).alias("province_en"))


@query("X13_pg_array_literal", """
SELECT id, '{' || screen_name || ',"a,b",' || CAST(id AS STRING) || '}' AS lit, 3 AS n, 'a,b' AS second,
  id + province AS total FROM r_users""")
def _(t):
    items = F.array(C("screen_name"), L("a,b"), C("id").cast("string"))
    lit = X.format_pg_array(items)
    back = X.parse_pg_array(lit)
    numbers = X.parse_pg_array(F.concat(L("{"), C("id"), L(","), C("province"), L("}")), "bigint")
    return t.users.select(
        "id", lit.alias("lit"), F.size(back).alias("n"), F.get(back, 1).alias("second"),
        F.aggregate(numbers, L(0).cast("bigint"), lambda a, x: a + x).alias("total"),
    )


@query("X14_wkt_point", """
SELECT id, 'SRID=4326;POINT(' || CAST(lon AS STRING) || ' ' || CAST(lat AS STRING) || ')' AS from_pair,
  'SRID=4326;POINT(' || CAST(lon AS STRING) || ' ' || CAST(lat AS STRING) || ')' AS from_text FROM r_places""")
def _(t):
    latlng = F.concat(C("lat").cast("string"), L(" "), C("lon").cast("string"))
    return t.places.select(
        "id", G.wkt_point(C("lat"), C("lon")).alias("from_pair"), G.wkt_from_text(latlng).alias("from_text")
    )


@query("X15_point_from_wkt", """
SELECT id, '<Point><coordinates>' || CAST(lon AS STRING) || ',' || CAST(lat AS STRING) || '</coordinates></Point>' AS kml FROM r_places""")
def _(t):
    return t.places.select("id", G.kml_point(C("lon"), C("lat")).alias("kml"))


@query("X16_csv_quote", """
SELECT page_id, '"' || replace(html, '"', '""') || '"' AS quoted FROM pages""")
def _(t):
    return t.table("pages").select("page_id", X.csv_quote(C("html")).alias("quoted"))


SPEC = """
SELECT pid, floor, CASE floor % 3 WHEN 0 THEN CAST(floor AS STRING) || '-' || CAST(floor + 4 AS STRING)
  WHEN 1 THEN CAST(floor AS STRING) ELSE 'all' END AS spec FROM r_forum"""


@query("X17_page_range", f"""
SELECT pid, spec, CAST(CASE WHEN floor % 3 < 2 THEN floor END AS INT) AS first,
  CAST(CASE floor % 3 WHEN 0 THEN floor + 4 WHEN 1 THEN floor END AS INT) AS last FROM ({SPEC}) s""")
def _(t):
    return t.sql(SPEC).select("pid", "spec", X.page_range(C("spec")).alias("r")).select("pid", "spec", "r.*")
