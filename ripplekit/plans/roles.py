"""Role views: the driver's tables read as posts, users, lists, snapshots, ...

The same SQL text derives a view in Spark (as a common table expression over
the Parquet files) and in the checking SQL, so both sides start from equal rows.
"""

from __future__ import annotations

import re
import zlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the given tables the role views are made from.
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}
BASE_TABLES = list(TABLE_SCHEMAS)

ROLES = {
    "r_posts": """
SELECT id, created_at, user_id, screen_name, rt AS retweeted_status,
       CASE WHEN rt IS NULL THEN 'original #tag' || CAST(id % 7 AS STRING)
            ELSE 'agree//@' || CASE WHEN id % 50 = 0 THEN 'ghost' ELSE 'u' || CAST((user_id * 7 + rt) % 300 AS STRING) END
                 || ': ok//@u' || CAST((user_id + rt) % 150 AS STRING)
                 || ' #tag' || CAST(rt % 7 AS STRING) || ' http://t.cn/h' || CAST(rt % 40 AS STRING) END AS text
FROM (SELECT event_id AS id, ts AS created_at, user_id, 'u' || CAST(user_id AS STRING) AS screen_name,
             CASE WHEN event_type IN ('view', 'click', 'purchase') AND k < event_id
                  THEN CASE WHEN k % 10 = 9 THEN k + 1000000 ELSE k END END AS rt
      FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) x) e""",
    "r_users": """
SELECT c.c_custkey AS id, 'u' || CAST(c.c_custkey AS STRING) AS screen_name, c.c_nationkey AS province,
       CAST(c.c_custkey % 3 AS INT) AS city,
       CASE WHEN c.c_custkey % 7 = 0 THEN NULL WHEN c.c_custkey % 2 = 0 THEN 'm' ELSE 'f' END AS gender,
       CAST(floor(c.c_acctbal) AS BIGINT) AS followers_count, o.created_at
FROM customer c LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS created_at FROM orders GROUP BY o_custkey) o
  ON c.c_custkey = o.o_custkey""",
    "r_userlist": """
SELECT c_custkey AS user_id, CAST(c_custkey % 5 + 1 AS INT) AS list_id FROM customer
UNION ALL SELECT c_custkey, 6 FROM customer WHERE c_custkey % 4 = 0""",
    "r_provinces": """
SELECT n_nationkey AS provid, c.cityid, n_name AS provname, n_name || '-' || CAST(c.cityid AS STRING) AS cityname,
       'city' || CAST(c.cityid AS STRING) || ', ' || n_name || ', ' || r_name AS name_en
FROM (SELECT *, 0 AS cityid FROM nation UNION ALL SELECT *, 1 FROM nation UNION ALL SELECT *, 2 FROM nation) c
JOIN region ON n_regionkey = r_regionkey""",
    "r_snapshots": """
SELECT eid, retrieved,
       CAST(CASE eid % 6 WHEN 0 THEN cum WHEN 1 THEN 90 + cum WHEN 2 THEN 1500 + 3 * cum WHEN 3 THEN 1500 - 3 * cum
            WHEN 4 THEN 5000 + floor(cum / 8) ELSE 30 + floor(cum / 3) END AS BIGINT) AS cnt
FROM (SELECT user_id AS eid, day AS retrieved, SUM(n) OVER (PARTITION BY user_id ORDER BY day) AS cum
      FROM (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY user_id, CAST(ts AS DATE)) d) s""",
    "r_entities": """
SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'group' WHEN 1 THEN 'event' ELSE 'page' END AS type,
       CASE c_custkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END AS watching,
       CASE c_custkey % 5 WHEN 0 THEN 'hongkong' WHEN 1 THEN 'watching' WHEN 2 THEN 'watching' ELSE 'notwatching' END AS state,
       c_name || CASE c_custkey % 6 WHEN 0 THEN ' Taipei' WHEN 1 THEN ' TAIWAN Hong Kong' ELSE '' END AS name
FROM customer""",
    "r_rsvp": """
SELECT uid, eid, CASE last_type WHEN 'click' THEN 'attending' WHEN 'view' THEN 'declined'
                 WHEN 'error' THEN 'not_replied' WHEN 'signup' THEN 'unsure' END AS rsvp_status
FROM (SELECT user_id AS uid, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS eid,
             max_by(event_type, event_id) AS last_type
      FROM events GROUP BY user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)) x""",
    "r_comments": """
SELECT event_id AS id, ts AS created_at, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS status_id
FROM events WHERE event_type = 'error'""",
    "r_edges": """
SELECT DISTINCT user_id AS source_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS target_id FROM events""",
    "r_forum": """
SELECT conv_id * 1000 + turn AS pid, conv_id AS tid, conv_id % 150 AS uid, turn + 1 AS floor, text AS content,
       1704067200 + (conv_id * 60 + turn) * 60 AS time_secs FROM conversations""",
    "r_urlmap": """
SELECT 't.cn' AS base, 'h' || CAST(page_id AS STRING) AS hash, url AS location FROM pages""",
    # Posts with the date a crawler stored them; some were never stamped.
    "r_dated": """
SELECT *, CASE WHEN id % 11 <> 0 THEN created_at + INTERVAL 1 DAY END AS dbinserted FROM r_posts""",
    # Entities with the columns their own network record carries.
    "r_objects": """
SELECT id, type, watching, state, name,
       CASE WHEN id % 9 = 0 THEN 'http://fan.com.tw/p' || CAST(id AS STRING)
            WHEN id % 9 = 1 THEN 'http://hongkong.com.tw/' ELSE 'http://example.org/' || name END AS link,
       CASE WHEN type = 'event' THEN 'a night' || CASE id % 8 WHEN 0 THEN ' in Taipei' WHEN 1 THEN ' of Taiwan and Hong Kong' ELSE '' END
            END AS description,
       CASE WHEN type = 'event' AND id % 10 < 3 THEN CASE id % 10 WHEN 0 THEN 'TAIPEI' WHEN 1 THEN 'Hong Kong' ELSE 'Taiwan' END END AS location,
       TIMESTAMP '2023-12-15 00:00:00' + CAST(id % 47 AS INT) * INTERVAL 1 DAY AS retrieved,
       CASE WHEN type = 'event' THEN TIMESTAMP '2024-01-10 00:00:00' + CAST(id % 30 AS INT) * INTERVAL 1 DAY END AS end_time,
       CASE WHEN id % 5 = 0 THEN CASE type WHEN 'group' THEN 'event' WHEN 'event' THEN 'page' ELSE 'group' END
            ELSE type END AS declared_type
FROM r_entities""",
    # Users and posts with the further columns a report shows.
    "r_profiles": """
SELECT u.*, CAST(id % 500 AS INT) AS friends_count, CAST(id % 97 AS INT) AS statuses_count,
       'http://img.example/' || CAST(id AS STRING) AS profile_image_url, id % 11 = 0 AS verified FROM r_users u""",
    "r_media": """
SELECT p.*, CASE WHEN id % 4 = 0 THEN 'http://pic.example/t/' || CAST(id AS STRING) END AS thumbnail_pic,
       CASE WHEN id % 4 = 0 THEN 'http://pic.example/m/' || CAST(id AS STRING) END AS bmiddle_pic,
       CASE WHEN id % 4 = 0 THEN 'http://pic.example/o/' || CAST(id AS STRING) END AS original_pic,
       CAST(id % 13 AS INT) AS reposts_count, CAST(id % 5 AS INT) AS comments_count, CAST(id % 3 AS INT) AS mlevel FROM r_posts p""",
    # What an earlier crawl had stored: it had not seen the 'error' records.
    "r_known": """
SELECT event_id AS id FROM events WHERE event_type <> 'error'""",
    # Posts with what a status payload nests: the original and a position.
    "r_status": """
SELECT s.id, s.created_at, s.text, s.user_id, s.screen_name, s.retweeted_status,
       o.created_at AS o_created_at, o.text AS o_text, o.user_id AS o_user_id, o.screen_name AS o_screen_name,
       CASE WHEN s.id % 3 = 0 THEN 22 + s.user_id % 25 / CAST(100 AS DOUBLE) END AS lat,
       CASE WHEN s.id % 3 = 0 THEN 114 + s.user_id % 3 / CAST(100 AS DOUBLE) END AS lon
FROM r_posts s LEFT JOIN r_posts o ON s.retweeted_status = o.id""",
    # Hosts reported as spam sites.
    "r_sites": """
SELECT DISTINCT substr(regexp_extract(url, '://([^/]+)', 1), 5) AS site FROM pages WHERE url LIKE '%://www.%'""",
    # User positions for the geography operators.
    "r_places": """
SELECT id, province, city, 22 + province / CAST(100 AS DOUBLE) AS lat, 114 + city / CAST(100 AS DOUBLE) AS lon FROM r_users""",
}


# In Spark the number inside ``props`` comes out of a generator, which keeps the
# optimizer from copying its regular expression into every use further up.
NUMBERED = "(SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) x"
NUMBERED_ONCE = (
    "(SELECT * FROM events LATERAL VIEW explode(array(CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT))) n AS k) x"
)

# Most posts repost nothing. Their null keys would all meet in one task of a join by sorting; in Spark each is dealt by its own
# id instead, which the condition keeps from matching.
ORIGINALS = "ON s.retweeted_status = o.id"
ORIGINALS_DEALT = "ON coalesce(s.retweeted_status, s.id) = o.id AND s.retweeted_status IS NOT NULL"


def with_roles(sql: str) -> list[tuple[str, str]]:
    """Views a statement needs, dependencies first."""
    ordered: list[tuple[str, str]] = []

    def visit(text: str) -> None:
        for name, body in ROLES.items():
            if re.search(rf"\b{name}\b", text) and name not in [n for n, _ in ordered]:
                visit(body)
                ordered.append((name, body.strip()))

    visit(sql)
    return ordered


def _prefix(ctes: list[tuple[str, str]], sql: str) -> str:
    body = sql.strip()
    head = ",\n".join(f"{name} AS ({text})" for name, text in ctes)
    if not head:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def oracle(sql: str) -> str:
    """A checking statement with the role views it names spelled out."""
    return _prefix(with_roles(sql), sql)


class Roles:
    """Role views of one data directory as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._registered: set[str] = set()

    def table(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}")

    def _source(self, name: str) -> str:
        """A base table as a view of this directory; declared schemas save the
        footer-reading job of schema inference."""
        view = f"{name}_{zlib.crc32(self.dir.encode()):08x}"
        if name not in self._registered:
            df = self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.dir}/{name}.parquet")
            df.createOrReplaceTempView(view)
            self._registered.add(name)
        return f"SELECT * FROM {view}"

    def sql(self, statement: str) -> DataFrame:
        """Run a statement over role views and base tables."""
        ctes = [(name, body.replace(NUMBERED, NUMBERED_ONCE).replace(ORIGINALS, ORIGINALS_DEALT)) for name, body in with_roles(statement)]
        text = "\n".join([statement] + [body for _, body in ctes])
        base = [
            (t, self._source(t))
            for t in BASE_TABLES
            if re.search(rf"\b{t}\b", text)
        ]
        return self.spark.sql(_prefix(base + ctes, statement))

    def view(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}")

    @cached_property
    def posts(self) -> DataFrame:
        return self.view("r_posts")

    @cached_property
    def users(self) -> DataFrame:
        return self.view("r_users")

    @cached_property
    def profiles(self) -> DataFrame:
        return self.view("r_profiles")

    @cached_property
    def media(self) -> DataFrame:
        return self.view("r_media")

    @cached_property
    def userlist(self) -> DataFrame:
        return self.view("r_userlist")

    @cached_property
    def provinces(self) -> DataFrame:
        return self.view("r_provinces")

    @cached_property
    def snapshots(self) -> DataFrame:
        return self.view("r_snapshots")

    @cached_property
    def entities(self) -> DataFrame:
        return self.view("r_entities")

    @cached_property
    def objects(self) -> DataFrame:
        # TIMESTAMP literals are zoned in Spark SQL; the tables' times are not.
        times = {c: F.col(c).cast("timestamp_ntz") for c in ["retrieved", "end_time"]}
        return self.view("r_objects").withColumns(times)

    @cached_property
    def rsvp(self) -> DataFrame:
        return self.view("r_rsvp")

    @cached_property
    def comments(self) -> DataFrame:
        return self.view("r_comments")

    @cached_property
    def edges(self) -> DataFrame:
        return self.view("r_edges")

    @cached_property
    def forum(self) -> DataFrame:
        return self.view("r_forum")

    @cached_property
    def urlmap(self) -> DataFrame:
        return self.view("r_urlmap")

    @cached_property
    def dated(self) -> DataFrame:
        return self.view("r_dated")

    @cached_property
    def known(self) -> DataFrame:
        return self.view("r_known")

    @cached_property
    def status(self) -> DataFrame:
        return self.view("r_status")

    @cached_property
    def sites(self) -> DataFrame:
        return self.view("r_sites")

    @cached_property
    def places(self) -> DataFrame:
        return self.view("r_places")
