"""Filters with SQL null rules, sources, sinks and their plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from ripplekit.functions.times import parse_pubdate
from ripplekit.operators import aggregates as A
from ripplekit.operators import filters as fl
from ripplekit.operators import search as S
from ripplekit.plans import reports as R
from ripplekit.plans.roles import Roles
from ripplekit.session import shared_dir
from ripplekit.sources import readers as RD
from ripplekit.sources import writers as WR


def test_not_in_drops_nulls_only_when_the_list_has_ids(spark):
    links = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "id int, rt_status_id bigint")
    spam = spark.createDataFrame([(10,)], "id bigint")
    assert rows(fl.drop_spam(links, spam), "id") == [(3,)]
    assert rows(fl.drop_spam(links, spam.limit(0)), "id") == [(1,), (2,), (3,)]


@pytest.mark.parametrize(
    "name, hit",
    [("Taipei fans", True), ("TAIWAN Hong Kong", False), ("台北會", True), ("香港台北", False), ("London", False), (None, False)],
)
def test_region_words(spark, name, hit):
    df = spark.createDataFrame([(1, name, None, None)], "id int, name string, link string, watching boolean")
    assert fl.keyword_rule(df, ["name"], ("link",)).count() == int(hit)


def test_decided_rows_are_left_alone(spark):
    df = spark.createDataFrame([(1, "taiwan", False), (2, "taiwan", True), (3, "taiwan", None)], "id int, name string, watching boolean")
    assert rows(fl.keyword_rule(df, ["name"]), "id") == [(2,), (3,)]


def test_spam_sites_match_inside_hosts_and_paths(spark):
    links = spark.createDataFrame(
        [(1, "http://www.bad.com/x"), (2, "http://good.com/bad.com"), (3, "http://notbad.com.cn/"), (4, "http://shop.org/deal/1"),
         (5, "https://bad.com/"), (6, None), (7, "http://bad.com"), (8, "http://x.org/shop.org/deal")],
        "id int, location string",
    )
    sites = spark.createDataFrame([("bad.com",), ("shop.org/deal",), ("",), (None,)], "site string")
    got = fl.flag_spam(links, sites).filter("is_spam")
    assert rows(got, "id") == [(1,), (3,), (4,), (7,)]
    assert fl.flag_spam(links, sites).count() == 8
    assert rows(fl.flag_spam(links, sites.limit(0)).filter("is_spam"), "id") == []


def test_boxes_in_several_cells(spark):
    points = spark.createDataFrame([(1, 114.2, 22.3), (2, 115.9, 23.9), (3, -0.5, -0.5)], "id int, lon double, lat double")
    boxes = spark.createDataFrame(
        [("hk", 113.8, 22.1, 116.0, 24.0), ("zero", -1.0, -1.0, 1.0, 1.0)],
        "name string, lon0 double, lat0 double, lon1 double, lat1 double",
    )
    assert rows(fl.in_bbox(points, boxes), "id", "name") == [(1, "hk"), (2, "hk"), (3, "zero")]


def test_weekly_table_prunes_partitions_and_replaces_only_its_weeks(spark):
    posts = spark.range(400).select(
        "id", F.expr("timestamp_ntz '2023-12-20' + make_dt_interval(0, int(id) * 4)").alias("created_at")
    )
    path = shared_dir(spark, "weekly")
    WR.write_weekly(posts, path)
    before = spark.read.parquet(path).count()
    WR.write_weekly(posts.filter("created_at >= timestamp_ntz '2024-02-05'"), path)
    assert spark.read.parquet(path).count() == before == 400
    start, end = dt.datetime(2023, 12, 28), dt.datetime(2024, 1, 3)
    scan = RD.scan_period(spark.read.parquet(path), start, end, ["id", "created_at"])
    text = plan(scan)
    assert "PartitionFilters: [isnotnull" in text or "PartitionFilters: [((" in text
    assert "ReadSchema: struct<id:bigint,created_at:timestamp_ntz>" in text
    weeks = {r["created_at"].isocalendar()[:2] for r in scan.collect()}
    assert weeks == {(2023, 52), (2024, 1)}


def test_whole_file_payloads_and_broken_ones(spark):
    path = shared_dir(spark, "dumps")
    docs = ['[{"id": 1},\n {"id": 2}]', '{"id": 3}', '{"id": ', "[]"]
    for i, doc in enumerate(docs):
        spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(f"{path}/{i}")
    got = RD.read_payloads(spark, f"{path}/*", "id BIGINT", whole_file=True)
    assert rows(got.filter("id IS NOT NULL")) == [(1,), (2,), (3,)]


AWKWARD = ['say "hi", \\ there', "a\nb", "a\r\nb\r", "\\n", "\\b\\", "", None, " x\t ", '"', "\\N", "é,;", "#"]


@pytest.mark.parametrize("sep", [",", "\t"])
def test_report_files_round_trip_text(spark, sep):
    df = spark.createDataFrame([(i, t, [1, 2]) for i, t in enumerate(AWKWARD)], "id bigint, t string, xs array<int>")
    path = shared_dir(spark, "csv")
    WR.write_csv(df, path, sep)
    back = RD.read_csv(spark, path, "id bigint, t string, xs string", sep=sep)
    assert [(r.id, r.t, r.xs) for r in back.orderBy("id").collect()] == [(i, t, "[1,2]") for i, t in enumerate(AWKWARD)]
    only = shared_dir(spark, "csv")
    WR.write_csv(df.select("t"), only, sep)
    assert rows(RD.read_csv(spark, only, "t string", sep=sep)) == rows(df, "t")


def test_foreign_files_and_unreadable_records(spark):
    path = shared_dir(spark, "csv")
    spark.createDataFrame([('1,"a\nb \\" c"\n2,d\nx,e\n',)], "value string").coalesce(1).write.text(path)
    got = RD.read_csv(spark, path, "id bigint, t string", header=False, multi_line=True)
    assert rows(got) == [(1, 'a\nb " c'), (2, "d")]
    bad = RD.unreadable_csv(spark, path, "id bigint, t string", header=False, multi_line=True)
    assert [r.record.strip() for r in bad.collect()] == ["x,e"]


def test_a_late_row_joins_its_week(spark):
    posts = spark.range(400).select(
        "id", F.expr("timestamp_ntz '2023-12-20' + make_dt_interval(0, int(id) * 4)").alias("created_at")
    )
    path = shared_dir(spark, "weekly")
    WR.write_weekly(posts, path)
    late = spark.createDataFrame([(1000,)], "id bigint").select("id", F.expr("timestamp_ntz '2024-01-01'").alias("created_at"))
    for _ in range(2):
        WR.write_weekly(late, path)
    assert rows(spark.read.parquet(path), "id", "created_at") == rows(posts.union(late))
    WR.replace_weeks(late, path)
    week = spark.read.parquet(path).filter("iso_year = 2024 AND iso_week = 1")
    assert rows(week, "id") == [(1000,)]


def test_feed_dates_of_any_form(spark):
    dates = {
        "01 Jan 11 10:11 GMT": "2011-01-01 10:11:00", "Sat, 01 Jan 11 10:11:12 EST": "2011-01-01 15:11:12",
        "01 Jan 99 00:00 +0100": "1998-12-31 23:00:00", "1 Jul 2011 12:00 JST": "2011-07-01 03:00:00",
        "1 Jul 2011 12:00 Europe/Paris": "2011-07-01 10:00:00", "1 Jul 2011 12:00 NOWHERE": None, "soon": None,
        "2011/01/02": "2011-01-01 16:00:00",
    }
    df = spark.createDataFrame([(d,) for d in dates], "d string")
    got = df.select("d", parse_pubdate(F.col("d")).cast("string").alias("t"))
    assert {r.d: r.t for r in got.collect()} == dates


def test_search_equals_a_plain_token_filter(spark, sf):
    t = Roles(spark, sf)
    words = {"the", "que"}
    hits = S.search(S.build_postings(t.forum, "pid", "content"), t.forum, "The que", k=10_000, doc_id="pid", user="uid", ts="time_secs")
    plain = [r["pid"] for r in S.with_tokens(t.forum, "content").collect() if words & set(r["token_set"])]
    got = hits.collect()
    assert sorted(r["pid"] for r in got) == sorted(plain) and plain
    assert {r["total_hits"] for r in got} == {len(plain)}
    assert [r["time_secs"] for r in got] == sorted((r["time_secs"] for r in got), reverse=True)


def test_postings_table_is_found_by_term_bucket(spark, sf):
    t = Roles(spark, sf)
    path = shared_dir(spark, "postings")
    built = S.build_postings(t.forum, "pid", "content")
    S.write_postings(built, path, 16)
    stored = spark.read.parquet(path)
    assert stored.drop("term_bucket").exceptAll(built).isEmpty()
    one = stored.filter(F.col("term_bucket") == S.term_bucket(F.lit("the"), 16)).filter("term = 'the'")
    assert one.count() == built.filter("term = 'the'").count() > 0
    assert "PartitionFilters: [isnotnull(term_bucket" in plan(one)


def test_search_reads_only_the_terms_folders(spark, sf):
    t = Roles(spark, sf)
    path = shared_dir(spark, "postings")
    S.write_postings(S.build_postings(t.forum, "pid", "content"), path, 16)
    found = S.match_any(spark.read.parquet(path), "the que", 16)
    scan = plan(found)
    assert "PartitionFilters: [term_bucket" in scan and "In(term, [" in scan, scan


def test_search_bounds_and_lists_that_are_not_given(spark, sf):
    t = Roles(spark, sf)
    posts = t.forum.select("pid", "uid", "tid", "time_secs", "floor")
    middle = posts.agg(F.expr("percentile_approx(time_secs, 0.5)")).first()[0]
    late = S.search_forum(None, posts, "", start=middle)
    early = S.search_forum(None, posts, "", end=middle, uids=[])
    assert late.count() == posts.filter(F.col("time_secs") >= middle).count()
    assert early.count() == posts.filter(F.col("time_secs") <= middle).count()
    page = S.search_forum(None, posts, "", k=5, offset=5).collect()
    assert [r.pid for r in page] == [r.pid for r in S.search_forum(None, posts, "", k=10).collect()][5:]


def test_boxes_of_any_size_and_place(spark):
    rng = random.Random(4)
    points = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(300)]
    points += [(i, 114 + rng.random() / 50, 22 + rng.random() / 50) for i in range(300, 600)]
    boxes = [(f"w{i}", x := rng.uniform(-180, 100), y := rng.uniform(-90, 20), x + rng.uniform(0, 80), y + rng.uniform(0, 70)) for i in range(20)]
    boxes += [(f"c{i}", x := 114 + rng.random() / 60, y := 22 + rng.random() / 60, x + 0.003, y + 0.001) for i in range(20)]
    boxes += [("dot", points[400][1], points[400][2], points[400][1], points[400][2])]
    got = fl.in_bbox(
        spark.createDataFrame(points, "id int, lon double, lat double"),
        spark.createDataFrame(boxes, "name string, lon0 double, lat0 double, lon1 double, lat1 double"),
    )
    want = [(i, n) for i, lon, lat in points for n, a, b, c, d in boxes if a <= lon <= c and b <= lat <= d]
    assert rows(got, "id", "name") == sorted(want, key=repr)


def test_top_k_is_one_pass_and_small_lists_do_not_shuffle_the_posts(spark, sf):
    t = Roles(spark, sf)
    ranked = A.rank_reposted(t.posts, t.users, dt.datetime(2024, 1, 5), limit=10)
    text = plan(ranked)
    assert "TakeOrderedAndProject" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "ts,TimestampNTZType" in text.replace(" ", "") or "GreaterThanOrEqual(ts" in text
    looked_up = plan(A.most_reposted(t.posts, t.users, dt.datetime(2024, 1, 5), limit=10))
    assert "LeftSemi" in looked_up and "Exchange hashpartitioning" not in looked_up


def test_aligned_chunks_hold_every_repost_once(spark, sf):
    t = Roles(spark, sf)
    chunks = A.collect_reposts(t.posts, t.users, chunk=2)
    assert chunks.agg(F.max(F.size("ids"))).first()[0] <= 8
    flat = chunks.select("retweeted_status", F.explode(F.arrays_zip("ids", "user_ids", "genders")).alias("z"))
    want = t.posts.filter("retweeted_status IS NOT NULL").join(
        t.users.select(F.col("id").alias("u"), "gender"), F.col("user_id") == F.col("u"), "left"
    )
    assert rows(flat, "retweeted_status", "z.ids", "z.user_ids", "z.genders") == rows(
        want, "retweeted_status", "id", "user_id", "gender"
    )


def test_trend_has_no_gaps(spark, sf):
    t = Roles(spark, sf)
    total = t.posts.filter("retweeted_status IS NOT NULL").count()
    for minutes in (4, 7, 25, 45, 90):  # buckets start anew each hour
        series = R.trend_series(t.posts.filter("id < 3000"), t.users, f"{minutes}m")
        assert series.agg(F.sum("count")).first()[0] == t.posts.filter("retweeted_status IS NOT NULL AND id < 3000").count()
    for interval, seconds in (("h", 3600), ("d", 86400), ("30m", 1800)):
        by_post = {}
        for r in R.trend_series(t.posts, t.users, interval).collect():
            by_post.setdefault(r["retweeted_status"], []).append((r["time"], r["count"]))
        for series in by_post.values():
            series.sort()
            assert all((b[0] - a[0]).total_seconds() == seconds for a, b in zip(series, series[1:]))
        assert sum(c for s in by_post.values() for _, c in s) == total


def test_feeds_are_parsed_once(spark):
    """Filters on the date and the fields asked for do not copy the parsing of an item."""
    feed = "<rss><item><title>a</title><pubDate>Sat, 01 Jan 11 10:00:00 +0800</pubDate></item><item><title>b</title></item></rss>"
    df = spark.createDataFrame([(1, feed), (2, None)], "blog int, feed string")
    for found, want in (
        (RD.read_rss(df, "feed").select("blog", "title", "pubdate"), [(1, "a", dt.datetime(2011, 1, 1, 2))]),
        (RD.undated_items(df, "feed").select("blog", "title", "written"), [(1, "b", None)]),
    ):
        text = found._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("from_xml") == 1 and text.count("regexp_extract(") <= 8
        assert rows(found) == want
