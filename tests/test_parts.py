"""Tables in parts: what a batch reads and writes, replays, stops half-way, and what is built on them."""

import datetime as dt
import pathlib
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from ripplekit.operators import aggregates as A
from ripplekit.operators import joins as J
from ripplekit.operators import keyed as K
from ripplekit.operators import search_index as SI
from ripplekit.plans import reports as R
from ripplekit.plans.roles import Roles
from ripplekit.session import shared_dir
from ripplekit.sources import parts as P
from ripplekit.sources import writers as WR

STORE = "id bigint, name string, n int"
UPSERT = partial(K.upsert, keys=["id"], order=["seq"])


@pytest.fixture
def table(spark):
    table = P.KeyedTable(spark, shared_dir(spark, "store"), STORE, ["id"], 8)
    table.load(spark.createDataFrame([(i, f"s{i}", i) for i in range(200)], STORE), 0)
    return table


def batch_of(spark, data):
    return spark.createDataFrame(data, "id bigint, name string, seq int")


def folders_of(df):
    return {pathlib.PurePath(f).parts[-3:-1] for f in df.inputFiles()}


def state(table):
    return rows(table.read(), "id", "name", "n")


def test_only_touched_buckets_are_read_and_written(spark, table):
    batch, seen = batch_of(spark, [(3, "x", 1), (1003, "y", 1)]), []

    def change(stored, changes):
        seen.append(stored)
        return UPSERT(stored, changes)

    touched = {r[0] for r in table.bucketed(batch).select("part").distinct().collect()}
    before = dict(table.folders())
    table.write_back(batch, 1, change)
    assert folders_of(seen[0]) == {("batch=0", f"part={p}") for p in touched}
    after = dict(table.folders())
    assert {p for p in after if after[p] != before.get(p)} == touched and len(touched) < 8
    assert len(state(table)) == 201 and (3, "x", 3) in state(table) and (1003, "y", None) in state(table)


def test_sequences_of_batches_equal_upserts_in_memory(spark, table):
    rng = random.Random(2)
    want = spark.createDataFrame(state(table), STORE)
    for number in range(1, 5):
        batch = batch_of(spark, [(rng.choice([None, *range(190, 230)]), rng.choice([None, "a", "b"]), i) for i in range(12)])
        table.write_back(batch, number, UPSERT)
        table.write_back(batch, number, UPSERT)
        want = K.upsert(want, batch, ["id"], ["seq"])
        if number == 2:
            table.tidy()
    assert state(table) == rows(want)
    assert not any(r[0] is None for r in state(table))


def test_a_batch_that_stops_half_way_is_not_seen_and_can_come_again(spark, table):
    before, batch = state(table), batch_of(spark, [(5, "late", 1), (700, "new", 2)])
    table.stage(table.bucketed(UPSERT(table.read().drop("part"), batch)), 1)  # stopped before the commit
    assert state(table) == before and table.last_batch() == 0
    again = P.KeyedTable(spark, table.path, STORE, ["id"], 8)
    again.write_back(batch, 1, UPSERT)
    assert state(again) == rows(K.upsert(spark.createDataFrame(before, STORE), batch, ["id"], ["seq"]))
    again.write_back(batch_of(spark, [(5, "other", 1)]), 1, UPSERT)  # a replay may not differ, and changes nothing
    assert (5, "late", 5) in state(again)


def test_batches_must_rise(spark, table):
    table.write_back(batch_of(spark, [(1, "x", 1)]), 5, UPSERT)
    with pytest.raises(ValueError, match="comes after"):
        table.write_back(batch_of(spark, [(1, "y", 1)]), 3, UPSERT)


def test_tidying_keeps_what_is_read(spark, table):
    for number in (1, 2, 3):
        table.write_back(batch_of(spark, [(7, f"v{number}", 1)]), number, UPSERT)
    before = state(table)
    table.tidy()
    files = {p.parent for p in pathlib.Path(table.path, "data").rglob("*.parquet")}
    assert {tuple(f.parts[-2:]) for f in files} == {(f"batch={b}", f"part={p}") for p, b in table.folders()}
    assert state(table) == before
    table.write_back(batch_of(spark, [(7, "old", 1)]), 2, UPSERT)  # tidied away, but committed
    assert state(table) == before


def test_rows_may_leave_and_parts_may_empty(spark, table):
    every = batch_of(spark, [(i, None, 1) for i in range(200)])
    table.write_back(every, 1, lambda stored, batch: stored.join(batch, "id", "left_anti"))
    assert state(table) == [] and table.last_batch() == 1
    table.write_back(batch_of(spark, []), 2, UPSERT)
    assert table.last_batch() == 2
    table.write_back(batch_of(spark, [(1, "back", 1)]), 3, UPSERT)
    assert state(table) == [(1, "back", None)]


def test_a_fold_that_stops_before_deleting(spark, table):
    log, store = shared_dir(spark, "log"), state(table)
    entries = [batch_of(spark, [(1, f"a{n}", n), (300 + n, "b", n)]) for n in range(5)]
    for n, entry in enumerate(entries):
        entry.write.parquet(f"{log}/batch={n}")
    table = P.KeyedTable(spark, shared_dir(spark, "store"), STORE, ["id"], 8)
    table.load(spark.createDataFrame(store, STORE), -1)
    newest = partial(K.upsert, keys=["id"], order=["batch", "seq"])
    table.write_back(spark.read.parquet(log).where("batch <= 2"), 2, newest)  # stopped before the entries were deleted
    want = spark.createDataFrame(store, STORE)
    for entry in entries:
        want = K.upsert(want, entry, ["id"], ["seq"])
    now = lambda: rows(newest(table.read().drop("part"), P.unfolded(table, log)))
    assert now() == rows(want)
    P.fold_log(table, log, 2, newest)
    assert {p.name for p in pathlib.Path(log).iterdir()} == {"batch=3", "batch=4"}
    assert now() == rows(want)
    P.fold_log(table, log, 4, newest)
    assert state(table) == rows(want)


def test_weeks_are_committed_batch_by_batch(spark):
    table = P.PartTable(spark, shared_dir(spark, "weeks"), "id bigint, created_at timestamp_ntz, iso_year int, iso_week int")
    make = lambda data: spark.createDataFrame(data, "id bigint, d string").selectExpr("id", "cast(d as timestamp_ntz) created_at")
    P.insert_weeks(table, make([]), 0)
    P.insert_weeks(table, make([(1, "2024-01-02"), (2, "2024-01-09"), (2, "2024-01-10")]), 1)
    P.insert_weeks(table, make([(1, "2024-01-03"), (3, "2023-12-31"), (4, "2024-01-03")]), 2)
    P.insert_weeks(table, make([(9, "2024-01-03")]), 2)
    assert rows(table.read(), "id", "part") == [(1, 202401), (2, 202402), (3, 202352), (4, 202401)]
    assert folders_of(table.read([202402])) == {("batch=1", "part=202402")}


def test_an_empty_first_weekly_batch(spark):
    path = shared_dir(spark, "weekly")
    make = lambda data: spark.createDataFrame(data, "id bigint, d string").selectExpr("id", "cast(d as timestamp_ntz) created_at")
    for data in ([], [], [(1, "2024-01-02")], [(1, "2024-01-02"), (2, "2024-01-03")]):
        WR.write_weekly(make(data), path)
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,)]


# The search index by time.

WORDS = ["the", "cat", "sat", "on", "a", "mat"]


@pytest.fixture(scope="module")
def posts(spark):
    rng = random.Random(4)
    data = [
        (i, " ".join(rng.choices(WORDS, k=rng.randint(0, 4))), rng.choice([1, 2, 3, None]), rng.choice([None, *range(40)]), dt.date(2024, 1, 1 + i % 3))
        for i in range(300)
    ]
    return data, spark.createDataFrame(data, "id bigint, text string, user_id bigint, secs bigint, stored date")


def index_of(spark, df):
    table = SI.index_table(spark, shared_dir(spark, "index"))
    table.add(SI.postings(df, "id", "text", "secs", "user_id", "stored", span=10), 0)
    return table


def brute_hits(data, q, start=None, end=None, users=None):
    terms = set(q.split())
    found = [
        (i, secs, user) for i, text, user, secs, _ in data
        if secs is not None and terms & set(text.split()) and (start is None or secs >= start)
        and (end is None or secs <= end) and (not users or user in users)
    ]
    return sorted(found, key=lambda h: (-h[1], h[0]))


@pytest.mark.parametrize("case", [{}, {"start": 7}, {"end": 22}, {"start": 5, "end": 31, "users": [2]}, {"start": 90}])
def test_newest_hits_equal_brute_force(spark, posts, case):
    data, df = posts
    table = index_of(spark, df)
    want = brute_hits(data, "cat mat", **case)
    for k, offset in ((5, 0), (3, 4), (1000, 0)):
        got = [tuple(r) for r in SI.newest_hits(table, "cat mat", k, offset=offset, span=10, **case).collect()]
        assert got == want[offset : offset + k]
    assert SI.all_hits(table, "cat mat", span=10, **case).count() == len(want)


def test_a_search_opens_its_dates_and_stops_at_enough(spark, posts, monkeypatch):
    table, opened = index_of(spark, posts[1]), []
    match = SI._matching
    monkeypatch.setattr(SI, "_matching", lambda table, parts, *rest: opened.append(parts) or match(table, parts, *rest))
    SI.newest_hits(table, "the", 3, span=10)
    assert opened == [[3]]  # the newest of four blocks has enough
    opened.clear()
    SI.newest_hits(table, "the", 1000, end=25, span=10)
    assert opened == [[2], [0, 1]]
    found = match(table, [2], ["the"], 20, 25, [1])
    assert {f[1] for f in folders_of(found)} == {"part=2"}
    pushed = plan(found)
    assert "PushedFilters: [" in pushed and all(w in pushed for w in ("term", "at", "user")) and "Join" not in pushed


def test_files_are_sorted_by_term(spark, posts):
    table = index_of(spark, posts[1])
    terms = [r.term for r in table.read([1]).coalesce(1).collect()]
    assert terms == sorted(terms) and len(terms) > 20


def test_a_day_indexed_twice_counts_once(spark, posts):
    data, df = posts
    table = SI.index_table(spark, shared_dir(spark, "index"))
    found = SI.postings(df, "id", "text", "secs", "user_id", "stored", span=10)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    for batch, day in enumerate([*days, days[1], None]):
        SI.index_day(table, found, day, batch)
    assert rows(table.read().select(found.columns)) == rows(found)
    other = SI.postings(df.limit(0), "id", "text", "secs", "user_id", "stored", span=10)
    SI.index_day(table, other, days[0], 9)  # the day has no rows any more
    assert rows(table.read().select(found.columns)) == rows(found.where(F.col("inserted") != days[0]))


def test_many_blocks_lie_on_few_shelves(spark):
    """Folders do not grow with the length of time; shelves of several batches overlap and searches still find the newest."""
    rng = random.Random(8)
    data = [(i, " ".join(rng.choices(WORDS, k=3)), i % 4, rng.randrange(50_000), dt.date(2024, 1, 1 + i % 3)) for i in range(3000)]
    df = spark.createDataFrame(data, "id bigint, text string, user_id bigint, secs bigint, stored date")
    found = SI.postings(df, "id", "text", "secs", "user_id", "stored", span=10)
    assert found.select("part").distinct().count() > 1000
    table = SI.IndexTable(spark, shared_dir(spark, "index"), shelves=8)
    for batch, day in enumerate([dt.date(2024, 1, d) for d in (1, 2, 3, 2)]):
        SI.index_day(table, found, day, batch)
    assert len(table.folders()) <= 4 * 8
    assert rows(table.read().select(found.columns)) == rows(found)
    for case in ({}, {"start": 20_000, "end": 30_000, "users": [2]}, {"end": 777}):
        want = brute_hits(data, "cat mat", **case)
        for k, offset in ((5, 0), (30, 40)):
            got = [tuple(r) for r in SI.newest_hits(table, "cat mat", k, offset=offset, span=10, **case).collect()]
            assert got == want[offset : offset + k]
        assert SI.all_hits(table, "cat mat", span=10, **case).count() == len(want)
    whole = SI.index_table(spark, shared_dir(spark, "index"))
    whole.add(found, 0)
    assert len(whole.folders()) <= SI.SHELVES and rows(whole.read().select(found.columns)) == rows(found)


def test_times_as_seconds(spark):
    df = spark.sql("SELECT 1 id, 'a' text, 1 user_id, TIMESTAMP_NTZ '1970-01-02 00:00:01.9' ntz, TIMESTAMP '1970-01-02 00:00:01' ts")
    assert {SI.postings(df, "id", "text", c, "user_id").first()["at"] for c in ("ntz", "ts")} == {86401}


# Interval reports from partials, rows by id.


def test_intervals_read_their_weeks_partials_only(spark, sf):
    t = Roles(spark, sf)
    table = R.partials_table(spark, shared_dir(spark, "partials"))
    R.add_partials(table, t.posts.filter("id % 2 = 0"), 0)
    R.add_partials(table, t.posts.filter("id % 2 = 1"), 1)
    day = dt.date(2024, 1, 20)
    want = R.reports_for_intervals(t.posts.filter(F.col("created_at") < day), t.users, dt.datetime(2024, 1, 20), [2, 5])
    assert rows(R.reports_from_partials(table, t.users, day, [2, 5])) == rows(want)
    R.merge_partials(table, [202402, 202403], 2)
    report = R.reports_from_partials(table, t.users, day, [2, 5])
    assert rows(report) == rows(want)
    opened = {f[1] for f in folders_of(report) if f[1].startswith("part=")}
    assert opened and opened <= {"part=202403", "part=202402"}
    assert not any("events" in f for f in report.inputFiles())


def test_sketches_of_days_unite(spark, sf):
    t = Roles(spark, sf)
    start, end = dt.date(2024, 1, 3), dt.date(2024, 1, 24)
    sketches = R.repost_sketches(t.posts.filter("id % 2 = 0")).union(R.repost_sketches(t.posts.filter("id % 2 = 1")))
    about = {r[0]: r[1:] for r in R.about_reposters(sketches, start, end).collect()}
    inside = t.posts.filter("retweeted_status IS NOT NULL").filter((F.col("created_at") >= start) & (F.col("created_at") < end))
    exact = inside.groupBy("retweeted_status").agg(F.count("*"), F.count_distinct("user_id")).collect()
    assert {r[0]: r[1] for r in exact} == {k: v[0] for k, v in about.items()}
    assert all(abs(r[2] - about[r[0]][1]) <= 0.05 * r[2] + 0.5 for r in exact)


def test_rows_by_id_open_located_weeks_only(spark, sf):
    t, path = Roles(spark, sf), shared_dir(spark, "weekly")
    posts = t.posts.select("id", "created_at", "user_id")
    WR.replace_weeks(posts, path)
    weekly, ids = spark.read.parquet(path), spark.createDataFrame([(5,), (5,), (17,), (10**9,), (None,)], "id bigint")
    got = J.fetch_by_ids(ids, A.partition_minmax(posts), weekly)
    assert sorted(rows(got, "id")) == [(5,), (17,)]
    assert "dynamicpruning" in plan(got).lower()
