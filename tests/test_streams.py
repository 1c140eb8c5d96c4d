"""Streams give the batch result, over several micro-batches and after a replay."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import rows
from ripplekit.operators import joins as J
from ripplekit.operators import watch as W
from ripplekit.operators import windows as W2
from ripplekit.plans.catalog import streams as streams_catalog
from ripplekit.plans.roles import Roles
from ripplekit.session import shared_dir
from ripplekit.sources.parts import KeyedTable, unfolded
from ripplekit.streaming import streams as ST


@pytest.fixture(scope="module")
def posts(spark, sf):
    """Reposts as files in time order, one micro-batch each."""
    t = Roles(spark, sf)
    path = shared_dir(spark, "posts-in")
    df = t.posts.select("id", F.col("created_at").cast("timestamp").alias("created_at"), "user_id", "retweeted_status")
    for part in range(4):
        df.filter(F.floor(F.dayofmonth("created_at") / 8) == part).coalesce(1).write.mode("append").parquet(path)
    return df, path


def stream(spark, posts):
    df, path = posts
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_ingest_ignores_repeats(spark, posts):
    out, state = shared_dir(spark, "out"), shared_dir(spark, "state")
    src = stream(spark, posts)
    ST.run_available(ST.stream_ingest(src.union(src), "40 days"), out, state)
    assert rows(spark.read.parquet(out), "id") == rows(posts[0], "id")


def test_trend_over_batches_equals_batch_counts(spark, posts):
    log, state = shared_dir(spark, "log"), shared_dir(spark, "state")
    ST.run_to_log(ST.stream_trend(stream(spark, posts), "1 day", "40 days"), log, state, "update")
    assert ST.read_log(spark, log).select("batch").distinct().count() > 2
    got = ST.latest_of(ST.read_log(spark, log), ["window_start", "retweeted_status"])
    want = posts[0].filter("retweeted_status IS NOT NULL").groupBy(
        F.date_trunc("day", "created_at").alias("window_start"), "retweeted_status"
    ).agg(F.count("*").alias("count"))
    assert rows(got, "window_start", "retweeted_status", "count") == rows(want)


def test_replayed_batch_changes_nothing(spark, posts):
    log = shared_dir(spark, "log")
    change = posts[0].limit(5)
    ST.write_batch(change, log, 0)
    before = rows(ST.read_log(spark, log))
    ST.write_batch(change, log, 0)
    assert rows(ST.read_log(spark, log)) == before


def test_upsert_last_batch_wins(spark):
    schema = "id bigint, name string, seq int"
    src, log, state = (shared_dir(spark, p) for p in ("in", "log", "state"))
    for batch in ([(1, "a", 5), (2, "b", 1)], [(1, "c", 1)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        ST.stream_upsert(spark.readStream.schema(schema).parquet(src), log, state)
    store = spark.createDataFrame([(1, "old"), (3, "keep")], "id bigint, name string")
    got = ST.current_rows(store, ST.read_log(spark, log), ["id"], ["seq"])
    assert rows(got) == [(1, "c"), (2, "b"), (3, "keep")]


def test_watch_stream_equals_batch(spark, sf):
    t = Roles(spark, sf)
    src, snaps, decided, state = (shared_dir(spark, p) for p in ("in", "snaps", "decided", "state"))
    schema = "eid bigint, retrieved date, cnt bigint"
    before, since = F.lit("2024-01-20").cast("date"), F.lit("2024-01-28").cast("date")
    for part in ("retrieved <= '2024-01-20'", "retrieved > '2024-01-20'"):
        t.snapshots.filter(part).coalesce(1).write.mode("append").parquet(src)
        ST.stream_watch(spark.readStream.schema(schema).parquet(src), t.entities, before, since, snaps, decided, state)
    want = W.apply_watch(t.entities, W.watch_decision(J.snapshot_pair(t.snapshots, before, since), t.entities))
    got = ST.current_watch(t.entities, ST.read_log(spark, decided))
    assert rows(got, "id", "watching") == rows(want, "id", "watching")


def test_first_deletion_stays(spark):
    log = shared_dir(spark, "log")
    make = lambda data: spark.createDataFrame(data, "id bigint, d string, permission_denied boolean").selectExpr(
        "id", "cast(d as timestamp_ntz) deleted_at", "permission_denied")
    ST.write_batch(make([(1, "2024-01-02", True), (2, "2024-01-03", False)]), log, 0)
    ST.write_batch(make([(1, "2024-01-05", False), (3, "2024-01-05", True)]), log, 1)
    store = make([(1, None, None), (2, "2020-01-01", None), (3, None, None), (4, None, None)]).withColumnRenamed("deleted_at", "deleted")
    got = ST.current_tombstones(store, ST.read_log(spark, log))
    assert [(r[0], str(r[1])[:10], r[2]) for r in rows(got)] == [
        (1, "2024-01-02", True), (2, "2020-01-01", None), (3, "2024-01-05", True), (4, "None", None),
    ]


def test_stream_without_data_leaves_an_empty_log(spark):
    src, log, state = (shared_dir(spark, p) for p in ("in", "log", "state"))
    schema = "id bigint, name string, seq int"
    spark.createDataFrame([], schema).write.parquet(src)
    ST.stream_upsert(spark.readStream.schema(schema).parquet(src), log, state)
    store = spark.createDataFrame([(3, "keep")], "id bigint, name string")
    assert rows(ST.current_rows(store, ST.read_log(spark, log), ["id"], ["seq"])) == [(3, "keep")]


def in_turn(spark, frames):
    """A stream that brings each frame as a micro-batch of its own."""
    path = shared_dir(spark, "turns")
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


REPOSTS = "id bigint, d string, retweeted_status bigint"


def reposts_at(spark, data):
    return spark.createDataFrame(data, REPOSTS).selectExpr("id", "cast(d as timestamp) created_at", "retweeted_status")


def test_windows_ranked_in_the_stream_with_late_rows(spark):
    """Late rows within the watermark change past windows; later ones are left out; a replayed micro-batch changes nothing."""
    hour = "2024-01-01 {:02d}:30:00".format
    frames = [
        [(1, hour(3), 1), (2, hour(3), 2), (3, hour(3), 2), (4, hour(4), None)],
        [(5, hour(6), 1), (6, hour(6), 3)],
        [(7, hour(4), 1), (8, hour(5), 1), (9, hour(3), 1)],  # late, within four hours
        [(10, hour(20), 5)],
        [(11, hour(3), 9), (12, hour(19), 5)],  # the first is too late
    ]
    table, state = ST.ranked_table(spark, shared_dir(spark, "ranked")), shared_dir(spark, "state")
    src = in_turn(spark, [reposts_at(spark, f) for f in frames])
    ST.stream_ranked(src, table, "2 hours", "1 hour", 2, state, late="4 hours")
    kept = reposts_at(spark, [r for f in frames for r in f if r[0] != 11 and r[2]])
    counts = kept.groupBy(F.window("created_at", "2 hours", "1 hour").start.alias("window_start"), "retweeted_status").count()
    want = rows(ST.top_per_window(counts, 2), "window_start", "retweeted_status", "count", "rank")
    got = lambda: rows(table.read(), "window_start", "retweeted_status", "count", "rank")
    assert got() == want and any(r[3] == 2 for r in want)
    assert table.last_batch() >= 4
    again = ST.ranked_table(spark, table.path)
    ST.stream_ranked(src, again, "2 hours", "1 hour", 2, shared_dir(spark, "state"), late="4 hours")  # from the start: all committed
    assert got() == want


@pytest.mark.parametrize("files", [1, 3, 7])
def test_pages_stop_where_the_batch_stops(spark, files):
    data = [(i, f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00:00", None if i % 5 == 0 else i % 3) for i in range(120)]
    pages = spark.createDataFrame(data, REPOSTS).selectExpr("id", "cast(d as timestamp) created_at", "retweeted_status as user_id")
    known = spark.createDataFrame([(i,) for i in range(120) if i % 7 and i < 100], "id bigint")
    size = -(-120 // files)
    src = in_turn(spark, [pages.filter(f"119 - id >= {n * size} AND 119 - id < {(n + 1) * size}") for n in range(files)])
    log, state = shared_dir(spark, "log"), shared_dir(spark, "state")
    ST.run_to_log(ST.stream_until_known(src, known, 3), log, state)
    want = W2.incremental_cutoff(pages, known, 3, reset=True)
    assert rows(ST.read_log(spark, log), "id", "user_id", "known") == rows(want, "id", "user_id", "known")
    assert 0 < want.count() < 120


def test_newest_first_equals_a_full_sort():
    times = lambda *hours: pd.to_datetime([h and f"2024-01-01 {h:02d}:00:00" for h in hours])
    for hours, ids in (((3, 5, 4), (1, 2, 3)), ((5, 5, 4), (1, 2, 3)), ((4, None, 5), (1, 2, 3)), ((None,), (1,)), ((7,), (1,)), ((5, 5), (2, 2))):
        frame = pd.DataFrame({"at": times(*hours), "id": ids, "n": range(len(ids))})
        want = frame.sort_values(["at", "id"], ascending=False)
        for frames in ([frame], [frame.iloc[:1], frame.iloc[1:]]):
            assert ST.newest_first(frames, "at", "id").equals(want)


def test_files_of_a_stream_are_cut_from_one_written_table(spark, sf, monkeypatch):
    """What the rows are made from is read once, by all tasks, and not again by the one task of each file."""
    t = Roles(spark, sf)
    made = t.posts.select("id", "user_id").withColumn("turn", F.col("id") % 100)
    kept, settle = [], streams_catalog.settle
    monkeypatch.setattr(streams_catalog, "settle", lambda df, purpose: kept.append(settle(df, purpose)) or kept[-1])
    files = streams_catalog.in_files(t, made, "turn", 5)
    assert len(kept) == 1 and rows(kept[0]) == rows(made) and files.isStreaming


def test_a_folded_log_stays_short(spark):
    schema = "id bigint, name string, seq int"
    frames = [spark.createDataFrame([(n % 3, f"v{n}", n), (10 + n, "x", n)], schema) for n in range(7)]
    store = spark.createDataFrame([(0, "old"), (1, "old")], "id bigint, name string")
    table = KeyedTable(spark, shared_dir(spark, "users"), store.schema, ["id"], 4)
    table.load(store, -1)
    log, state = shared_dir(spark, "log"), shared_dir(spark, "state")
    ST.run_folded(in_turn(spark, frames), log, state, table, ST.last_change(["id"], ["seq"]), every=3)
    assert rows(ST.read_log(spark, log).select("batch").distinct()) == [(6,)]
    want = [(0, "v6"), (1, "v4"), (2, "v5"), *((10 + n, "x") for n in range(7))]
    assert rows(ST.current_rows(table.read().drop("part"), unfolded(table, log), ["id"], ["seq"])) == sorted(want, key=repr)


def test_a_stream_with_a_trigger_goes_on(spark):
    src, out, state = (shared_dir(spark, p) for p in ("in", "out", "state"))
    frame = reposts_at(spark, [(1, "2024-01-01 00:00:00", 1)])
    frame.write.parquet(src)
    query = ST.run_available(spark.readStream.schema(frame.schema).parquet(src), out, state, {"processingTime": "100 milliseconds"})
    try:
        assert query.isActive
        query.processAllAvailable()
        reposts_at(spark, [(2, "2024-01-01 00:00:00", 1)]).write.mode("append").parquet(src)
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,)]
