"""Keyed writes, watch rules and incremental loads: rules and properties."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from ripplekit.operators import joins as J
from ripplekit.operators import keyed as K
from ripplekit.operators import watch as W
from ripplekit.operators import windows as WN
from ripplekit.session import shared_dir

AS_OF = "timestamp_ntz '2024-01-31'"


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


STORE = "id bigint, name string, n int"


def test_carried_null_overwrites_absent_column_does_not(spark):
    store = frame(spark, [(1, "a", 5), (2, "b", 6)], STORE)
    batch = frame(spark, [(1, None, 1), (3, "c", 2)], "id bigint, name string, seq int")
    assert rows(K.upsert(store, batch, ["id"], ["seq"])) == [(1, None, 5), (2, "b", 6), (3, "c", None)]


def test_row_level_column_lists(spark):
    store = frame(spark, [(1, "a", 5)], STORE)
    batch = frame(
        spark,
        [(1, "x", 1, 1, ["name"]), (1, None, 9, 2, ["n"]), (2, "y", 8, 1, ["name"])],
        "id bigint, name string, n int, seq int, has array<string>",
    )
    assert rows(K.upsert(store, batch, ["id"], ["seq"], "has")) == [(1, "x", 9), (2, "y", None)]


def test_upsert_is_idempotent_and_equals_update_first(spark):
    rng = random.Random(7)
    store = frame(spark, [(i, f"s{i}", i) for i in range(40)], STORE)
    batch = frame(
        spark,
        [(rng.randrange(60), rng.choice([None, "x", "y"]), i) for i in range(200)],
        "id bigint, name string, seq int",
    )
    once = K.upsert(store, batch, ["id"], ["seq"])
    assert rows(once) == rows(K.upsert(once, batch, ["id"], ["seq"]))
    assert rows(once) == rows(K.update_or_insert(store, batch, ["id"], ["seq"]))


def test_insert_ignore_keeps_known_rows_and_first_of_batch(spark):
    store = frame(spark, [(1, "old", 1)], STORE)
    batch = frame(spark, [(1, "new", 2, 0), (2, "first", 3, 1), (2, "second", 4, 2)], STORE + ", seq int")
    got = K.insert_ignore(store, batch, ["id"], ["seq"])
    assert rows(got) == [(1, "old", 1), (2, "first", 3)]
    assert rows(K.insert_ignore(got, batch, ["id"], ["seq"])) == rows(got)
    flags = K.upsert_outcome(store, batch, ["id"], ["seq"])
    assert rows(flags, "id", "seq", "success") == [(1, 0, False), (2, 1, True), (2, 2, False)]


def test_tombstones_never_move(spark):
    store = spark.sql(
        "SELECT * FROM VALUES (1, NULL, NULL), (2, timestamp_ntz '2020-01-01', NULL) t(id, deleted, permission_denied)"
    ).selectExpr("bigint(id) id", "deleted", "boolean(permission_denied) permission_denied")
    gone = frame(spark, [(1, False), (1, True), (2, True)], "id bigint, permission_denied boolean")
    first = K.tombstone(store, gone, F.expr(AS_OF))
    later = K.tombstone(first, gone, F.expr("timestamp_ntz '2025-01-01'"))
    assert rows(later) == rows(first)
    assert [(r[0], r[1].year, r[2]) for r in rows(first)] == [(1, 2024, True), (2, 2020, None)]


WATCH_CASES = [
    # state, old, new, decision
    ("watching", 100, 121, True), ("watching", 100, 120, None), ("watching", 1000, 1019, False),
    ("watching", 1000, 1020, None), ("watching", 90, 91, None), ("watching", 5000, 5009, False),
    ("watching", 500, 1001, True), ("watching", 998, 1001, False), ("watching", 10, None, None),
    ("notwatching", 1000, 1030, False), ("notwatching", 1000, 1031, True), ("notwatching", 200, 231, True),
    ("notwatching", 200, 230, None), ("notwatching", 200, 189, False), ("notwatching", 101, 117, None),
    ("notwatching", 101, 118, True), ("notwatchingyet", 50, 99, None), ("notwatchingyet", 50, 100, True),
    ("hongkong", 100, 101, True), ("hongkong", 100, 100, None), ("hongkong", 100, 99, None),
    ("notwatching", 0, 50, "skipped"), ("notwatching", 10, None, "skipped"), ("hongkong", None, 10, "skipped"),
]


def test_every_watch_rule_at_its_boundary(spark):
    pairs = frame(
        spark, [(i, o, n) for i, (_, o, n, _) in enumerate(WATCH_CASES)], "eid bigint, old_cnt bigint, new_cnt bigint"
    )
    states = frame(spark, [(i, "page", c[0]) for i, c in enumerate(WATCH_CASES)], "id bigint, type string, state string")
    got = {r["id"]: r["decision"] for r in W.watch_decision(pairs, states).collect()}
    assert [got.get(i, "skipped") for i in range(len(WATCH_CASES))] == [c[3] for c in WATCH_CASES]


def test_growth_ratio_truncates(spark):
    pairs = frame(spark, [(1, 3, 5), (2, 0, 4), (3, 7, 0)], "eid bigint, old_cnt bigint, new_cnt bigint")
    assert rows(WN.growth(pairs), "eid", "ratio_hundredths", "diff") == [(1, 166, 2), (2, None, 4), (3, 0, -7)]


def crawl(known, n, reset):
    """What a sequential crawler keeps of one newest-first page."""
    run = 0
    for i, k in enumerate(known):
        if k:
            run += 1
            if run >= n:
                return i + 1
        elif reset:
            run = 0
    return len(known)


@pytest.mark.parametrize("reset", [True, False])
@pytest.mark.parametrize("n", [1, 3, 5])
def test_cutoff_equals_a_sequential_crawler(spark, n, reset):
    rng = random.Random(n)
    pages, expected = [], []
    for user in range(12):
        # One page far larger than the others, spread over a few minutes only.
        size = 400 if user == 0 else rng.randrange(1, 25)
        share = 0.3 if user == 0 else rng.choice([0.2, 0.6, 0.95])
        flags = [rng.random() < share for _ in range(size)]
        ids = [user * 1000 + size - i for i in range(size)]
        pages += [(i, user, f"2024-01-01 00:{i % 1000 // 60:02d}:{i % 1000 % 60:02d}", k) for i, k in zip(ids, flags)]
        expected += ids[: crawl(flags, n, reset)]
    batch = frame(spark, pages, "id bigint, user_id bigint, ts string, k boolean").withColumn(
        "created_at", F.col("ts").cast("timestamp_ntz")
    )
    got = WN.incremental_cutoff(batch, batch.filter("k").select("id"), n, reset)
    assert [r[0] for r in rows(got, "id")] == [r for r in sorted(expected, key=lambda i: repr((i,)))]


def test_asof_is_strict_and_survives_a_hot_name(spark):
    """A third of all mentions name one user; brute force gives the same answers."""
    rng = random.Random(3)
    posts = []
    for i in range(600):
        user = 1 if i % 3 == 0 else rng.randrange(2, 30)
        name = "u1" if rng.random() < 0.4 else f"u{rng.randrange(1, 40)}"
        second = rng.randrange(0, 400)
        posts.append((i, f"2024-01-01 00:{second // 60:02d}:{second % 60:02d}", user, f"u{user}", 7 + i % 2, f"x//@{name}:y//@u1 z"))
    df = frame(
        spark, posts, "id bigint, ts string, user_id bigint, screen_name string, retweeted_status bigint, text string"
    ).withColumn("created_at", F.col("ts").cast("timestamp_ntz"))
    got = {(r["id"], r["pos"]): r["ref_user_id"] for r in J.resolve_mentions(J.mention_rows(df), df).collect()}
    assert len(got) == 1200
    for i, ts, _, _, rt, body in posts:
        for pos, name in enumerate([body.split("//@")[1].split(":")[0], "u1"]):
            earlier = [(p[1], p[0], p[2]) for p in posts if p[4] == rt and p[3] == name and p[1] < ts]
            assert got[(i, pos)] == (max(earlier)[2] if earlier else None)


def test_a_small_batch_does_not_move_the_store(spark):
    store = spark.range(5000).select("id", F.col("id").cast("string").alias("name"), F.lit(1).alias("n"))
    path = shared_dir(spark, "store")
    store.write.parquet(path)
    batch = spark.createDataFrame([(7, "new", 1), (7, "newer", 2), (9000, "added", 3)], "id bigint, name string, seq int")
    got = K.upsert(spark.read.parquet(path), batch, ["id"], ["seq"])
    assert rows(got.filter("id IN (7, 8, 9000)")) == [(7, "newer", 1), (8, "8", 1), (9000, "added", None)]
    assert got.count() == 5001
    moved = [line for line in plan(got).splitlines() if "Exchange hashpartitioning" in line]
    text = plan(got)
    assert "BroadcastHashJoin" in text and "FullOuter" not in text, text
    assert all("name" not in line.split("Exchange")[1] or "_b_name" in line for line in moved)


def test_far_off_weeks_do_not_widen_the_others(spark):
    weeks = [(2000 + i // 50, i % 50 + 1, i * 100, i * 100 + 120) for i in range(200)] + [(2030, 1, 10**15, 10**15 + 5)]
    ids = spark.range(0, 20_000, 7).select("id").union(spark.createDataFrame([(10**15 + 3,)], "id bigint"))
    minmax = spark.createDataFrame(weeks, "iso_year int, iso_week int, min_id bigint, max_id bigint")
    got = {}
    for r in J.locate_partitions(ids, minmax).collect():
        got.setdefault(r.id, []).append((r.nth, r.iso_year, r.iso_week))
    for (i,) in ids.collect():
        want = sorted((y, w) for y, w, lo, hi in weeks if lo <= i <= hi)[:2]
        assert [x[1:] for x in sorted(got.get(i, []))] == want


def test_id_ranges_at_most_two_in_numeric_order(spark):
    weeks = frame(
        spark,
        [(2024, 2, 100, 200), (2024, 10, 150, 300), (2024, 11, 160, 170), (2023, 52, 0, 99), (2024, 12, None, None)],
        "iso_year int, iso_week int, min_id bigint, max_id bigint",
    )
    ids = frame(spark, [(5,), (165,), (250,), (999,), (165,)], "id bigint")
    assert rows(J.locate_partitions(ids, weeks)) == [
        (165, 2024, 10, 2), (165, 2024, 2, 1), (250, 2024, 10, 1), (5, 2023, 52, 1),
    ]
