"""One original, user and name hold a third or more of all rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from ripplekit.operators import aggregates as A
from ripplekit.operators import joins as J
from ripplekit.plans import reports as R
from ripplekit.plans.roles import Roles
from ripplekit.session import shared_dir


@pytest.fixture(scope="module")
def hot(spark):
    """20,000 posts: half repost id 1, a third are by user 1, most mention u1."""
    posts = spark.range(1, 20_001, numPartitions=8).select(
        "id",
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("created_at"),
        F.expr("CASE WHEN id % 3 = 0 THEN 1 ELSE id % 997 END").alias("user_id"),
        F.expr("CASE WHEN id < 50 THEN NULL WHEN id % 2 = 0 THEN 1 ELSE id % 40 END").alias("retweeted_status"),
    )
    posts = posts.select(
        "*", F.concat(F.lit("u"), "user_id").alias("screen_name"),
        F.expr("concat('x//@u', CASE WHEN id % 5 = 0 THEN id % 7 ELSE 1 END, ':y http://t.cn/h', id % 3)").alias("text"),
    )
    users = spark.range(0, 997).select(
        "id", F.concat(F.lit("u"), "id").alias("screen_name"), F.expr("int(id % 20)").alias("province"),
        F.expr("int(id % 3)").alias("city"), F.expr("CASE id % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'f' END").alias("gender"),
        (F.col("id") * 10).alias("followers_count"), F.expr("timestamp_ntz '2010-01-01'").alias("created_at"),
    )
    return posts, users


@pytest.fixture
def tiny_partitions(spark):
    """Let AQE see skew at this size, and forbid broadcasts."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_join_keys_are_split_and_rows_stay_whole(spark, hot, tiny_partitions):
    posts, users = hot
    star = J.repost_star(posts, users).select("id", "original_created_at", "gender")
    assert len(star.collect()) == posts.filter("retweeted_status IS NOT NULL").count()
    assert "skew=true" in plan(star)


def test_most_reposted_counts_every_repost(spark, hot, tiny_partitions):
    posts, users = hot
    got = A.rank_reposted(posts, users, dt.datetime(2024, 1, 1), limit=1000)
    plain = posts.filter("retweeted_status IS NOT NULL").groupBy("retweeted_status").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("d")
    )
    assert rows(got, "retweeted_status", "retweeted_count", "distinct_users") == rows(plain)


def test_null_names_are_no_hot_key_and_match_nothing(spark, hot):
    """More than half of the rows have no name; each still gets its own answer."""
    posts, _ = hot
    half = posts.withColumn("screen_name", F.expr("CASE WHEN id % 5 < 2 THEN screen_name END"))
    probes = J.mention_rows(half)
    got = J.resolve_mentions(probes, half)
    assert got.count() == probes.count()
    named = half.filter("screen_name IS NOT NULL AND retweeted_status IS NOT NULL")
    assert rows(got) == rows(J.resolve_mentions(probes, named), *got.columns)
    odd = probes.withColumn("name", F.lit(None).cast("string"))
    assert J.resolve_mentions(odd, half).filter("ref_user_id IS NOT NULL").isEmpty()


def test_trace_totals_are_whole(spark, hot):
    posts, users = hot
    total = R.trace_totals(R.trace(posts, users)).agg(
        F.sum("reposts_count"), F.sum("references_count")
    ).first()
    n = posts.filter("retweeted_status IS NOT NULL").count()
    assert tuple(total) == (n, n)


def test_chunks_of_a_viral_post_are_bounded(spark, hot):
    posts, users = hot
    chunks = A.collect_reposts(posts, users, chunk=500)
    sizes = chunks.select("retweeted_status", F.size("ids").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 500
    assert sizes.agg(F.sum("n")).first()[0] == posts.filter("retweeted_status IS NOT NULL").count()


@pytest.mark.parametrize("step", range(2, 10))
def test_chunks_are_bounded_whatever_the_ids(spark, hot, step):
    posts, users = hot
    spaced = posts.withColumn("id", F.col("id") * step).withColumn("created_at", F.expr("timestamp_ntz '2024-01-01'"))
    chunks = A.collect_reposts(spaced, users, chunk=1000)
    sizes = chunks.agg(F.max(F.size("ids")).alias("most"), F.sum(F.size("ids")).alias("all")).first()
    assert sizes.most <= 1000 and sizes.all == posts.filter("retweeted_status IS NOT NULL").count()


def test_posts_that_repost_nothing_are_dealt_out(spark):
    """They do not meet in one task when originals are joined, and no id, negative or repeated, makes one up."""
    events = spark.range(-500, 3500).selectExpr(
        "id event_id", "timestamp_ntz '2024-01-01' ts", "id % 9 user_id", "CASE WHEN id % 50 = 0 THEN 'view' ELSE 'signup' END event_type",
        "1d value", "concat('{\"k\": ', abs(id % 40), '}') props")
    path = shared_dir(spark, "events")
    events.union(events.where("event_id = 7")).write.parquet(f"{path}/events.parquet")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        t = Roles(spark, path)
        found = t.status.select("id", "retweeted_status", "o_user_id", F.spark_partition_id().alias("task")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    user = {r.id: r.user_id for r in t.posts.collect()}
    assert len(found) == 4001 and sum(r.retweeted_status is not None for r in found) > 50
    assert all(r.o_user_id == (None if r.retweeted_status is None else user.get(r.retweeted_status)) for r in found)
    tasks = [r.task for r in found]
    assert max(map(tasks.count, set(tasks))) < 2500
