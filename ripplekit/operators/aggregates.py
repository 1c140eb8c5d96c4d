"""Aggregations.  Hot groups are reduced per (group, user) before the group is
shuffled, so the second shuffle carries one row per distinct user at most."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.functions.text import hashtags
from ripplekit.functions.times import bucket, with_iso_week
from ripplekit.operators.filters import filter_lists, in_period, min_account_age, reposts
from ripplekit.operators.joins import hydrate, post_links
from ripplekit.session import settle

# Answer statuses and the columns that count them.
RSVP_STATUSES = {
    "attending": "attending_count",
    "declined": "declined_count",
    "not_replied": "notreplied_count",
    "unsure": "unsure_count",
}


def topk(
    df: DataFrame, k: int | None = None, by: str = "distinct_users", tie: str = "retweeted_status"
) -> DataFrame:
    """All rows in falling order, or the first ``k``."""
    ranked = df.orderBy(F.col(by).desc(), F.col(tie))
    return ranked if k is None else ranked.limit(k)


def repost_pairs(posts: DataFrame, counts: dict[str, Column] | None = None) -> DataFrame:
    """Reposts reduced to one row per (original, reposter)."""
    counts = counts or {"n": F.count("*")}
    return reposts(posts).groupBy("retweeted_status", "user_id").agg(
        *[c.alias(name) for name, c in counts.items()]
    )


def rank_reposted(
    posts: DataFrame,
    users: DataFrame,
    start: dt.datetime,
    end: dt.datetime | None = None,
    province: int | None = None,
    userlist: DataFrame | None = None,
    lists: list[int] | None = None,
    max_followers: int | None = None,
    min_account_cutoff: dt.datetime | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Most reposted originals of a period, by distinct reposters; all, or the first ``limit``.

    List mode and province / audience mode are alternatives.  Reposts shrink to
    (original, user) pairs before users are joined, and originals meet the
    groups, not the reposts, so a viral id is never a hot join key.
    """
    pairs = repost_pairs(in_period(posts, "created_at", start, end))
    author = users.select(
        F.col("id").alias("author_id"), "province", "gender", F.col("created_at").alias("user_created_at")
    )
    if lists is not None:
        author = filter_lists(author, userlist, lists, user="author_id")
    elif province is not None:
        author = author.filter(F.col("province") == province)
    how = "left" if lists is None and province is None else "inner"
    grouped = (
        pairs.join(author, pairs["user_id"] == author["author_id"], how)
        .groupBy("retweeted_status")
        .agg(
            F.sum("n").alias("retweeted_count"),
            F.count("author_id").alias("distinct_users"),
            F.min("user_created_at").alias("min_user_created_at"),
            *gender_counts(),
        )
    )
    if min_account_cutoff is not None:
        grouped = min_account_age(grouped, min_account_cutoff)
    if lists is None and max_followers is not None:
        # Only the ranked originals meet the users, not all posts.
        original = posts.select(F.col("id").alias("_o"), F.col("user_id").alias("_w"))
        small = users.filter(F.col("followers_count") < max_followers).select(F.col("id").alias("_u"))
        written = grouped.join(original, grouped["retweeted_status"] == original["_o"])
        grouped = written.join(small, written["_w"] == small["_u"], "left_semi").select(grouped.columns)
    return topk(grouped, limit)


def most_reposted(posts: DataFrame, users: DataFrame, *args: object, **filters: object) -> DataFrame:
    """``rank_reposted`` with id, date and author of each original we hold."""
    original = posts.select("id", "created_at", F.col("user_id").alias("original_user_id"))
    return hydrate(rank_reposted(posts, users, *args, **filters), original)


def most_retweeted(
    userlist: DataFrame,
    tweets: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    lists: list[int] | None = None,
    k: int | None = None,
) -> DataFrame:
    """Originals most retweeted by list members, with the full original row."""
    members = userlist if lists is None else userlist.filter(F.col("list_id").isin(lists))
    who = members.select(F.col("user_id").alias("_m"))
    rts = reposts(in_period(tweets, "created_at", start, end, closed=False))
    counted = (
        rts.join(who, rts["user_id"] == who["_m"], "left_semi")
        .groupBy("retweeted_status")
        .agg(F.count_distinct("id").alias("retweeted_statuses_count"))
    )
    top = topk(counted, k, "retweeted_statuses_count").withColumnRenamed("retweeted_status", "rts")
    return hydrate(top, tweets, "rts")


def rank_by_declared(report: DataFrame) -> DataFrame:
    """Order by our count, then by the network's own ("100+") count."""
    declared = F.replace("retweet_count", F.lit("+"), F.lit("")).try_cast("int")
    return report.withColumn("declared_count", declared).orderBy(
        F.desc("retweeted_statuses_count"), F.desc_nulls_last("declared_count"), "rts"
    )


def collect_reposts(
    posts: DataFrame, users: DataFrame, originals: DataFrame | None = None, chunk: int = 10_000
) -> DataFrame:
    """Aligned arrays of the reposts of each original, in bounded chunks.

    Structs are collected, so positions stay aligned and nulls survive.  A viral
    original could hold a third of all reposts; its rows are split by day, and a
    day again by a hash of the id, into so many parts that one is expected to be
    half full.  So no array grows with the data, whatever the ids.  Chunks sort
    by (day, part).
    """
    rts = reposts(posts).select("retweeted_status", "id", "created_at", "user_id")
    if originals is not None:
        wanted = originals.select(F.col(originals.columns[0]).alias("_o"))
        rts = rts.join(wanted, rts["retweeted_status"] == wanted["_o"], "left_semi")
    rts = rts.withColumn("day", F.to_date("created_at"))
    sizes = rts.groupBy("retweeted_status", "day").agg(F.count("*").alias("_n"))
    parts = sizes.select(
        "retweeted_status", "day", (F.floor(F.col("_n") * 2 / chunk) + 1).alias("_parts")
    )
    who = users.select(F.col("id").alias("_u"), "gender", "followers_count")
    rows = (
        rts.join(parts, ["retweeted_status", "day"])
        .withColumn("part", F.pmod(id_hash(F.col("id")), "_parts"))
        .join(who, rts["user_id"] == who["_u"], "left")
    )
    item = F.struct("created_at", "id", "user_id", "gender", "followers_count")
    listed = rows.groupBy("retweeted_status", "day", "part").agg(
        F.sort_array(F.collect_list(item)).alias("r")
    )
    return listed.select(
        "retweeted_status", "day", "part",
        F.col("r.id").alias("ids"),
        F.col("r.user_id").alias("user_ids"),
        F.col("r.created_at").alias("creation_dates"),
        F.col("r.gender").alias("genders"),
        F.col("r.followers_count").alias("followers_counts"),
    )


def id_hash(c: Column) -> Column:
    """An even number from an id, the same in any engine: the first seven hex digits of its MD5."""
    return F.conv(F.substring(F.md5(c.cast("string").cast("binary")), 1, 7), 16, 10).cast("bigint")


def with_reposters(ranked: DataFrame, posts: DataFrame, users: DataFrame, chunk: int = 10_000) -> DataFrame:
    """Ranked originals with their reposter lists, a row for each bounded chunk."""
    ranked = settle(ranked, "ranked")
    chunks = collect_reposts(posts, users, ranked.select("retweeted_status"), chunk)
    return ranked.join(chunks, "retweeted_status")


def gender_counts() -> list[Column]:
    """Gender aggregates over (original, reposter) pairs with ``n`` reposts each."""
    n, g = F.col("n"), F.col("gender")
    return [
        F.sum(F.when(g == "m", n).otherwise(0)).alias("male_count"),
        F.sum(F.when(g == "f", n).otherwise(0)).alias("female_count"),
        F.count("user_id").alias("distinct_users_count"),
        F.count_if(g == "m").alias("distinct_male_count"),
        F.count_if(g == "f").alias("distinct_female_count"),
    ]


def _gender_profile(posts: DataFrame, users: DataFrame) -> DataFrame:
    pairs = repost_pairs(posts)
    who = users.select(F.col("id").alias("_u"), "gender")
    known = pairs.join(who, pairs["user_id"] == who["_u"], "left")
    return known.groupBy("retweeted_status").agg(*gender_counts())


def gender_split(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Reposts by men and by women, per original."""
    return _gender_profile(posts, users).select("retweeted_status", "male_count", "female_count")


def distinct_gender_split(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct reposters by gender, per original."""
    return _gender_profile(posts, users).drop("male_count", "female_count")


def trend(posts: DataFrame, interval: str = "h", tid: int | None = None) -> DataFrame:
    """Reposts and distinct reposters per time bucket, of one or every original."""
    rts = reposts(posts)
    if tid is not None:
        rts = rts.filter(F.col("retweeted_status") == tid)
    per_user = rts.groupBy(
        "retweeted_status", bucket(F.col("created_at"), interval).alias("time"), "user_id"
    ).agg(F.count("*").alias("n"))
    return per_user.groupBy("retweeted_status", "time").agg(
        F.sum("n").alias("count"), F.count("user_id").alias("users")
    )


def top_links(
    posts: DataFrame, userlist: DataFrame, since: dt.datetime, list_id: int = 1, k: int | None = None
) -> DataFrame:
    """Short links of originals by distinct reposters on a list."""
    rts = filter_lists(in_period(reposts(posts), "created_at", since), userlist, [list_id])
    pairs = rts.groupBy("retweeted_status", "user_id").agg(F.count_distinct("id").alias("n"))
    shared = pairs.select(F.col("retweeted_status").alias("_s")).distinct()
    originals = posts.select("id", "text").join(shared, posts["id"] == shared["_s"], "left_semi")
    link = post_links(originals).withColumnRenamed("id", "_o")
    per_user = (
        pairs.join(link, pairs["retweeted_status"] == link["_o"])
        .groupBy("full", "base", "hash", "user_id")
        .agg(F.sum("n").alias("n"), F.min("retweeted_status").alias("first_rt"))
    )
    links = per_user.groupBy("full", "base", "hash").agg(
        F.sum("n").alias("distinct_posts"),
        F.count("user_id").alias("distinct_users"),
        F.min("first_rt").alias("rt_status_id"),
    )
    return topk(links, k, "distinct_users", "full")


def top_hashtags(
    posts: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    userlist: DataFrame | None = None,
    lists: list[int] | None = None,
    k: int | None = None,
) -> DataFrame:
    chosen = in_period(posts, "created_at", start, end, closed=False)
    if lists is not None:
        chosen = filter_lists(chosen, userlist, lists)
    tags = chosen.select(F.explode(hashtags(F.col("text"))).alias("hashtag"))
    return topk(tags.groupBy("hashtag").agg(F.count("*").alias("n")), k, "n", "hashtag")


def rsvp_counts(rsvp: DataFrame) -> DataFrame:
    """Answers per event in four columns, absent statuses as 0."""
    wide = rsvp.groupBy("eid").pivot("rsvp_status", list(RSVP_STATUSES)).count().na.fill(0)
    return wide.withColumnsRenamed(RSVP_STATUSES)


def member_counts(groups: DataFrame, bridge: DataFrame, as_of: Column) -> DataFrame:
    """Members of every group, 0 for an empty one; counted before the join."""
    counted = bridge.groupBy(F.col("gid").alias("_g")).agg(F.count("uid").alias("_n"))
    return groups.join(counted, groups["id"] == counted["_g"], "left").select(
        F.col("id").alias("gid"), F.coalesce("_n", F.lit(0)).alias("members_count"),
        as_of.alias("retrieved"),
    )


def _counted(posts: DataFrame, counts: DataFrame, stored: str, name: str) -> DataFrame:
    return posts.join(counts, posts["id"] == counts["_k"], "left").select(
        "id", F.coalesce(F.col(stored), F.col("_n"), F.lit(0)).cast("bigint").alias(name)
    )


def repost_counts(posts: DataFrame, stored: str = "reposts_count") -> DataFrame:
    """The stored counter of each post, else a recount of its reposts."""
    recount = reposts(posts).groupBy(F.col("retweeted_status").alias("_k")).agg(F.count("*").alias("_n"))
    return _counted(posts, recount, stored, "reposts")


def comment_counts(posts: DataFrame, comments: DataFrame, stored: str = "comments_count") -> DataFrame:
    recount = comments.groupBy(F.col("status_id").alias("_k")).agg(F.count("*").alias("_n"))
    return _counted(posts, recount, stored, "comments")


def engagement_counts(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Repost and comment totals keyed by post id."""
    r = reposts(posts).select(F.col("retweeted_status").alias("id"), F.lit("reposts").alias("metric"))
    c = comments.select(F.col("status_id").alias("id"), F.lit("comments").alias("metric"))
    return r.unionByName(c).groupBy("id").agg(
        F.count_if(F.col("metric") == "reposts").alias("reposts"),
        F.count_if(F.col("metric") == "comments").alias("comments"),
    )


def count_since(df: DataFrame, ts: dt.datetime) -> DataFrame:
    return in_period(df, "created_at", ts).agg(F.count("*").alias("n"))


def degree(edges: DataFrame, key: str = "source_id") -> DataFrame:
    return edges.groupBy(key).agg(F.count("*").alias("degree"))


def partition_minmax(posts: DataFrame) -> DataFrame:
    """Id range of each ISO week."""
    return with_iso_week(posts).groupBy("iso_year", "iso_week").agg(
        F.min("id").alias("min_id"), F.max("id").alias("max_id")
    )


def post_counters(posts: DataFrame, comments: DataFrame, likes: DataFrame) -> DataFrame:
    """Post ids with freshly counted comments and likes, stored value when none."""
    c = comments.groupBy(F.col("pid").alias("_cp")).agg(F.count("*").alias("_c"))
    k = likes.groupBy(F.col("pid").alias("_lp")).agg(F.count("*").alias("_l"))
    out = posts.join(c, posts["id"] == c["_cp"], "left").join(k, posts["id"] == k["_lp"], "left")
    return out.select(
        "id",
        F.coalesce("_c", "comments_count").alias("comments_count"),
        F.coalesce("_l", "likes").alias("likes"),
    )


def load_summary(batch: DataFrame, store: DataFrame, key: str = "id") -> DataFrame:
    """Records of a batch: all, deleted, already stored, newly added.

    Deleted records are not stored; a repeat inside the batch already exists.
    """
    ids = batch.groupBy(key).agg(
        F.count("*").alias("_n"), F.count_if("deleted").alias("_d"), F.count_if(~F.col("deleted")).alias("_live")
    )
    have = store.select(F.col(key).alias("_k")).distinct()
    marked = ids.join(have, ids[key] == have["_k"], "left")
    new = F.when(F.col("_k").isNull() & (F.col("_live") > 0), 1).otherwise(0)
    return marked.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("count"),
        F.coalesce(F.sum("_d"), F.lit(0)).alias("deleted_count"),
        F.coalesce(F.sum(F.col("_live") - new), F.lit(0)).alias("already_exists_count"),
        F.coalesce(F.sum(new), F.lit(0)).alias("newly_added"),
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()
