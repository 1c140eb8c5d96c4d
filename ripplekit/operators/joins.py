"""Joins.  All are equi joins; AQE chooses broadcast from measured sizes and
splits hot keys, so nothing here carries a broadcast hint."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplekit.functions.text import first_short_url, mentions, short_url_parts
from ripplekit.functions.times import minute_floor
from ripplekit.session import settle


def repost_star(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Each repost with its author, its original and the original's author."""
    author = users.select(
        F.col("id").alias("author_id"), "province", "city", "gender", "followers_count",
        F.col("created_at").alias("user_created_at"),
    )
    original = posts.select(
        F.col("id").alias("original_id"),
        F.col("created_at").alias("original_created_at"),
        F.col("user_id").alias("original_user_id"),
    )
    original_author = users.select(
        F.col("id").alias("original_author_id"),
        F.col("followers_count").alias("original_followers_count"),
    )
    rt = posts.filter("retweeted_status IS NOT NULL").select(
        "id", "created_at", "user_id", "retweeted_status"
    )
    star = rt.join(author, rt["user_id"] == author["author_id"], "left")
    star = star.join(original, star["retweeted_status"] == original["original_id"], "left")
    return star.join(
        original_author, star["original_user_id"] == original_author["original_author_id"], "left"
    )


def list_posts(userlist: DataFrame, posts: DataFrame, lists: list[int] | None = None) -> DataFrame:
    """Posts by list members, one row per (list, post)."""
    members = userlist if lists is None else userlist.filter(F.col("list_id").isin(lists))
    m = members.select(F.col("user_id").alias("member_id"), "list_id")
    return m.join(posts, m["member_id"] == posts["user_id"], "inner").drop("member_id")


def lookup(few: DataFrame, key: str, table: DataFrame, table_key: str) -> DataFrame:
    """Left join of a short list with a large table.

    An outer join cannot broadcast its preserved side, so joining directly would
    shuffle the whole table.  The table is cut to the listed keys first (a semi
    join, which may broadcast the list) and only those rows meet the list.
    """
    few = settle(few, "few")
    wanted = few.select(F.col(key).alias("_wanted"))
    rows = table.join(wanted, table[table_key] == wanted["_wanted"], "left_semi")
    return few.join(rows, few[key] == rows[table_key], "left")


def hydrate(top: DataFrame, posts: DataFrame, key: str = "retweeted_status") -> DataFrame:
    """Full post rows for a short list of ids; ids not stored keep nulls."""
    cols = [c for c in posts.columns if c not in top.columns and c != "id"]
    out = lookup(top, key, posts.select(F.col("id").alias("_id"), *cols), "_id")
    return out.withColumnRenamed("_id", "id")


def add_geo(df: DataFrame, provinces: DataFrame, main_city: int = 1) -> DataFrame:
    """Province names from the ``main_city`` row, city names from (province, city)."""
    p = provinces.filter(F.col("cityid") == main_city).select(
        F.col("provid").alias("_p"), "provname", F.col("name_en").alias("provname_full_en")
    )
    c = provinces.select(
        F.col("provid").alias("_cp"), F.col("cityid").alias("_cc"), "cityname",
        F.col("name_en").alias("cityname_en"),
    )
    out = df.join(p, df["province"] == p["_p"], "left")
    out = out.join(c, (out["province"] == c["_cp"]) & (out["city"] == c["_cc"]), "left")
    return out.drop("_p", "_cp", "_cc")


def same(left: DataFrame, right: DataFrame, columns: dict[str, str]) -> Column:
    """Columns equal pair by pair, null to null."""
    return reduce(and_, [left[a].eqNullSafe(right[b]) for a, b in columns.items()])


def carry_last(df: DataFrame, keys: list[str], order: list[str], value: str, bucket: str, name: str) -> DataFrame:
    """Last non-null ``value`` up to each row, per key, in ``order``.

    A window over a key would sort all its rows in one task, so ``bucket``, any
    non-decreasing function of the first order column, splits every key.  One
    value per (key, bucket) is aggregated on the map side, a window over those
    few rows finds what each bucket inherits, and the row-level window runs
    inside (key, bucket) only.  Null keys are keys like any other.
    """
    part = keys + [bucket]
    ends = df.groupBy(*part).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_end")
    )
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    renamed = {c: f"_part{i}" for i, c in enumerate(part)}
    inherited = ends.select(
        *[F.col(c).alias(n) for c, n in renamed.items()],
        F.last("_end", ignorenulls=True).over(before).alias("_carry"),
    ).filter("_carry IS NOT NULL")
    joined = df.join(inherited, same(df, inherited, renamed), "left").drop(*renamed.values())
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("_carry"))
    return joined.withColumn(name, filled).drop("_carry")


def mention_rows(posts: DataFrame, keep: tuple[str, ...] = (), outer: bool = False) -> DataFrame:
    """One row per ``//@name`` of each repost, with its position in the chain.

    ``keep`` names more columns to carry along; ``outer`` keeps reposts without a name.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    return posts.filter("retweeted_status IS NOT NULL").select(
        "id", "created_at", "retweeted_status", *keep, explode(mentions(F.col("text"))).alias("pos", "name")
    )


def resolve_mentions(probes: DataFrame, posts: DataFrame) -> DataFrame:
    """User id behind each mention: the latest strictly earlier repost of the
    same original by that screen name.

    Probes and reposts are unioned; a probe sorts before a repost of the same
    instant, which makes the comparison strict.
    """
    candidates = posts.filter("retweeted_status IS NOT NULL AND screen_name IS NOT NULL").select(
        "retweeted_status", F.col("screen_name").alias("name"), "created_at",
        F.lit(1).alias("kind"), "id", F.col("user_id").alias("_uid"),
    )
    asked = probes.withColumns({"kind": F.lit(0), "_uid": F.lit(None).cast("bigint")})
    rows = asked.unionByName(candidates, allowMissingColumns=True).withColumn(
        "_minute", minute_floor(F.col("created_at"))
    )
    found = carry_last(
        rows, ["retweeted_status", "name"], ["created_at", "kind", "id", "pos"], "_uid", "_minute", "ref_user_id"
    )
    return found.filter("kind = 0").select(*probes.columns, "ref_user_id")


def locate_partitions(ids: DataFrame, minmax: DataFrame, per_id: int = 2) -> DataFrame:
    """Weeks whose id range holds each id, in (year, week) order, at most ``per_id``.

    Ids are cut into cells as wide as a power of two.  A week is listed under the
    one or two cells it touches of the cells about as wide as itself, an id under
    its own cell of each width that has weeks, so ids meet weeks in an equi join
    and most pairs are hits, however unevenly ids are spread.  The map has one
    row per week; it is written once because its widths are asked for as well.
    """
    bits = F.length(F.bin(F.col("max_id") - F.col("min_id")))
    known = settle(
        minmax.filter("min_id IS NOT NULL AND max_id >= min_id").withColumn("_bits", bits), "weeks"
    )
    widths = known.agg(F.collect_set("_bits")).scalar()
    weeks = known.withColumn(
        "_cell", F.explode(F.expr("sequence(shiftright(min_id, _bits), shiftright(max_id, _bits))"))
    )
    asked = ids.select("id").distinct().withColumn("_bits", F.explode(widths))
    asked = asked.withColumn("_cell", F.expr("shiftright(id, _bits)"))
    inside = F.col("id").between(F.col("min_id"), F.col("max_id"))
    first = Window.partitionBy("id").orderBy("iso_year", "iso_week")
    return (
        asked.join(weeks, ["_bits", "_cell"])
        .filter(inside)
        .withColumn("nth", F.row_number().over(first))
        .filter(F.col("nth") <= per_id)
        .select("id", "iso_year", "iso_week", "nth")
    )


def fetch_by_ids(ids: DataFrame, minmax: DataFrame, weekly: DataFrame, per_id: int = 2) -> DataFrame:
    """Rows of a table in weekly partitions by id, each once; only weeks that may hold a wanted id are opened.

    The weeks found are at most the calendar's, so they reach the scan as a partition filter when the
    query runs, however many ids are asked for. Ids outside every week's range are not looked for.
    """
    located = settle(locate_partitions(ids, minmax, per_id), "located")
    weeks = settle(located.select("iso_year", "iso_week").distinct(), "weeks").where("iso_week >= 0")
    opened = weekly.join(weeks, ["iso_year", "iso_week"], "left_semi")
    wanted = located.select(F.col("iso_year").alias("_y"), F.col("iso_week").alias("_w"), F.col("id").alias("_id"))
    same = (F.col("iso_year") == F.col("_y")) & (F.col("iso_week") == F.col("_w")) & (opened["id"] == F.col("_id"))
    return opened.join(wanted, same, "left_semi")


def post_links(posts: DataFrame) -> DataFrame:
    """First short link of each post that has one."""
    linked = posts.filter(F.col("text").contains("http://")).select(
        "id", first_short_url(F.col("text")).alias("full")
    )
    return linked.filter("full <> ''").withColumns(short_url_parts(F.col("full")))


def resolve_urls(links: DataFrame, urlmap: DataFrame) -> DataFrame:
    """Resolved location of each link, by base and hash."""
    known = urlmap.select(F.col("base").alias("_b"), F.col("hash").alias("_h"), "location")
    return links.join(
        known, (links["base"] == known["_b"]) & (links["hash"] == known["_h"]), "left"
    ).drop("_b", "_h")


def snapshot_pair(snaps: DataFrame, before: Column, since: Column) -> DataFrame:
    """Per entity: newest snapshot up to ``before`` and newest from ``since`` on.

    One pass with partial aggregation; no self join and no window.
    """
    t = F.col("retrieved")
    old, new = F.when(t <= before, t), F.when(t >= since, t)
    # Fixed-width aggregation buffers keep this a hash aggregate.
    return snaps.groupBy("eid").agg(
        F.max(old).alias("old_retrieved"),
        F.max_by("cnt", old).alias("old_cnt"),
        F.max(new).alias("new_retrieved"),
        F.max_by("cnt", new).alias("new_cnt"),
    )


def checked_unset(snaps: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities with at least one snapshot and no decision yet."""
    unset = entities.filter("watching IS NULL")
    return unset.join(snaps, unset["id"] == snaps["eid"], "left_semi")


def missing(refs: DataFrame, ref: str, store: DataFrame, key: str = "id") -> DataFrame:
    """Distinct referenced ids that the store does not hold."""
    wanted = refs.filter(F.col(ref).isNotNull()).select(F.col(ref).alias("missing_id")).distinct()
    return wanted.join(store, wanted["missing_id"] == store[key], "left_anti")


def exclude(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    unwanted = ids.toDF("_x")
    return df.join(unwanted, df[key] == unwanted["_x"], "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose (non-null) key has no parent."""
    have = child.filter(F.col(child_key).isNotNull())
    return have.join(parent, have[child_key] == parent[parent_key], "left_anti")


def attach_users(report: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """Report rows with the author's profile; the account date is ``u_created_at``."""
    profile = users.withColumnRenamed("created_at", "u_created_at").withColumnRenamed("id", "u_id")
    clash = [c for c in profile.columns if c in report.columns]
    profile = profile.drop(*clash)
    return report.join(profile, report[key] == profile["u_id"], "left").drop("u_id")
