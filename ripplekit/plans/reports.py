"""Composed analyses: repost trace, gap-filled trend and the most-reposted report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ripplekit.functions.text import last_components
from ripplekit.functions.times import bucket, bucket_grid, day_grid, epoch
from ripplekit.operators.aggregates import rank_reposted, repost_pairs, top_links, trend, with_reposters
from ripplekit.operators.filters import drop_spam, filter_lists, flag_spam, in_period, reposts
from ripplekit.operators.joins import add_geo, hydrate, lookup, mention_rows, resolve_mentions, resolve_urls
from ripplekit.sources.parts import PartTable

REPORT_ZONE = "Asia/Hong_Kong"


def cascade(posts: DataFrame, tid: int) -> DataFrame:
    """Reposts of one post in id order."""
    return posts.filter(F.col("retweeted_status") == tid).orderBy("id")


def trace(posts: DataFrame, users: DataFrame, tid: int | None = None) -> DataFrame:
    """Each repost with its ordered references and the names nobody could place.

    A reference resolves to the latest earlier repost by that name, else to the
    user table.  Lists are per repost, hence bounded by one post's text.  The
    repost's own columns travel with its names, so nothing is joined back.
    """
    rts = reposts(posts)
    if tid is not None:
        rts = rts.filter(F.col("retweeted_status") == tid)
    resolved = resolve_mentions(mention_rows(rts, ("user_id", "screen_name"), outer=True), rts)
    names = users.groupBy(F.col("screen_name").alias("_name")).agg(F.min("id").alias("_uid"))
    placed = resolved.join(names, resolved["name"] == names["_name"], "left").withColumn(
        "ref_id", F.coalesce("ref_user_id", "_uid")
    )
    ref = F.when(F.col("pos").isNotNull(), F.struct("pos", "name", F.col("ref_id").alias("id")))
    out = placed.groupBy("retweeted_status", "id", "created_at", "user_id", "screen_name").agg(
        F.array_sort(F.collect_list(ref)).alias("references")
    )
    unknown = F.filter("references", lambda r: r["id"].isNull())
    return out.withColumn("missing_users", F.transform(unknown, lambda r: r["name"]))


# Profile columns a trace document shows, by the names it gives them.
TRACE_PROFILE = {
    "screen_name": "user_screen_name", "province": "user_province", "city": "user_city", "gender": "user_gender",
    "followers_count": "user_followers_count", "friends_count": "user_friends_count",
}


def trace_document(
    posts: DataFrame, users: DataFrame, tid: int | None = None, extra: bool = True
) -> DataFrame:
    """The trace with each repost's text, ``user_id_ref`` (null: its user is not stored) and, with ``extra``, profile columns."""
    shown = {c: n for c, n in TRACE_PROFILE.items() if extra and c in users.columns}
    profile = users.select(F.col("id").alias("user_id_ref"), *[F.col(c).alias(n) for c, n in shown.items()])
    text = reposts(posts).select(F.col("id").alias("_t"), "text")
    traced = trace(posts, users, tid)
    traced = traced.join(text, traced["id"] == text["_t"]).drop("_t")
    return traced.join(profile, traced["user_id"] == profile["user_id_ref"], "left")


def unknown_reposters(traced: DataFrame) -> DataFrame:
    """Users of a trace document who are not stored yet."""
    return traced.filter("user_id_ref IS NULL").select("user_id").distinct()


def trace_totals(traced: DataFrame) -> DataFrame:
    return traced.groupBy("retweeted_status").agg(
        F.count("*").alias("reposts_count"),
        F.sum(F.size("references")).alias("references_count"),
        F.sum(F.size("missing_users")).alias("missing_users_count"),
    )


def trend_series(
    posts: DataFrame,
    users: DataFrame,
    interval: str = "h",
    tid: int | None = None,
    since: dt.datetime | None = None,
    province: int | None = None,
    userlist: DataFrame | None = None,
    list_id: int | None = None,
) -> DataFrame:
    """Trend with every empty bucket between first and last filled with zeros.

    Starts at ``since`` when given, else at the first repost.  The filler rows
    are bounded by period over interval, for each original; they come day by day, so no array is longer than a day.
    """
    rts = reposts(posts)
    if since is not None:
        rts = in_period(rts, "created_at", since)
    if province is not None:
        there = users.filter(F.col("province") == province).select(F.col("id").alias("_u"))
        rts = rts.join(there, rts["user_id"] == there["_u"], "left_semi")
    if list_id is not None:
        rts = filter_lists(rts, userlist, [list_id])
    counted = trend(rts, interval, tid)
    first = F.min("time") if since is None else bucket(F.lit(since).cast("timestamp_ntz"), interval)
    span = counted.groupBy("retweeted_status").agg(
        first.alias("_first"), F.max("time").alias("_last")
    )
    days = span.select("*", F.explode(day_grid(F.col("_first"), F.col("_last"))).alias("_day"))
    grid = bucket_grid(F.col("_first"), F.col("_last"), interval, F.col("_day"))
    zeros = days.select(
        "retweeted_status", F.explode(grid).alias("time"),
        F.lit(0).cast("bigint").alias("count"), F.lit(0).cast("bigint").alias("users"),
    )
    # Added up, not joined: a counted bucket is kept whether or not the grid has it.
    return counted.unionByName(zeros).groupBy("retweeted_status", "time").agg(
        F.sum("count").alias("count"), F.sum("users").alias("users")
    )


# Columns of a report row besides ids, counts and dates.
REPORT_PROFILE = ["followers_count", "friends_count", "statuses_count", "profile_image_url", "province", "city", "verified"]
REPORT_POST = [
    "thumbnail_pic", "bmiddle_pic", "original_pic", "text", "reposts_count", "comments_count", "mlevel",
]


def _present(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def report_for(top: DataFrame, posts: DataFrame, users: DataFrame, provinces: DataFrame) -> DataFrame:
    """Full report rows of a list of originals.

    ``top`` is the result of ``rank_reposted`` (or ``reports_for_intervals``),
    whose groups already carry the counts; only the listed originals and their
    authors are looked up.  Profile and post columns a table lacks are left out.
    """
    counted = top.drop("distinct_users", "min_user_created_at").withColumnRenamed("retweeted_count", "count")
    media, profile = _present(posts, REPORT_POST), _present(users, REPORT_PROFILE)
    found = hydrate(counted, posts.select("id", "created_at", "user_id", *media)).filter("id IS NOT NULL")
    author = users.select(
        F.col("id").alias("_a"), F.col("screen_name").alias("user_name"), *profile,
        F.col("created_at").alias("user_created_at"),
    )
    full = add_geo(lookup(found, "user_id", author, "_a"), provinces)
    rest = [c for c in counted.columns if c not in ("retweeted_status", "count")]
    return full.select(
        "id", "user_id", "user_name", *profile, *media, "count",
        epoch(F.col("created_at"), REPORT_ZONE, "ms").alias("created_at_ms"),
        epoch(F.col("user_created_at"), REPORT_ZONE, "ms").alias("user_created_at_ms"),
        "provname", "cityname", "cityname_en",
        F.when(F.col("provname").isNotNull(), last_components(F.col("provname_full_en"), 2)).alias("provname_en"),
        *rest,
    )


def most_reposted_report(
    posts: DataFrame,
    users: DataFrame,
    provinces: DataFrame,
    start: dt.datetime,
    end: dt.datetime | None = None,
    limit: int | None = None,
    **filters: object,
) -> DataFrame:
    """Originals of a period, all or the first ``limit``, with profile, place, gender counts and dates.

    ``filters`` are those of ``rank_reposted`` (province, lists, audience, age).
    """
    top = rank_reposted(posts, users, start, end, limit=limit, **filters)
    return report_for(top, posts, users, provinces)


def report_lists(report: DataFrame, posts: DataFrame, users: DataFrame, chunk: int = 10_000) -> DataFrame:
    """The users and times of each report row's reposts, in aligned arrays of bounded size."""
    listed = report.select(F.col("id").alias("retweeted_status"), "count")
    return with_reposters(listed, posts, users, chunk).select(
        F.col("retweeted_status").alias("id"), "count", "day", "part",
        F.col("user_ids").alias("users"), F.col("creation_dates").alias("times"), "genders",
    )


def link_report(
    posts: DataFrame,
    userlist: DataFrame,
    urlmap: DataFrame,
    spam_posts: DataFrame,
    spam_sites: DataFrame,
    since: dt.datetime,
    list_id: int = 1,
    k: int | None = None,
) -> DataFrame:
    """Top links of a list, resolved, without those first seen in spam posts, and marked if their site is spam."""
    top = top_links(posts, userlist, since, list_id, k)
    kept = drop_spam(resolve_urls(top, urlmap), spam_posts, "rt_status_id")
    return flag_spam(kept, spam_sites, "location")


def order_report(report: DataFrame, mode: str = "json") -> DataFrame:
    """JSON reports sort by count, CSV reports by user id; both descending."""
    return report.orderBy(F.desc("count" if mode == "json" else "user_id"), "id")


def reports_for_intervals(
    posts: DataFrame,
    users: DataFrame,
    as_of: dt.datetime,
    days: list[int],
    limit: int | None = None,
    province: int | None = None,
    userlist: DataFrame | None = None,
    lists: list[int] | None = None,
) -> DataFrame:
    """Most reposted for several look-back periods from one scan; all of each, or the first ``limit``.

    Every (original, reposter) pair gets one count per interval, so rows are
    not repeated per interval before the big shuffle.  The filters on reposters
    are those of ``rank_reposted``; ``report_for`` makes full rows of the result.
    """
    starts = {d: as_of - dt.timedelta(days=d) for d in days}
    counts: dict[str, Column] = {
        f"n_{d}": F.count_if(F.col("created_at") >= F.lit(s).cast("timestamp_ntz"))
        for d, s in starts.items()
    }
    recent = in_period(posts, "created_at", min(starts.values()), as_of)
    return _rank_intervals(repost_pairs(recent, counts), users, days, limit, province, userlist, lists)


PARTIALS = "day DATE, retweeted_status BIGINT, user_id BIGINT, n BIGINT"


def partials_table(spark: SparkSession, path: str) -> PartTable:
    """Where counts of reposts per day, original and reposter are kept, by ISO week."""
    return PartTable(spark, path, PARTIALS, sort=("day",))


def repost_partials(posts: DataFrame) -> DataFrame:
    """Reposts per day, original and reposter, with their week as ``part``."""
    dated = reposts(posts).withColumn("day", F.to_date("created_at"))
    counted = dated.groupBy("day", "retweeted_status", "user_id").agg(F.count("*").alias("n"))
    year = F.extract(F.lit("YEAROFWEEK"), "day").cast("bigint")
    return counted.withColumn("part", year * 100 + F.weekofyear("day"))


def add_partials(table: PartTable, new_posts: DataFrame, batch: int) -> None:
    """Count a batch of posts not counted before; late ones join their weeks, and a repeated batch changes nothing."""
    table.add(repost_partials(new_posts), batch)


def merge_partials(table: PartTable, weeks: list[int], batch: int) -> None:
    """Write the weeks' partials as one row for each day, original and reposter again."""
    if table.is_new(batch):
        merged = table.read(weeks).groupBy("part", "day", "retweeted_status", "user_id").agg(F.sum("n").alias("n"))
        table.replace(merged, batch, weeks)


def reports_from_partials(
    table: PartTable,
    users: DataFrame,
    as_of: dt.date,
    days: list[int],
    limit: int | None = None,
    province: int | None = None,
    userlist: DataFrame | None = None,
    lists: list[int] | None = None,
) -> DataFrame:
    """As ``reports_for_intervals``, for the whole days before ``as_of``, from the weeks' partials alone.

    Posts are not read again for a new interval: only the folders of its weeks are.
    """
    starts = {d: as_of - dt.timedelta(days=d) for d in days}
    low, high = (d.isocalendar()[0] * 100 + d.isocalendar()[1] for d in (min(starts.values()), as_of))
    weeks = [p for p in {p for p, _ in table.folders()} if low <= p <= high]
    inside = table.read(weeks).where((F.col("day") >= min(starts.values())) & (F.col("day") < as_of))
    counts = [F.sum(F.when(F.col("day") >= s, F.col("n")).otherwise(0)).alias(f"n_{d}") for d, s in starts.items()]
    pairs = inside.groupBy("retweeted_status", "user_id").agg(*counts)
    return _rank_intervals(pairs, users, days, limit, province, userlist, lists)


def repost_sketches(posts: DataFrame) -> DataFrame:
    """Reposts and a sketch of reposters per day and original; sketches of any days unite (``about_reposters``).

    For streams, where an exact distinct count cannot be kept: a row stays a few kilobytes, however many reposters it has.
    """
    dated = reposts(posts).withColumn("day", F.to_date("created_at"))
    return dated.groupBy("day", "retweeted_status").agg(F.count("*").alias("n"), F.hll_sketch_agg("user_id").alias("sketch"))


def about_reposters(sketches: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """(original, reposts, about how many reposters) of the days from ``start`` up to, not with, ``end``."""
    inside = sketches.where((F.col("day") >= start) & (F.col("day") < end))
    return inside.groupBy("retweeted_status").agg(
        F.sum("n").alias("retweeted_count"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about_users")
    )


def _rank_intervals(
    pairs: DataFrame, users: DataFrame, days: list[int], limit: int | None,
    province: int | None, userlist: DataFrame | None, lists: list[int] | None,
) -> DataFrame:
    """Ranks per interval from (original, reposter) pairs with a count ``n_d`` for each interval of d days."""
    known = users.select(F.col("id").alias("_u"), "province", "gender")
    if lists is not None:
        known = filter_lists(known, userlist, lists, user="_u")
    elif province is not None:
        known = known.filter(F.col("province") == province)
    marked = pairs.join(known, pairs["user_id"] == known["_u"], "left" if lists is None and province is None else "inner")

    def of(d: int) -> dict[str, Column]:
        n, there = F.col(f"n_{d}"), F.col(f"n_{d}") > 0
        man, woman = F.col("gender") == "m", F.col("gender") == "f"
        return {
            "retweeted_count": F.sum(n),
            "distinct_users": F.count_if(there & F.col("_u").isNotNull()),
            "male_count": F.sum(F.when(man, n).otherwise(0)),
            "female_count": F.sum(F.when(woman, n).otherwise(0)),
            "distinct_users_count": F.count_if(there & F.col("user_id").isNotNull()),
            "distinct_male_count": F.count_if(there & man),
            "distinct_female_count": F.count_if(there & woman),
        }

    columns = {d: of(d) for d in days}
    totals = marked.groupBy("retweeted_status").agg(
        *[c.alias(f"{name}_{d}") for d in days for name, c in columns[d].items()]
    )
    cells = F.array(
        *[
            F.struct(F.lit(d).alias("days"), *[F.col(f"{name}_{d}").alias(name) for name in columns[d]])
            for d in days
        ]
    )
    long = totals.select("retweeted_status", F.explode(cells).alias("c")).select("retweeted_status", "c.*")
    # The rank limit is applied inside each task before rows of one interval meet.
    rank = Window.partitionBy("days").orderBy(F.desc("distinct_users"), "retweeted_status")
    ranked = long.filter("retweeted_count > 0").withColumn("rank", F.row_number().over(rank))
    return ranked if limit is None else ranked.filter(F.col("rank") <= limit)
