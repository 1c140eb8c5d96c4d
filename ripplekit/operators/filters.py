"""Row filters; each is a plain predicate so that it can reach the scan."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.functions.geo import distance_km

# Place words of the region rules (``%`` is the SQL wildcard) and post types.
TAIWAN_WORDS_ANY_CASE = ["%taiwan%", "%taipei%"]
TAIWAN_WORDS = ["%臺%", "%台灣%", "%台北%", "%高雄%", "%台中%", "%台南%", "%新竹%", "%花蓮%"]
HONG_KONG_WORDS_ANY_CASE = ["%hong%kong%"]
HONG_KONG_WORDS = ["%香港%"]
TAIWAN_LINKS = ["%.tw%", "%tw.%"]
HONG_KONG_LINKS = ["%.hk%", "%hongkong%"]
POST_TYPES = ["video", "link", "status", "photo", "music"]


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def in_period(
    df: DataFrame, ts: str, start: dt.datetime, end: dt.datetime | None = None, closed: bool = True
) -> DataFrame:
    """``start <= ts`` and, when given, ``ts <= end`` (``< end`` when not closed)."""
    c = F.col(ts)
    df = df.filter(c >= F.lit(start).cast("timestamp_ntz"))
    if end is None:
        return df
    limit = F.lit(end).cast("timestamp_ntz")
    return df.filter(c <= limit if closed else c < limit)


def reposts(df: DataFrame) -> DataFrame:
    return df.filter("retweeted_status IS NOT NULL")


def filter_audience(
    star: DataFrame, province: int | None = None, max_followers: int | None = None
) -> DataFrame:
    """Reposter's province and the original author's audience, on a repost star."""
    if province is not None:
        star = star.filter(F.col("province") == province)
    if max_followers is not None:
        star = star.filter(F.col("original_followers_count") < max_followers)
    return star


def filter_lists(df: DataFrame, userlist: DataFrame, lists: list[int], user: str = "user_id") -> DataFrame:
    """Rows whose user is on any of the lists; a semi join never multiplies rows."""
    chosen = userlist.filter(F.col("list_id").isin(lists)).select(F.col("user_id").alias("_member"))
    return df.join(chosen, df[user] == chosen["_member"], "left_semi")


def min_account_age(grouped: DataFrame, cutoff: dt.datetime) -> DataFrame:
    return grouped.filter(F.col("min_user_created_at") <= F.lit(cutoff).cast("timestamp_ntz"))


def by_ids(df: DataFrame, ids: list[int] | DataFrame, key: str = "id") -> DataFrame:
    """Literal ids are pushed to the scan; an id table is a semi join."""
    if isinstance(ids, DataFrame):
        wanted = ids.toDF("_wanted")
        return df.join(wanted, df[key] == wanted["_wanted"], "left_semi")
    return df.filter(F.col(key).isin(ids))


def drop_spam(links: DataFrame, spam: DataFrame, key: str = "rt_status_id") -> DataFrame:
    """SQL ``NOT IN``: rows with a null key go too, once there is any spam id.

    The null test reads one row of the list; the anti join itself is an equi
    join, so neither side has to be broadcast.
    """
    ids = spam.toDF("_spam").filter("_spam IS NOT NULL")
    any_spam = spam.limit(1).agg((F.count("*") > 0).alias("x")).scalar()
    kept = links.filter(F.col(key).isNotNull() | ~any_spam)
    return kept.join(ids, kept[key] == ids["_spam"], "left_anti")


def region_rule(column: str) -> Column:
    """Mentions Taiwan and does not mention Hong Kong."""
    c = F.col(column)
    inside = _any([c.ilike(w) for w in TAIWAN_WORDS_ANY_CASE] + [c.like(w) for w in TAIWAN_WORDS])
    outside = _any([c.ilike(w) for w in HONG_KONG_WORDS_ANY_CASE] + [c.like(w) for w in HONG_KONG_WORDS])
    return inside & ~outside


def link_rule(column: str = "link") -> Column:
    c = F.col(column)
    return _any([c.ilike(w) for w in TAIWAN_LINKS]) & ~_any([c.ilike(w) for w in HONG_KONG_LINKS])


def keyword_rule(df: DataFrame, columns: list[str], links: tuple[str, ...] = ()) -> DataFrame:
    """Still-watched rows that any of the text or link columns places elsewhere."""
    rules = [region_rule(c) for c in columns] + [link_rule(c) for c in links]
    return by_watch_state(df, "is not false").filter(_any([F.coalesce(r, F.lit(False)) for r in rules]))


# The text and link columns by which objects of a type are placed.
PLACING_COLUMNS = {
    "group": (("name",), ("link",)),
    "event": (("description", "location", "name"), ()),
    "page": (("name",), ("link",)),
}


def elsewhere_by_type(df: DataFrame) -> DataFrame:
    """Still-watched objects that a column of their type's rule places elsewhere."""
    rules = [
        F.coalesce((F.col("type") == kind) & rule, F.lit(False))
        for kind, (texts, links) in PLACING_COLUMNS.items()
        for rule in [*map(region_rule, texts), *map(link_rule, links)]
    ]
    return by_watch_state(df, "is not false").filter(_any(rules))


def by_watch_state(df: DataFrame, state: str, flag: str = "watching") -> DataFrame:
    """``state`` is ``is null``, ``is true``, ``is false`` or ``is not false``."""
    c = F.col(flag)
    tests = {
        "is null": c.isNull(),
        "is true": c.eqNullSafe(True),
        "is false": c.eqNullSafe(False),
        "is not false": ~c.eqNullSafe(False),
    }
    return df.filter(tests[state])


def stale(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Objects to stop watching: events over for a week, or never-decided groups
    and pages fetched more than a month ago."""
    ended = F.lit(as_of - dt.timedelta(days=7)).cast("timestamp_ntz")
    month_ago = F.add_months(F.lit(as_of.date()), -1).cast("timestamp_ntz")
    old_event = (F.col("type") == "event") & (F.col("end_time") < ended) & ~F.col("watching").eqNullSafe(False)
    old_other = (F.col("type") != "event") & (F.col("retrieved") < month_ago) & F.col("watching").isNull()
    return df.filter(old_event | old_other)


def past_grace(df: DataFrame, as_of: dt.datetime, hours: int = 36) -> DataFrame:
    limit = F.lit(as_of - dt.timedelta(hours=hours)).cast("timestamp_ntz")
    return df.filter(F.col("retrieved") < limit)


def by_insert_date(df: DataFrame, day: dt.date | None, column: str = "dbinserted") -> DataFrame:
    """One insert day as a half-open range, so row-group statistics apply."""
    if day is None:
        return df.filter(F.col(column).isNull())
    start = dt.datetime.combine(day, dt.time())
    return in_period(df, column, start, start + dt.timedelta(days=1), closed=False)


def geo_or_location(df: DataFrame, prefix: str) -> DataFrame:
    return df.filter(F.col("geo").isNotNull() | F.col("location").startswith(prefix))


def flag_spam(links: DataFrame, sites: DataFrame, location: str = "location") -> DataFrame:
    """Mark links whose text, from some point of the host on, starts with a site.

    Instead of testing every link against every site, each distinct host offers
    its substrings of the lengths sites have, and those meet the sites in an
    equi join: work per host is bounded by its length times the distinct site
    lengths, whatever the number of sites.  Only sites that contain a slash can
    reach past the host and are probed with whole links.
    """
    site = sites.toDF("_site").filter("_site IS NOT NULL AND _site <> ''").distinct()
    url = F.col("_loc")
    locs = links.select(F.col(location).alias("_loc")).filter(url.startswith("http://")).distinct()
    hosts = locs.select(_host(url).alias("_host"))
    in_path = F.col("_site").contains("/")
    bad_hosts = _starting_inside(
        hosts.select("_host", F.col("_host").alias("_text")).distinct(), site.filter(~in_path)
    ).select("_host").distinct()
    bad_locs = _starting_inside(
        locs.select("_loc", url.alias("_text"), _host(url).alias("_host")), site.filter(in_path)
    ).select("_loc").distinct()
    marked = links.withColumn("_host", F.when(F.col(location).startswith("http://"), _host(F.col(location))))
    marked = marked.join(bad_hosts.withColumn("_by_host", F.lit(True)), "_host", "left")
    marked = marked.join(bad_locs.withColumn("_by_loc", F.lit(True)), marked[location] == bad_locs["_loc"], "left")
    return marked.withColumn(
        "is_spam", F.coalesce("_by_host", "_by_loc", F.lit(False))
    ).drop("_host", "_loc", "_by_host", "_by_loc")


def _host(url: Column) -> Column:
    return F.regexp_extract(url, r"^http://[^/]*", 0)


def _starting_inside(texts: DataFrame, site: DataFrame) -> DataFrame:
    """Rows whose ``_text`` continues with a site from some point of its ``_host`` part."""
    lengths = site.agg(F.collect_set(F.length("_site"))).scalar()
    probes = (
        texts.withColumn("_lengths", lengths)
        .withColumn("_at", F.explode(F.sequence(F.lit(8), F.length("_host") + 1)))
        .withColumn("_n", F.explode("_lengths"))
        .withColumn("_part", F.substr("_text", F.col("_at"), F.col("_n")))
    )
    return probes.join(site, F.col("_part") == F.col("_site"), "left_semi")


def type_guard(df: DataFrame, declared: str = "declared_type", reflected: str = "type") -> DataFrame:
    """Rows reflecting the declared type, no type, or any post type."""
    r = F.col(reflected)
    d = F.coalesce(F.col(declared), r)
    return df.filter(r.isNull() | (r == d) | r.isin(POST_TYPES))


def in_bbox(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points joined to every box that contains them.

    A box is listed under the grid cells it touches (four at most) of a grid as
    wide as the box, the next power of two of its longer side; a point is listed
    under its own cell of each grid that has boxes.  So a point meets only boxes
    about as near as they are large, whatever the mix of sizes.
    """
    known = boxes.filter("lon0 <= lon1 AND lat0 <= lat1")
    extent = F.greatest(F.col("lon1") - F.col("lon0"), F.col("lat1") - F.col("lat0"), F.lit(2.0**-20))
    sized = known.withColumn("_scale", F.ceil(F.log2(extent)).cast("int"))
    scales = sized.agg(F.collect_set("_scale")).scalar()

    def cell(c: str) -> Column:
        return F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("_scale"))).cast("bigint")

    celled = sized.withColumn("_cx", F.explode(F.sequence(cell("lon0"), cell("lon1")))).withColumn(
        "_cy", F.explode(F.sequence(cell("lat0"), cell("lat1")))
    )
    placed = points.withColumn("_scale", F.explode(scales)).withColumns({"_cx": cell("lon"), "_cy": cell("lat")})
    inside = F.col("lon").between(F.col("lon0"), F.col("lon1")) & F.col("lat").between(
        F.col("lat0"), F.col("lat1")
    )
    return placed.join(celled, ["_scale", "_cx", "_cy"]).filter(inside).drop("_scale", "_cx", "_cy")


def within_radius(points: DataFrame, lon: float, lat: float, km: float) -> DataFrame:
    d = distance_km(F.col("lon"), F.col("lat"), F.lit(lon), F.lit(lat))
    degrees = km / 111.0 + 0.01
    return points.filter(F.col("lat").between(lat - degrees, lat + degrees)).withColumn(
        "distance_km", d
    ).filter(F.col("distance_km") <= km)
