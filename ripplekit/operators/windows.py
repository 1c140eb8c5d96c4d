"""Per-key ordering questions, answered by aggregates where one value suffices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplekit.functions.times import minute_floor
from ripplekit.operators.joins import carry_last


def latest(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Newest row per key.  ``max_by`` aggregates on the map side, so a key with
    very many snapshots sends one row per task instead of all of them."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(ts)).alias("r")).select(key, "r.*")


def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in batch order."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
        .select(*keys, "r.*")
        .select(*df.columns)
    )


def first_binding(reposts: DataFrame) -> DataFrame:
    """First user id seen under each screen name, in id order."""
    return reposts.groupBy("screen_name").agg(F.min_by("user_id", "id").alias("user_id"))


def growth(pair: DataFrame) -> DataFrame:
    """Ratio (truncated to hundredths) and difference; no ratio from zero."""
    old, new = F.col("old_cnt"), F.col("new_cnt")
    hundredths = F.when(old != 0, F.floor(new * 100 / old)).cast("bigint")
    return pair.withColumns(
        {"ratio_hundredths": hundredths, "ratio": hundredths / 100.0, "diff": new - old}
    )


def incremental_cutoff(
    batch: DataFrame,
    store: DataFrame,
    n: int,
    reset: bool,
    page: str = "user_id",
    key: str = "id",
    ts: str = "created_at",
) -> DataFrame:
    """Rows of each newest-first page that a crawler would still process.

    It stops at the ``n``-th already-known row: counted over the page, or, with
    ``reset``, over the run of known rows since the last new one.  The cut row
    itself is processed.  A page may be very large, so nothing here sorts a
    whole page in one task: the run a row belongs to is named by the last new
    row before it (``carry_last``), run lengths are aggregated, and the cut is
    the ``n``-th row of the newest run that is long enough.
    """
    have = store.select(F.col(key).alias("_k")).distinct()
    rows = batch.join(have, batch[key] == have["_k"], "left").withColumn("known", F.col("_k").isNotNull())
    # Newest first: negated epoch micros order ascending, ids break ties.
    age = -F.unix_micros(F.col(ts).cast("timestamp"))
    rows = rows.drop("_k").withColumns({"_age": age, "_tie": -F.col(key)})
    known = rows.filter("known")
    if reset:
        marked = rows.withColumns(
            {"_minute": -F.unix_micros(minute_floor(F.col(ts)).cast("timestamp")),
             "_new": F.when(~F.col("known"), F.struct("_age", "_tie"))}
        )
        runs = carry_last(marked, [page], ["_age", "_tie"], "_new", "_minute", "_run")
        top = F.struct(F.lit(None).cast("bigint").alias("_age"), F.lit(None).cast("bigint").alias("_tie"))
        known = runs.filter("known").withColumn("_run", F.coalesce("_run", top))
        # A null-keyed run (no new row before it) sorts first, as it must.
        long_enough = (
            known.groupBy(page, "_run").agg(F.count("*").alias("_len")).filter(F.col("_len") >= n)
        )
        newest = long_enough.groupBy(page).agg(F.min("_run").alias("_cut_run"))
        newest = newest.withColumnRenamed(page, "_page")
        known = known.join(
            newest, known[page].eqNullSafe(newest["_page"]) & known["_run"].eqNullSafe(newest["_cut_run"]), "left_semi"
        )
    nth = Window.partitionBy(page).orderBy("_age", "_tie")
    cut = (
        known.select(page, "_age", "_tie", F.row_number().over(nth).alias("_rn"))
        .filter(F.col("_rn") <= n)
        .groupBy(page)
        .agg(F.max(F.when(F.col("_rn") == n, F.struct("_age", "_tie"))).alias("_cut"))
        .withColumnRenamed(page, "_page")
    )
    out = rows.join(cut, rows[page].eqNullSafe(cut["_page"]), "left")
    keep = F.col("_cut").isNull() | (F.struct("_age", "_tie") <= F.col("_cut"))
    return out.filter(keep).drop("_page", "_cut", "_age", "_tie")


def touch_users(posts: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    """Users with their newest post date, and ``posts_updated`` for those seen."""
    newest = posts.groupBy(F.col("user_id").alias("_u")).agg(F.max("created_at").alias("_last"))
    out = users.join(newest, users["id"] == newest["_u"], "left")
    return out.withColumns(
        {
            "last_post_date": F.coalesce("_last", _or_null(users, "last_post_date")),
            "posts_updated": F.when(F.col("_u").isNotNull(), as_of).otherwise(_or_null(users, "posts_updated")),
        }
    ).drop("_u", "_last")


def _or_null(df: DataFrame, column: str) -> Column:
    return F.col(column) if column in df.columns else F.lit(None).cast("timestamp_ntz")
