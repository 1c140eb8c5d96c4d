"""Growth watch: worklists, decisions from two snapshots, and applying them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplekit.operators.filters import by_watch_state, elsewhere_by_type, past_grace, stale
from ripplekit.operators.windows import growth

# Thresholds of the watch rules (ratios in hundredths).
THRESHOLD = 100


def worklist(entities: DataFrame, as_of: dt.datetime, k: int | None = None) -> DataFrame:
    """Undecided entities past the grace period, newest first; with ``k``, so many of each type."""
    unset = past_grace(by_watch_state(entities, "is null"), as_of)
    newest = [F.desc("retrieved"), F.col("id")]
    if k is not None:
        # The rank limit is applied inside each task before rows of one type meet.
        rank = F.row_number().over(Window.partitionBy("type").orderBy(*newest))
        unset = unset.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")
    return unset.orderBy(*newest)


def decision() -> Column:
    """True, false or null (unchanged).  Later rules win, so they are tested first."""
    r, d = F.col("ratio_hundredths"), F.col("diff")
    old, new = F.col("old_cnt"), F.col("new_cnt")
    watching = (
        F.when((d < 10) & (new > 1000), False)
        .when((r < 102) & (new > THRESHOLD), False)
        .when(r > 120, True)
    )
    unset = (
        F.when((old < THRESHOLD) & (new < THRESHOLD), F.lit(None).cast("boolean"))
        .when(d > 30, True)
        .when((r > 115) & (new > THRESHOLD), True)
        .when(d < -10, False)
        .when(r <= 103, False)
    )
    local = F.when((r > 100) | (d > 0), True)
    state = F.col("state")
    return (
        F.when(state == "watching", watching)
        .when(state.isin("notwatching", "notwatchingyet"), unset)
        .when(state == "hongkong", local)
    )


def watch_decision(pairs: DataFrame, states: DataFrame) -> DataFrame:
    """Decision and report list per checked entity.

    Needs a snapshot from before; one from the last hour too unless the entity
    is already watched.  A zero old count is skipped.
    """
    listed = states.select(F.col("id").alias("_id"), "type", "state")
    checked = (
        growth(pairs.join(listed, pairs["eid"] == listed["_id"]))
        .filter("old_cnt IS NOT NULL AND old_cnt <> 0")
        .filter("new_cnt IS NOT NULL OR state = 'watching'")
        .withColumn("decision", decision())
    )
    report = F.when(
        F.col("decision"),
        F.when(F.col("state") == "hongkong", F.lit("hongkongwatching")).when(
            F.col("state") != "watching", F.lit("newlywatching")
        ),
    )
    return checked.select(
        F.col("eid").alias("id"), "type", "state", "old_cnt", "new_cnt", "ratio_hundredths", "diff",
        "decision", report.alias("list"),
    )


def apply_watch(entities: DataFrame, decisions: DataFrame) -> DataFrame:
    new = decisions.filter("decision IS NOT NULL").select(
        F.col("id").alias("_id"), F.col("decision").alias("_new")
    )
    out = entities.join(new, entities["id"] == new["_id"], "left")
    return out.withColumn("watching", F.coalesce("_new", "watching")).drop("_id", "_new")


def stop_watching(entities: DataFrame, stopped: DataFrame) -> DataFrame:
    """Stop watching the entities the clean-up filters selected."""
    return apply_watch(entities, stopped.select("id", F.lit(False).alias("decision")).distinct())


def clean_up(entities: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Stop watching what belongs elsewhere by its type's rule, what has ended and what was never decided."""
    stopped = elsewhere_by_type(entities).select("id").union(stale(entities, as_of).select("id"))
    return stop_watching(entities, stopped)
