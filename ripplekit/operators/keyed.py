"""Keyed table maintenance: each function returns the table's next state.

Batch rows with a null in a key column are left out: they match nothing, so that each
run would insert them again. ``sources.parts.KeyedTable`` writes next states back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.operators.windows import dedupe_first


def _on(keys: list[str], left: DataFrame, right: DataFrame, prefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (left[k] == right[f"{prefix}{k}"])
    return cond


def new_rows(store: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First batch row of each key the store does not hold."""
    return dedupe_first(batch.dropna(subset=keys), keys, order).join(store.select(*keys), keys, "left_anti")


def insert_ignore(store: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Insert rows with new keys; existing keys stay as they are."""
    fresh = new_rows(store, batch, keys, order)
    return store.unionByName(fresh.select([c for c in store.columns if c in fresh.columns]), allowMissingColumns=True)


def upsert(
    store: DataFrame, batch: DataFrame, keys: list[str], order: list[str], present: str | None = None
) -> DataFrame:
    """Insert new keys; for known keys overwrite only columns the payload carries.

    A carried null overwrites, an absent column does not.  Columns missing from
    ``batch`` are absent for all rows; ``present`` names an array column listing
    the carried columns row by row.  Of several batch rows per key the last one
    carrying a column decides it.
    """
    carried = [c for c in store.columns if c not in keys and c in batch.columns]
    at = F.struct(*order)

    def last_value(c: str) -> Column:
        when = F.when(F.array_contains(present, c), at) if present else at
        return F.max_by(F.struct(c), when).alias(f"_b_{c}")

    # A small batch is broadcast to the store, whose rows then stay where they are;
    # only the store's keys are moved, to find the batch's new ones.
    changes = batch.dropna(subset=keys).groupBy(*keys).agg(*[last_value(c) for c in carried], F.lit(True).alias("_in"))
    named = changes.withColumnsRenamed({k: f"_c_{k}" for k in keys})

    def updated(c: str) -> Column:
        if c not in carried:
            return store[c]
        change = F.col(f"_b_{c}")
        return F.when(change.isNotNull(), change[c]).otherwise(store[c]).alias(c)

    def inserted(c: str) -> Column:
        if c in keys:
            return F.col(c)
        kind = store.schema[c].dataType
        return (F.col(f"_b_{c}")[c] if c in carried else F.lit(None)).cast(kind).alias(c)

    kept = store.join(named, _on(keys, store, named, "_c_"), "left").select([updated(c) for c in store.columns])
    new = changes.join(store.select(*keys), keys, "left_anti").select([inserted(c) for c in store.columns])
    return kept.unionByName(new)


def update_or_insert(
    store: DataFrame, batch: DataFrame, keys: list[str], order: list[str], present: str | None = None
) -> DataFrame:
    """Update first, then insert what matched nothing; the same state as ``upsert``."""
    return upsert(store, batch, keys, order, present)


def upsert_outcome(store: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``success`` / ``already_exists`` of each batch row of an insert-only load."""
    first = batch.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
    have = store.select(*keys).distinct().withColumn("_have", F.lit(True))
    known = first.join(have, keys, "left")
    marked = batch.join(known, keys)
    exists = F.col("_have").isNotNull() | (F.struct(*order) != F.col("_first"))
    return marked.withColumns({"already_exists": exists, "success": ~exists}).drop("_have", "_first")


def tombstone(store: DataFrame, deletions: DataFrame, as_of: Column) -> DataFrame:
    """Mark deleted rows once; a later deletion keeps the first date.

    ``deletions`` has ``id`` and ``permission_denied``.
    """
    gone = deletions.groupBy(F.col("id").alias("_d")).agg(
        F.bool_or("permission_denied").alias("_denied")
    )
    out = store.join(gone, store["id"] == gone["_d"], "left")
    newly = F.col("_d").isNotNull() & F.col("deleted").isNull()
    return out.withColumns(
        {
            "deleted": F.when(newly, as_of).otherwise(F.col("deleted")),
            "permission_denied": F.when(newly & F.col("_denied"), F.lit(True)).otherwise(
                F.col("permission_denied")
            ),
        }
    ).drop("_d", "_denied")


def _stamp(df: DataFrame, ids: DataFrame, column: str, as_of: Column) -> DataFrame:
    seen = ids.select(F.col(ids.columns[0]).alias("_s")).distinct()
    out = df.join(seen, df["id"] == seen["_s"], "left")
    old = F.col(column) if column in df.columns else F.lit(None).cast("timestamp_ntz")
    return out.withColumn(column, F.when(F.col("_s").isNotNull(), as_of).otherwise(old)).drop("_s")


def mark_suspended(users: DataFrame, ids: DataFrame, as_of: Column) -> DataFrame:
    """Suspension date; a later report overwrites an earlier one."""
    return _stamp(users, ids, "suspended", as_of)


def touch(users: DataFrame, ids: DataFrame, as_of: Column) -> DataFrame:
    return _stamp(users, ids, "posts_updated", as_of)


def append_snapshot(snaps: DataFrame, counts: DataFrame, as_of: Column) -> DataFrame:
    """The series with one more (entity, count, retrieved) point per entity."""
    return snaps.unionByName(counts.select("eid", as_of.alias("retrieved"), "cnt"))


def users_from_posts(batch: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    """Refresh the user table from the authors seen in a batch, once per author."""
    seen = dedupe_first(
        batch.select(F.col("user_id").alias("id"), "screen_name", F.col("id").alias("_post")), ["id"], ["_post"]
    ).withColumn("retrieved", as_of)
    store = users if "retrieved" in users.columns else users.withColumn(
        "retrieved", F.lit(None).cast("timestamp_ntz")
    )
    return upsert(store, seen, ["id"], ["retrieved"])


def recheck_ids(report: DataFrame, key: str = "id") -> DataFrame:
    """Ids of a stored report, to be asked for again."""
    return report.select(F.col(key).alias("id")).filter("id IS NOT NULL").distinct()
