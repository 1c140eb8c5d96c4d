"""Structured Streaming variants of ingest, upsert, trend, ranking, watch and tombstones.

Stateful results go to a change log: micro-batch N overwrites folder ``batch=N``,
so a replayed batch leaves the log unchanged, and readers fold the log into the
current state.  A batch costs its own changes, never a rewrite of the store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ripplekit.operators.joins import snapshot_pair
from ripplekit.operators.keyed import upsert
from ripplekit.operators.watch import apply_watch, watch_decision
from ripplekit.session import settle
from ripplekit.sources.parts import KeyedTable, PartTable, fold_log


#: How streams run if nothing else is asked for: drain what is there, then stop.
DRAIN = {"availableNow": True}


def begin(writer: DataStreamWriter, trigger: dict | None = None) -> StreamingQuery:
    """Start a stream with the arguments of ``DataStreamWriter.trigger``; one that drains is waited for."""
    query = writer.trigger(**(trigger or DRAIN)).start()
    if not trigger or trigger.get("availableNow") or trigger.get("once"):
        query.awaitTermination()
    return query


def run_available(stream: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write a stream to an append-only Parquet table; drains what is available unless given a trigger."""
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return begin(writer.outputMode("append"), trigger)


def write_batch(df: DataFrame, log: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")


def run_to_log(
    stream: DataFrame,
    log: str,
    checkpoint: str,
    mode: str = "append",
    each: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write a stream to a change log (or a custom batch writer); drains what is available unless given a trigger."""
    # An empty first entry, so that a stream without data leaves a readable log.
    write_batch(stream.sparkSession.createDataFrame([], stream.schema), log, -1)
    writer = each or (lambda df, batch_id: write_batch(df, log, batch_id))
    return begin(stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).outputMode(mode), trigger)


def run_folded(
    stream: DataFrame, log: str, checkpoint: str, table: KeyedTable,
    change: Callable[[DataFrame, DataFrame], DataFrame], every: int = 20, trigger: dict | None = None,
) -> StreamingQuery:
    """Log a stream's changes, and every so many micro-batches write them back to the table and delete their entries.

    A micro-batch costs its own changes; the log never holds more than ``every`` of them.
    The table's batch numbers are the stream's, so a replayed micro-batch writes nothing twice.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, log, batch_id)
        if (batch_id + 1) % every == 0:
            fold_log(table, log, batch_id, change)

    return run_to_log(stream, log, checkpoint, each=each, trigger=trigger)


def last_change(keys: list[str], order: list[str], present: str | None = None) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """For ``run_folded`` and ``fold_log``: what ``current_rows`` makes of a log."""
    return lambda store, log: current_rows(store, log, keys, order, present)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.parquet(log)


def latest_of(log: DataFrame, keys: list[str]) -> DataFrame:
    """Newest logged row per key; map-side reducible."""
    rest = [c for c in log.columns if c not in keys and c != "batch"]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")


def stream_ingest(src: DataFrame, horizon: str, key: str = "id", ts: str = "created_at") -> DataFrame:
    """Rows with ids not yet seen within the horizon."""
    return src.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def stream_upsert(src: DataFrame, log: str, checkpoint: str) -> None:
    """Log profile changes; ``current_rows`` folds them into the table."""
    run_to_log(src, log, checkpoint)


def current_rows(
    store: DataFrame, log: DataFrame, keys: list[str], order: list[str], present: str | None = None
) -> DataFrame:
    return upsert(store, log, keys, ["batch", *order], present)


def stream_trend(src: DataFrame, width: str, late: str = "1 hour", ts: str = "created_at") -> DataFrame:
    """Reposts and about how many reposters, per original and tumbling window."""
    return (
        src.filter("retweeted_status IS NOT NULL")
        .withWatermark(ts, late)
        .groupBy(F.window(ts, width).alias("w"), "retweeted_status")
        .agg(F.count("*").alias("count"), F.approx_count_distinct("user_id").alias("users"))
        .select(F.col("w.start").alias("window_start"), "retweeted_status", "count", "users")
    )


def stream_top(src: DataFrame, every: str, late: str = "1 hour", ts: str = "created_at") -> DataFrame:
    """Repost counts per original in steps of ``every``.

    Only steps are kept as state; a look-back period is the sum of its steps
    (``sliding_counts``), so state does not grow with look-back over step.
    """
    return stream_trend(src, every, late, ts).drop("users")


def sliding_counts(counts: DataFrame, every: Column, steps: int) -> DataFrame:
    """Look-back windows of ``steps`` steps, from per-step counts.

    A step adds its count to the first window that holds it and takes it away
    after the last, so two rows per step are moved whatever the look-back; the
    running sum holds from one such change to the next.
    """
    first = F.col("window_start") - every * (steps - 1)
    changes = F.array(
        F.struct(first.alias("at"), F.col("count").alias("d")),
        F.struct((F.col("window_start") + every).alias("at"), (-F.col("count")).alias("d")),
    )
    summed = (
        counts.select("retweeted_status", F.explode(changes).alias("c"))
        .groupBy("retweeted_status", F.col("c.at").alias("at"))
        .agg(F.sum("c.d").alias("d"))
    )
    one = Window.partitionBy("retweeted_status").orderBy("at")
    running = summed.withColumns({"count": F.sum("d").over(one), "until": F.lead("at").over(one)})
    return running.filter("count > 0").select(
        F.explode(F.sequence("at", F.col("until") - every, every)).alias("window_start"), "retweeted_status", "count"
    )


def top_per_window(counts: DataFrame, k: int) -> DataFrame:
    """First ``k`` per window; Spark applies the rank limit before the shuffle."""
    rank = Window.partitionBy("window_start").orderBy(F.desc("count"), "retweeted_status")
    return counts.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)


RANKED = "window_start TIMESTAMP, retweeted_status BIGINT, count BIGINT, rank INT"


def ranked_table(spark: SparkSession, path: str) -> PartTable:
    """Where ``stream_ranked`` keeps the best of each window, by the day the window begins."""
    return PartTable(spark, path, RANKED)


def stream_ranked(
    src: DataFrame, table: PartTable, look_back: str, step: str, k: int, checkpoint: str,
    late: str = "1 hour", ts: str = "created_at", trigger: dict | None = None,
) -> StreamingQuery:
    """The ``k`` most reposted of each sliding window, kept up to date while the stream runs.

    Spark counts originals in windows of ``look_back`` every ``step`` and forgets windows that the
    watermark has passed. A micro-batch brings the counts that changed; as counts only grow, a
    window's new best are among its old best and these, so only windows that the micro-batch touched are
    ranked again, and only their days are written.
    """
    counts = (
        src.filter("retweeted_status IS NOT NULL")
        .withWatermark(ts, late)
        .groupBy(F.window(ts, look_back, step).alias("w"), "retweeted_status")
        .agg(F.count("*").alias("count"))
        .select(F.col("w.start").alias("window_start"), "retweeted_status", "count")
    )

    def rank(batch: DataFrame, batch_id: int) -> None:
        # Spark wants a micro-batch's state computed even if it is a replay that changes nothing.
        changed = settle(batch.withColumn("part", F.unix_date(F.to_date("window_start")).cast("bigint")), "counts")
        if not table.is_new(batch_id):
            return
        days = sorted(r[0] for r in changed.select("part").distinct().collect())  # bounded by the calendar
        known = table.read(days).select(*changed.columns)
        best = known.unionByName(changed).groupBy("part", "window_start", "retweeted_status").agg(F.max("count").alias("count"))
        table.stage(top_per_window(best, k), batch_id)
        table.commit(batch_id, days)

    writer = counts.writeStream.foreachBatch(rank).option("checkpointLocation", checkpoint).outputMode("update")
    return begin(writer, trigger)


PAIR_STATE = "eid BIGINT, old_retrieved {0}, old_cnt BIGINT, new_retrieved {0}, new_cnt BIGINT"


def merge_pairs(pairs: DataFrame) -> DataFrame:
    """Newest snapshot before and since, per entity, of several such pairs."""
    return pairs.groupBy("eid").agg(
        F.max("old_retrieved").alias("old_retrieved"), F.max_by("old_cnt", "old_retrieved").alias("old_cnt"),
        F.max("new_retrieved").alias("new_retrieved"), F.max_by("new_cnt", "new_retrieved").alias("new_cnt"),
    )


def pair_state(spark: SparkSession, pairs: str, batch_id: int, every: int) -> DataFrame:
    """The pairs known before a micro-batch: the last full state and the changes since."""
    full = batch_id // every * every - 1
    base = spark.read.parquet(f"{pairs}/full/upto={full}")
    log = read_log(spark, f"{pairs}/log").filter((F.col("batch") > full) & (F.col("batch") < batch_id))
    return base.unionByName(log.select(base.columns))


def stream_watch(
    src: DataFrame, states: DataFrame, before: Column, since: Column,
    snapshots: str, decisions: str, checkpoint: str, compact_every: int = 20,
) -> None:
    """Log snapshots, then decide the entities the micro-batch touched.

    Per entity the newest snapshot before and the newest since are kept, so a
    micro-batch reads one row per entity and not the history.  Every
    ``compact_every`` batches the state is written in full; a replayed batch
    reads what was known before it and writes the same.  The two dates are those
    of the state: with other dates, begin a new one.
    """
    spark, pairs = src.sparkSession, f"{snapshots}-pairs"

    def decide(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, snapshots, batch_id)
        seen = snapshot_pair(read_log(spark, f"{snapshots}/batch={batch_id}"), before, since)
        known = pair_state(spark, pairs, batch_id, compact_every)
        mine = known.join(seen.select("eid"), "eid", "left_semi")
        write_batch(merge_pairs(seen.unionByName(mine)), f"{pairs}/log", batch_id)
        touched = read_log(spark, f"{pairs}/log/batch={batch_id}")
        write_batch(watch_decision(touched, states).select("id", "decision"), decisions, batch_id)
        if (batch_id + 1) % compact_every == 0:
            full = merge_pairs(known.unionByName(touched))
            full.write.mode("overwrite").parquet(f"{pairs}/full/upto={batch_id}")

    write_batch(spark.createDataFrame([], "id BIGINT, decision BOOLEAN"), decisions, -1)
    empty = spark.createDataFrame([], PAIR_STATE.format(src.schema["retrieved"].dataType.simpleString()))
    write_batch(empty, f"{pairs}/log", -1)
    empty.write.mode("ignore").parquet(f"{pairs}/full/upto=-1")
    run_to_log(src, snapshots, checkpoint, each=decide)


def current_watch(entities: DataFrame, decisions: DataFrame) -> DataFrame:
    return apply_watch(entities, latest_of(decisions.filter("decision IS NOT NULL"), ["id"]))


def stream_tombstones(src: DataFrame, log: str, checkpoint: str) -> None:
    """Log deletion events ``(id, deleted_at, permission_denied)``."""
    run_to_log(src, log, checkpoint)


def current_tombstones(store: DataFrame, log: DataFrame) -> DataFrame:
    """The first deletion of a row decides its date and reason."""
    first = log.groupBy(F.col("id").alias("_d")).agg(
        F.min("deleted_at").alias("_at"), F.min_by("permission_denied", "deleted_at").alias("_denied")
    )
    out = store.join(first, store["id"] == first["_d"], "left")
    newly = F.col("deleted").isNull() & F.col("_at").isNotNull()
    return out.withColumns(
        {
            "deleted": F.when(newly, F.col("_at")).otherwise(F.col("deleted")),
            "permission_denied": F.when(newly & F.col("_denied"), F.lit(True)).otherwise(
                F.col("permission_denied")
            ),
        }
    ).drop("_d", "_at", "_denied")


def newest_first(frames: list[pd.DataFrame], ts: str, key: str) -> pd.DataFrame:
    """A page's rows by falling time, then key. Most pages are short and no two rows are of one time: then times alone, as an array, tell."""
    frame = frames[0] if len(frames) == 1 else pd.concat(frames)
    times = frame[ts].to_numpy()
    order = np.argsort(times)[::-1]
    times = times[order]
    if times.dtype.kind == "M" and (times[1:] < times[:-1]).all() and not np.isnat(times[-1:]).any():
        return frame.iloc[order]
    return frame.sort_values([ts, key], ascending=False)


def stream_until_known(
    src: DataFrame, store: DataFrame, n: int, page: str = "user_id", key: str = "id", ts: str = "created_at"
) -> DataFrame:
    """``incremental_cutoff`` with ``reset``, as a stream of pages fetched newest first.

    For each page (user) a counter of the known rows since the last new one is kept between
    micro-batches; the row that brings it to ``n`` is the last to pass, and what arrives later is
    ignored. A micro-batch may split a page anywhere, as long as older rows do not come before newer ones. Null
    pages are a page. A page's rows of one micro-batch are in one task, as the source's limit bounds them.
    """
    have = store.select(F.col(key).alias("_k")).distinct()
    rows = src.join(have, src[key] == have["_k"], "left").withColumn("known", F.col("_k").isNotNull()).drop("_k")

    def work(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, done = state.get if state.exists else (0, False)
        if done:
            return
        frame = newest_first(list(frames), ts, key)
        passed = 0
        for known in frame["known"].tolist():
            passed += 1
            run = run + 1 if known else 0
            if run == n:
                done = True
                break
        state.update((run, done))
        yield frame.iloc[:passed]

    return rows.groupBy(page).applyInPandasWithState(
        work, rows.schema, "run int, done boolean", "append", GroupStateTimeout.NoTimeout
    )
