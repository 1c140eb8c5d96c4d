"""Even shards that keep equal texts together, by balanced label propagation.

Documents with equal texts are linked. Each document starts in a shard chosen by
hash; a group's members take the shard that holds most of their neighbours. All
move at once, so what leaves a shard makes room in it. Large groups go first:
they fill whole shards, in hashed parts. Where the small ones ask for more than a
shard's places, some of them, chosen by hash, go whole to shards with places left,
in rounds until the rows without a place are no longer fewer. A group is counted by
shard before anything is joined, so no link is ever spelled out. Documents without
links give way at the end, when every shard is brought to its exact quota: row
counts of any two shards differ by one at most (the law ``rows``).

Only DataFrame functions are used, and after the first step only narrow rows.
Rows are numbered within a shard from counts of small cells, so no window spans a
shard. The driver sees a row per shard and, of at most ``LARGE`` times as many large
groups as there are shards, a row per shard.

Defined results: a null text has no bytes and equals the empty text; repeated rows
are placed one by one; ids may be null or repeat; other columns are ignored; an
empty table gives an empty one.
"""

from __future__ import annotations

import itertools
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplekit.session import settle

GROUP_CELLS, ROW_CELLS = 64, 16
LARGE = 64  # a group of more than this part of a shard is large


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _by_shard(values: list, shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), shard + 1)


def _sums(counted: DataFrame, shards: int, n: str) -> list[int]:
    found = {r.shard: r.n for r in counted.groupBy("shard").agg(F.sum(n).alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def allot(cells: list, places: list[int]) -> dict[int, list[tuple[int, int]]]:
    """group: its (shard, rows), for (group, shard, held) of large groups; takes them out of the free places.

    Largest first, a group goes whole to the shard that holds most of it of those with places enough,
    or fills the emptiest shards one after the other.
    """
    held: dict[int, dict[int, int]] = {}
    for group, shard, n in cells:
        held.setdefault(group, {})[shard] = n
    out = {}
    for group, by in sorted(held.items(), key=lambda x: (-sum(x[1].values()), x[0])):
        left, parts = sum(by.values()), []
        while left:
            fits = [s for s, n in enumerate(places) if n >= left]
            if fits:
                shard = max(fits, key=lambda s: (by.get(s, 0), -s))
            else:
                shard = max(range(len(places)), key=lambda s: (places[s], by.get(s, 0), -s))
            n = min(left, places[shard])
            places[shard] -= n
            left -= n
            parts.append((shard, n))
        out[group] = parts
    return out


def balance(targets: DataFrame, places: list[int], rounds: int | None) -> DataFrame:
    """(group, members, target) with targets changed until no shard is asked for more than its places.

    As many groups as are too many, chosen by hash, go whole to shards with places left; this is
    repeated until the number of rows without a place stops falling.
    """
    before = None
    for turn in itertools.count():
        asked = _sums(targets.select(F.col("target").alias("shard"), "members"), len(places), "members")
        over = sum(max(0, a - n) for a, n in zip(asked, places))
        if not over or turn == rounds or before is not None and over >= before[0]:
            return targets if before is None or over < before[0] else before[1]
        before = over, targets
        goes = _unit("group", F.lit(2 * turn)) < _by_shard([max(0, a - n) / a if a else 0.0 for a, n in zip(asked, places)], F.col("target"))
        room = [max(0, n - a) for a, n in zip(asked, places)]
        ends = [n / sum(room) for n in accumulate(room)]
        other = _in_parts(_unit("group", F.lit(2 * turn + 1)), [(s, e) for s, (e, n) in enumerate(zip(ends, room)) if n])
        targets = settle(targets.withColumn("target", F.when(goes, other).otherwise(F.col("target"))), "targets")


def _in_parts(unit: Column, ends: list[tuple[int, float]]) -> Column:
    """The first shard whose end lies beyond the unit."""
    to = F.lit(ends[-1][0])
    for shard, end in reversed(ends[:-1]):
        to = F.when(unit < end, F.lit(shard)).otherwise(to)
    return to


def propagate(linked: DataFrame, quotas: list[int], rounds: int | None) -> DataFrame:
    """(row, shard): each group's members where most of their neighbours are, as far as the quotas allow."""
    shards, quota = len(quotas), max(quotas)
    cells = linked.groupBy("group", "shard").agg(F.count("*").alias("held"), F.max("members").alias("members"))
    cells = settle(cells.withColumn("large", F.col("members") * LARGE > quota), "cells")
    places = list(quotas)
    found = cells.where("large").select("group", "shard", "held").collect()
    allotted = allot([tuple(r) for r in found], places)

    best = F.max(F.struct(F.when(_by_shard(places, F.col("shard")) > 0, F.col("held")).otherwise(0).alias("held"),
                          F.xxhash64("group", "shard").alias("tie"), "shard"))
    small = cells.where("NOT large").groupBy("group").agg(F.max("members").alias("members"), best.alias("best"))
    targets = balance(settle(small.select("group", "members", F.col("best.shard").alias("target")), "targets"), places, rounds)

    spread = []  # (group, shard, from, to): parts of the unit interval
    for group, parts in allotted.items():
        whole, at = sum(n for _, n in parts), 0
        for shard, n in parts:
            spread.append((group, shard, at / whole, (at + n) / whole))
            at += n
    written = [f"named_struct('g', {g}L, 's', {s}, 'low', {low!r}D, 'high', {high!r}D)" for g, s, low, high in spread]
    kind = "array<struct<g:bigint,s:int,low:double,high:double>>"
    parts = linked.sparkSession.range(1).select(F.inline(F.expr(f"CAST(array({', '.join(written)}) AS {kind})")))
    parts = settle(parts.groupBy("g").agg(F.collect_list(F.struct("s", "low", "high")).alias("parts")), "parts")
    unit = _unit("row", F.lit(2))
    part = F.filter("parts", lambda p: (p["low"] <= unit) & (unit < p["high"]))[0]["s"]
    large = linked.join(parts, F.col("group") == F.col("g")).select("row", part.alias("shard"))
    return settle(linked.join(targets, "group").select("row", F.col("target").alias("shard")).unionByName(large), "placed")


def shard_documents(
    docs: DataFrame, shards: int = 16, rounds: int | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, size, text_crc32, group, shard, slot): size is UTF-8 bytes plus one; slots count from 0 in each shard."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = settle(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(body).cast("bigint") + 1).alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.xxhash64(body).alias("group"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    first = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    # Written first: with a table on the other side Spark can split the rows of a hot group.
    groups = settle(rows.groupBy("group").agg(F.count("*").alias("members")).where("members > 1"), "groups")
    linked = settle(rows.join(groups, "group").select("row", "group", "members", first.alias("shard")), "linked")
    linked = propagate(linked, quotas, rounds)

    held = linked.select("row", "shard", F.lit(0).alias("free"))
    placed = rows.join(held, "row", "left").select(
        "key", "size", "text_crc32", "group", "row",
        F.coalesce("shard", first).alias("shard"),
        F.coalesce("free", F.lit(1)).alias("free"),
        F.pmod(F.xxhash64("group"), F.lit(GROUP_CELLS)).alias("a"),
        F.pmod(F.xxhash64("row", F.lit(1)), F.lit(ROW_CELLS)).alias("b"),
    )
    placed = settle(placed, "placed")
    cell = ["shard", "free", "a", "b"]
    counts = settle(placed.groupBy(*cell).agg(F.count("*").alias("n")), "cells")
    loads = _sums(counts, shards, "n")
    before = Window.partitionBy("shard").orderBy("free", "a", "b").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy(*cell).orderBy("group", "row")
    ranked = placed.join(bases, cell).withColumn("rank", F.col("base") + F.row_number().over(inside) - 1)

    # Rows beyond a quota, numbered over all shards, fill the places that other shards have left.
    spare = [0, *accumulate(max(0, load - q) for load, q in zip(loads, quotas))]
    lacking = [max(0, q - load) for load, q in zip(loads, quotas)]
    gaps = [0, *accumulate(lacking)]
    shard, rank = F.col("shard"), F.col("rank")
    stays = rank < _by_shard(quotas, shard)
    number = _by_shard(spare[:-1], shard) + rank - _by_shard(quotas, shard)
    takers = [s for s in range(shards) if lacking[s]]
    to = F.lit(shards - 1)
    for s in reversed(takers):
        to = F.when(number < gaps[s + 1], F.lit(s)).otherwise(to)
    ends = ranked.withColumn("to", F.when(stays, shard).otherwise(to).cast("int"))
    slot = F.when(stays, rank).otherwise(_by_shard(loads, F.col("to")) + number - _by_shard(gaps[:-1], F.col("to")))
    return ends.select(
        F.col("key").alias(key), "size", "text_crc32", "group", F.col("to").alias("shard"), slot.cast("bigint").alias("slot")
    )
