"""Documents packed into token sequences by a grouping genetic algorithm on islands.

Texts become pieces of at most ``capacity`` tokens; full pieces are sequences of
their own. The others are dealt by hash to shards of about ``ITEMS`` pieces, and
each shard to several islands. An island evolves a few packings of its shard:
crossover injects the well-filled bins of one parent into another, drops the bins
that hold any of their documents again, and best-fits the documents so displaced,
longest first; mutation empties the least filled bins. After an epoch each island's
best packing migrates to the next island of its shard. A shard's best packing
closes its well-filled bins; the pieces of the others go on, into fewer shards,
until one shard takes them all or a level closes less than half.

Defined results: a null or empty text is one piece, the end token. Repeated rows
are packed one by one. Only texts longer than a sequence are cut. Ids may be null
or repeat; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplekit.llm.common import map_rows
from ripplekit.llm.words import library_bare
from ripplekit.session import settle

CAPACITY = 2048
END = 0
ITEMS = 4000
ISLANDS, EPOCHS = 2, 2
POPULATION, GENERATIONS = 4, 6
FILLED = 0.97

Bins = list[list[int]]


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", with_ids: bool = True
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, and ids if asked for): a text's ids and the end token, cut only when longer than a sequence."""

    def start():
        encode = library_bare(path).ids
        end = END.to_bytes(4, "little")

        def work(row_key, row_text):
            ids = (encode(row_text) if row_text else b"") + end
            for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                yield row_key, number, at // 4, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])

        return work

    kind = docs.schema[key].dataType.simpleString()
    ddl = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return map_rows(docs.select(key, text), start, ddl)


def best_fit(order: list[int], lengths: list[int], capacity: int, bins: Bins = ()) -> Bins:
    """Put items into the bins with the least sufficient room, or into new ones."""
    bins = [list(b) for b in bins]
    shelves: dict[int, list[int]] = {}  # bins by room
    rooms = 0  # bits: rooms that some bin has
    for k, members in enumerate(bins):
        room = capacity - sum([lengths[i] for i in members])
        if room:
            shelves.setdefault(room, []).append(k)
            rooms |= 1 << room
    for i in order:
        need = lengths[i]
        enough = rooms >> need
        if enough:
            room = need + (enough & -enough).bit_length() - 1
            shelf = shelves[room]
            k = shelf.pop()
            if not shelf:
                rooms ^= 1 << room
            bins[k].append(i)
            room -= need
        else:
            k, room = len(bins), capacity - need
            bins.append([i])
        if room:
            shelves.setdefault(room, []).append(k)
            rooms |= 1 << room
    return bins


def least_bins(lengths: list[int], capacity: int) -> int:
    """No packing has fewer bins (Martello and Toth's second bound).

    For any k, documents over capacity - k take a bin in which no document of k
    or more fits; what the other large ones leave must hold those of k or more.
    """
    sizes = np.sort(np.array(lengths))
    total = np.concatenate([[0], np.cumsum(sizes)])
    half = int(np.searchsorted(sizes, capacity / 2, "right"))  # from here on: more than half
    at = np.concatenate([[0], np.flatnonzero(np.diff(sizes[:half])) + 1]) if half else np.array([0])
    k = np.concatenate([[0], sizes[at[at < half]]])
    begin = np.concatenate([[0], at[at < half]])
    alone = np.searchsorted(sizes, capacity - k, "right")  # from here on: over capacity - k
    alone = np.maximum(alone, half)
    room = capacity * (alone - half) - (total[alone] - total[half])
    more = np.ceil((total[half] - total[begin] - room) / capacity)
    return int((len(sizes) - half + np.maximum(0, more)).max())


class Island:
    def __init__(self, lengths: list[int], capacity: int, seed: int) -> None:
        self.lengths, self.capacity, self.luck = lengths, capacity, random.Random(seed)
        self.bound = least_bins(lengths, capacity)

    def fills(self, bins: Bins) -> list[int]:
        return [sum([self.lengths[i] for i in b]) for b in bins]

    def worth(self, bins: Bins) -> tuple[int, int]:
        """Fewer bins first, then more uneven fills."""
        return -len(bins), sum([f * f for f in self.fills(bins)])

    def by_length(self, items) -> list[int]:
        return sorted(items, key=self.lengths.__getitem__, reverse=True)

    def newcomer(self) -> Bins:
        """Best fit in nearly falling order of length."""
        blur = [n * self.luck.uniform(0.8, 1.0) for n in self.lengths]
        return best_fit(sorted(range(len(blur)), key=blur.__getitem__, reverse=True), self.lengths, self.capacity)

    def cross(self, giver: Bins, taker: Bins) -> Bins:
        filled = [b for b, f in zip(giver, self.fills(giver)) if f >= FILLED * self.capacity]
        injected = [b for b in filled if self.luck.random() < 0.5]
        inside = {i for b in injected for i in b}
        whole = [b for b in taker if inside.isdisjoint(b)]
        there = inside.union(*whole) if whole else inside
        displaced = [i for b in taker for i in b if i not in there]
        return self.refill(injected + whole, displaced)

    def refill(self, bins: Bins, loose: list[int]) -> Bins:
        """Swap bins' documents for loose ones that fill them better, then best-fit what is loose."""
        bins, loose = [list(b) for b in bins], sorted(loose, key=self.lengths.__getitem__)
        sizes = [self.lengths[i] for i in loose]
        for members in bins:
            room = self.capacity - sum([self.lengths[i] for i in members])
            if not room:
                continue
            best = gain = 0
            for place, i in enumerate(members):
                size = self.lengths[i]
                k = bisect_right(sizes, size + room) - 1
                if k >= 0 and sizes[k] - size > gain:
                    best, gain = (place, k), sizes[k] - size
            if gain:
                place, k = best
                out, into = members[place], loose.pop(k)
                sizes.pop(k)
                members[place] = into
                k = bisect_right(sizes, self.lengths[out])
                loose.insert(k, out)
                sizes.insert(k, self.lengths[out])
        return best_fit(loose[::-1], self.lengths, self.capacity, bins)

    def mutate(self, bins: Bins) -> Bins:
        """Empty the least filled bins and a few others, and best-fit what was in them."""
        fills = self.fills(bins)
        order = sorted(range(len(bins)), key=fills.__getitem__)
        emptied = {*order[: max(3, len(bins) // 20)], *self.luck.sample(range(len(bins)), min(len(bins), 4))}
        loose = [i for k in emptied for i in bins[k]]
        return self.refill([b for k, b in enumerate(bins) if k not in emptied], loose)

    def evolve(self, elites: list[Bins], population: int = POPULATION, generations: int = GENERATIONS) -> Bins:
        """The best packing after some generations, from migrated ones or from best-fit ones."""
        alive = list(elites) or [best_fit(self.by_length(range(len(self.lengths))), self.lengths, self.capacity)]
        if max(map(self.worth, alive))[0] < -self.bound:
            alive += [self.newcomer() for _ in range(population - len(alive))]
        for _ in range(generations):
            alive.sort(key=self.worth, reverse=True)
            if len(alive[0]) <= self.bound or len(alive) < 2:
                break
            giver, taker = self.luck.sample(alive[:3], 2)
            child = self.mutate(self.cross(giver, taker))
            alive = [*alive[: population - 1], child]
        return max(alive, key=self.worth)


def _bins(frame: pd.DataFrame, place: dict[int, int]) -> Bins:
    bins: dict[int, list[int]] = {}
    for row, number in zip(frame["row"], frame["bin"]):
        bins.setdefault(number, []).append(place[row])
    return list(bins.values())


def evolve_shards(items: DataFrame, capacity: int, islands: int, epochs: int) -> DataFrame:
    """(shard, island, row, length, bin): each island's best packing of its shard's items (shard, row, length)."""
    ddl = "shard bigint, island int, row bigint, length bigint, bin int, guest boolean"

    def epoch(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame[~frame["guest"]].sort_values("row")
        place = {row: i for i, row in enumerate(own["row"])}
        packed = [part for _, part in frame.groupby("guest") if (part["bin"] >= 0).all()]
        island = Island(own["length"].tolist(), capacity, hash((int(own["shard"].iat[0]), int(own["island"].iat[0]))))
        best = island.evolve([_bins(part, place) for part in packed])
        number = {i: k for k, members in enumerate(best) for i in members}
        return own.assign(bin=[number[i] for i in range(len(own))]).astype({"bin": "int32"})

    state = items.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "row", "length",
        F.lit(-1).alias("bin"), F.lit(False).alias("guest"),
    )
    for turn in range(epochs):
        if turn:
            guests = state.withColumns({"island": (F.col("island") + 1) % islands, "guest": F.lit(True)})
            state = state.union(guests)
        state = state.groupBy("shard", "island").applyInPandas(epoch, ddl)
        if turn + 1 < epochs:
            state = settle(state, "island")
    return state.drop("guest")


def settle_shards(state: DataFrame, capacity: int) -> DataFrame:
    """(shard, row, bin, offset, fill): the best island's packing of each shard."""

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        worth = {}
        for island, part in frame.groupby("island"):
            fills = part.groupby("bin")["length"].sum()
            worth[island] = (-len(fills), int((fills * fills).sum()), -int(island))
        best = frame[frame["island"] == max(worth, key=worth.get)].sort_values(["bin", "row"])
        lengths = best.groupby("bin")["length"]
        return best.assign(offset=lengths.cumsum() - best["length"], fill=lengths.transform("sum"))[
            ["shard", "row", "bin", "offset", "fill"]
        ]

    return state.groupBy("shard").applyInPandas(choose, "shard bigint, row bigint, bin int, offset bigint, fill bigint")


def pack(
    parts: DataFrame, capacity: int = CAPACITY, items: int = ITEMS, islands: int = ISLANDS, epochs: int = EPOCHS
) -> DataFrame:
    """The rows of ``parts`` (with a column length) with sequence_id and offset in as few sequences as can be."""
    columns = parts.columns
    parts = settle(parts.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = parts.where(F.col("length") >= capacity).select("row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    left = parts.where(F.col("length") < capacity).select("row", "length")
    count, level, done = left.count(), 0, [full]
    while count:
        shards = -(-count // items)
        dealt = left.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(shards)))
        chosen = settle(settle_shards(evolve_shards(dealt, capacity, islands, epochs), capacity), "packed")
        open_bins = F.col("fill") < FILLED * capacity
        rest = chosen.where(open_bins).count() if shards > 1 else 0
        last = rest * 2 > count
        closed = chosen if last or not rest else chosen.where(~open_bins)
        number = F.lit(level << 56).cast("bigint") + F.shiftleft("shard", 16) + F.col("bin")
        done.append(closed.select("row", number.alias("sequence_id"), "offset"))
        if last or not rest:
            break
        left = left.join(chosen.where(open_bins).select("row"), "row")
        count, level = rest, level + 1
    placed = done[0]
    for part in done[1:]:
        placed = placed.union(part)
    return parts.join(placed, "row").select(*columns, "sequence_id", "offset")
