"""Near-duplicate texts by 64-bit similarity hashes, searched in BK-trees.

Each distinct fingerprint goes to several shards: the 64 bits are cut into
``radius + 2`` blocks, and two fingerprints with at most ``radius`` differing bits
agree on at least two blocks, so a shard holds the fingerprints that agree on a
given pair of blocks. A task reads its shards sorted, one at a time, plants a
BK-tree (children keyed by their Hamming distance to the parent) and walks from
fingerprint to fingerprint along links, entering only the subtrees whose distance
lies within the radius and that still hold one not yet reached. What it reaches
is written as one link each to the smallest, never as all pairs, and the links of
all shards are joined into components by Spark joins.

Defined results: a text without words (null, empty) has fingerprint zero, which
links like any other; repeated rows and equal texts share a fingerprint; whole
texts are read; other columns are ignored; an empty table gives an empty one. Rows
whose key is null get their component's smallest key, null if there is none.
"""

from __future__ import annotations

import itertools
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.llm.common import map_rows, map_stream
from ripplekit.session import Scratch, settle

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
NODES = 1 << 18  # linked in a task's memory at a time
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """A bit is set where over half of the shingles' hashes have it; A-Z count as a-z."""
    found = text.encode().lower().split() if text else []  # bytes: ASCII letters and white space only
    if not found:
        return 0
    if len(found) < words:
        return _hash(b" ".join(found))
    runs = zip(*(found[i:] for i in range(words)))
    count = len(found) - words + 1
    total = np.zeros(BITS, dtype=np.int64)
    while block := list(itertools.islice(runs, 65536)):
        hashes = np.fromiter(map(_hash, map(b" ".join, block)), dtype=">u8", count=len(block))
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > count).tobytes(), "big")


class BkTree:
    """Fingerprints not yet reached: nodes [value, children by distance, left in the subtree, left itself, parent]."""

    def __init__(self, values) -> None:
        values = iter(values)
        self.root = [next(values), {}, 1, True, None]
        for value in values:
            node = self.root
            while True:
                node[2] += 1
                apart = (node[0] ^ value).bit_count()
                below = node[1].get(apart)
                if below is None:
                    node[1][apart] = [value, {}, 1, True, node]
                    break
                node = below

    def take(self, value: int, radius: int) -> list[int]:
        """Remove and return what is left within the radius."""
        found, stack = [], [self.root]
        while stack:
            node = stack.pop()
            apart = (node[0] ^ value).bit_count()
            if node[3] and apart <= radius:
                node[3] = False
                found.append(node)
            stack += [child for d, child in node[1].items() if child[2] and -radius <= d - apart <= radius]
        for node in found:
            while node:
                node[2] -= 1
                node = node[4]
        return [node[0] for node in found]


def linked(values: list[int], radius: int, direct: bool = False) -> list[tuple[int, int]]:
    """(member, smallest) of every component of two or more among distinct fingerprints.

    ``direct`` gives (member, the one it was reached from), which are within the radius of each other.
    """
    if len(values) == 2:
        a, b = sorted(values)
        return [(b, a)] if (a ^ b).bit_count() <= radius else []
    tree, links = BkTree(values), []
    reached: set[int] = set()
    for seed in sorted(values):
        if seed in reached:
            continue
        group = tree.take(seed, radius)
        links += [(value, seed) for value in group if value != seed]
        for value in group:  # grows while it is walked
            if value != seed:
                more = tree.take(value, radius)
                links += [(other, value if direct else seed) for other in more]
                group += more
        reached.update(group)
    return links


def shard_links(fingerprints: DataFrame, radius: int = RADIUS, direct: bool = False) -> DataFrame:
    """(a, b): links that join up, shard by shard, the fingerprints (column ``fp``) of each component; b is smaller.

    ``direct`` gives links within the radius only, either end the smaller.
    """
    blocks = radius + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    value = F.col("fp")

    def block(i: int) -> Column:
        return F.shiftrightunsigned(value, edges[i]).bitwiseAND(F.lit((1 << edges[i + 1] - edges[i]) - 1))

    keys = [
        F.shiftleft(F.lit(n).cast("bigint"), 48) + F.shiftleft(block(i), 24) + block(j)
        for n, (i, j) in enumerate(itertools.combinations(range(blocks), 2))
    ]
    dealt = fingerprints.select("fp", F.explode(F.array(*keys)).alias("shard"))
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "fp")

    def run(batches):
        shards, values = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                shards = np.concatenate([shards, batch.column(0).to_numpy()])
                values = np.concatenate([values, batch.column(1).to_numpy()])
            if not len(shards):
                continue
            first = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]])
            size = np.diff(np.r_[first, len(shards)])
            done = len(first) - (batch is not None)  # the last shard may go on in the next batch
            links = []
            for k in np.flatnonzero(size[:done] > 1):
                links += linked(values[first[k] : first[k] + size[k]].view(np.uint64).tolist(), radius, direct)
            keep = first[done] if done < len(first) else len(shards)
            shards, values = shards[keep:], values[keep:]
            pairs = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return dealt.select("shard", "fp").mapInArrow(run, "a bigint, b bigint").distinct()


def contracted(links: DataFrame, most: int = NODES) -> DataFrame:
    """Links (a, b) that join up what these do: those of a task, ``most`` nodes at a time, as stars around the smallest node."""

    def work(rows):
        above: dict[int, int] = {}

        def top(node):
            while (up := above.setdefault(node, node)) != node:
                above[node], node = above[up], up
            return node

        def stars():
            return [(node, least) for node in above if (least := top(node)) != node]

        for a, b in rows:
            one, two = top(a), top(b)
            above[max(one, two)] = min(one, two)
            if len(above) >= most:
                yield from stars()
                above.clear()
        yield from stars()

    return map_stream(links.select("a", "b"), work, "a bigint, b bigint")


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, root): the smallest node reachable over the links (a, b), by large and small stars.

    Each round contracts the links of every task, then joins every node's larger neighbours, then its smaller
    ones, to the smallest. What it writes to the shared folder, the next round deletes; ``scratch`` holds the last
    ``links``, which the result reads. It ends when every node has one link, to a node that has none of its own.
    """
    scratch = scratch or Scratch(links.sparkSession)

    def stars(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.union(edges.select("b", "a")) if larger else edges
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        if larger:  # the smallest node of a large component has all its links; beside a table Spark can split them
            least = scratch.keep(least, "least")
        joined = both.join(least, "a")
        if larger:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        return moved.where("a != b").distinct()

    def unfinished(edges: DataFrame) -> bool:
        ends = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
        nodes = ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        left = scratch.keep(nodes.where("up > 1 OR (up = 1 AND down = 1)").select("a"), "left")  # written, so that its shuffle goes
        found = not left.isEmpty()
        scratch.forget("left")
        return found

    def written(edges: DataFrame) -> DataFrame:
        edges = scratch.keep(edges, "links")
        scratch.forget("least")
        scratch.forget("links", last=1)
        return edges

    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    while unfinished(edges := written(contracted(edges))):
        edges = written(stars(stars(edges, True), False))
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, words: int = SHINGLE, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, fp, component_id): the fingerprint, as a signed long, and the smallest key of its component."""

    def start():
        def work(row_key, row_text):
            value = fingerprint(row_text, words)
            yield row_key, value - (1 << BITS) if value >> (BITS - 1) else value

        return work

    kind = docs.schema[key].dataType.simpleString()
    marked = settle(map_rows(docs.select(key, text), start, f"`{key}` {kind}, fp bigint"), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min(key).alias("least"))
    roots = components(shard_links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    # Written first: with a table on the other side Spark can split the rows of a large component.
    least = settle(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(key, "fp", "component_id")
