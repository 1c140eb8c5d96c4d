"""Nearest vectors by counting collisions on single random projections.

Rows are dealt into blocks by hash. In a block each of the projections keeps its
values sorted. A query opens a window around its own value on every projection;
the windows widen together, as wider buckets would (virtual rehashing), and each
vector that enters one is counted. Vectors counted on enough projections are
verified by their exact distance. With window ``WIDTH`` times the radius, a vector
within the radius lies in a window with probability 0.73 and is counted 17 times
of 32 with probability 0.99, so a block's search ends when its k-th verified
distance is within the radius. Blocks of queries meet all blocks of rows, and the
best of each block are ranked for the query.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without an id; vectors of different lengths
are not compared. Distances of finite vectors beyond the largest double are infinite and rank last. Ties go to the smaller id, repeated rows are candidates each but
ask once, fewer than k candidates are all returned, other columns are ignored, and
an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 32
COLLISIONS = 17
WIDTH = 2.2
GROWTH = 1.4
#: Share of a block's values in the first windows: nearest vectors in many dimensions lie far out on each line.
FIRST = 8
ROWS, QUERIES = 8192, 1024
#: Tables with larger components are projected on a smaller scale, so that no projection overflows.
LARGE = 1e100
#: Squares of such distances are too small for a double.
SMALL = 1e-140


class CollisionIndex:
    """One block of vectors with a sorted array for each projection."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, scale: float = 1.0, seed: int = 11) -> None:
        self.ids, self.vectors, self.scale = ids, vectors, scale
        self.lines = np.random.default_rng(seed).normal(size=(vectors.shape[1], PROJECTIONS))
        values = (vectors / scale) @ self.lines
        self.order = [np.argsort(values[:, j], kind="stable") for j in range(PROJECTIONS)]
        self.sorted = [values[o, j] for j, o in enumerate(self.order)]

    def search(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, float]]:
        """The k nearest verified (id, distance), nearest first."""
        size = len(self.ids)
        centre = (query / self.scale) @ self.lines
        low = [int(np.searchsorted(s, c)) for s, c in zip(self.sorted, centre)]
        high = list(low)
        own = self.ids == query_id
        counts, seen = np.zeros(size, dtype=np.int16), own.copy()
        distances, scaled = np.full(size, np.inf), np.full(size, np.inf)
        radius = self._first_radius(centre, k)
        while True:
            half = WIDTH * radius / 2
            for j, (values, order, c) in enumerate(zip(self.sorted, self.order, centre)):
                left, right = np.searchsorted(values, (c - half, c + half))
                left, right = min(int(left), low[j]), max(int(right), high[j])
                counts[order[left : low[j]]] += 1
                counts[order[high[j] : right]] += 1
                low[j], high[j] = left, right
            everything = high[0] - low[0] == size and all(h - lo == size for h, lo in zip(high, low))
            new = np.flatnonzero((counts >= (0 if everything else COLLISIONS)) & ~seen)
            if len(new):
                seen[new] = True
                distances[new] = exact(self.vectors[new], query)
                scaled[new] = distances[new] if self.scale == 1.0 else exact(self.vectors[new] / self.scale, query / self.scale)
            found = int(np.count_nonzero(scaled <= radius))
            if found >= k or everything:
                break
            radius *= GROWTH
        reached = np.flatnonzero(seen & ~own)
        best = reached[np.lexsort((self.ids[reached], distances[reached]))[:k]]
        return [(int(self.ids[i]), float(distances[i])) for i in best]

    def _first_radius(self, centre: np.ndarray, k: int) -> float:
        """Where the windows hold a few times k values each, or a share of all, or the smallest step above zero."""
        nth = min(len(self.ids) - 1, max(4 * k, len(self.ids) // FIRST))
        gaps = [np.partition(np.abs(s - c), nth)[nth] for s, c in zip(self.sorted, centre)]
        widest = max(max(abs(s[0] - c), abs(s[-1] - c)) for s, c in zip(self.sorted, centre))
        return max(float(np.median(gaps)) / WIDTH, 1e-9 * float(widest), 1e-300)


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Distances; where squares would leave the doubles, from scaled differences. What is too large for a double is infinite."""
    with np.errstate(over="ignore", invalid="ignore"):
        found = np.sqrt(np.square(vectors - query).sum(axis=1))
        wide = ~np.isfinite(found)
        if wide.any():
            largest = np.maximum(np.abs(vectors[wide]).max(axis=1), np.abs(query).max())
            apart = vectors[wide] / largest[:, None] - query / largest[:, None]
            found[wide] = largest * np.sqrt(np.square(apart).sum(axis=1))
        close = found < SMALL
        if close.any():
            apart = vectors[close] - query
            largest = np.maximum(np.abs(apart).max(axis=1), 5e-324)
            found[close] = largest * np.sqrt(np.square(apart / largest[:, None]).sum(axis=1))
    return found


def usable(vector: str) -> Column:
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))


def nearest(
    rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, key, score): the k nearest rows of each query row but itself, by Euclidean distance."""
    known = rows.where(F.col(key).isNotNull() & usable(vector)).select(
        F.col(key).cast("bigint").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.size(vector).alias("dim"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    largest = F.max(F.array_max(F.transform("vector", F.abs)))
    sizes = known.agg(F.count("*").alias("n"), F.count_if("asks").alias("q"), largest.alias("largest")).first()
    scale = sizes.largest if sizes.n and sizes.largest > LARGE else 1.0
    row_blocks, query_blocks = max(1, -(-sizes.n // ROWS)), max(1, -(-sizes.q // QUERIES))
    row_block = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(row_blocks))  # repeated rows part as well
    query_block = F.pmod(F.xxhash64("id", "vector", F.lit(1)), F.lit(query_blocks))
    every = lambda n, name: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1))).alias(name)
    asking = known.where("asks").select("id", "vector", "dim").distinct()
    asked = asking.select("*", query_block.alias("q"), every(row_blocks, "r"))
    dealt = known.select("id", "vector", "dim", every(query_blocks, "q"), row_block.alias("r"))

    def search(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(block):
            index = CollisionIndex(block["id"].to_numpy(), np.stack(block["vector"].to_numpy()), scale)
            for query_id, query in zip(queries["id"], queries["vector"]):
                out += [(query_id, *hit) for hit in index.search(query_id, np.asarray(query), k)]
        return pd.DataFrame(out, columns=["query_id", "id", "score"]).astype(
            {"query_id": "int64", "id": "int64", "score": "float64"}
        )

    keys = ["dim", "q", "r"]
    hits = (
        asked.groupBy(*keys).cogroup(dealt.groupBy(*keys))
        .applyInPandas(search, "query_id bigint, id bigint, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
