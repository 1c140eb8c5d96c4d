"""A stored search index whose postings carry user and time, in blocks by time.

A posting is (term, at, user, doc_id, tf, inserted): ``at`` in seconds, ``inserted`` the day its
row was stored. Blocks are spans of ``at`` (a day by default). A batch's blocks, however many, lie
on at most ``SHELVES`` shelves of about as many postings, the folders of a ``PartTable``: a shelf holds
the blocks from the one it is named after to the batch's next shelf. Few blocks have a shelf each. Within a
file postings are sorted by term and time, so that a search opens the shelves of its dates and, in
them, the pages of its terms. Everything a search filters or sorts by is in the postings: documents
are looked up for the rows shown, if at all.

The newest hits are read shelf by shelf from the end, twice as many shelves each time, until
there are enough that are newer than all that unread shelves can hold. Indexing a day again takes the day's
earlier postings off the shelves that hold some and adds the new ones, in one commit, so that
a repeated or corrected day counts once.
"""

from __future__ import annotations

import datetime as dt
import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplekit.functions.text import term_counts, tokens
from ripplekit.operators.filters import by_ids
from ripplekit.operators.search import literal_terms
from ripplekit.session import settle
from ripplekit.sources.parts import PartTable

INDEX = "term STRING, at BIGINT, user BIGINT, doc_id BIGINT, tf INT, inserted DATE"
SPAN = 86400
SHELVES = 128


class IndexTable(PartTable):
    """Postings with their block as ``part``; in its folders the part is the shelf and the block a column."""

    def __init__(self, spark: SparkSession, path: str, shelves: int = SHELVES) -> None:
        super().__init__(spark, path, f"{INDEX}, block BIGINT", sort=("term", "at"))
        self.shelves = shelves

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """The postings of all shelves or of some."""
        return self.shelved(parts).drop("part").withColumnRenamed("block", "part")

    def shelved(self, parts: list[int] | None = None) -> DataFrame:
        """The same with the shelf as ``part`` and the block as ``block``."""
        return super().read(parts)

    def add(self, rows: DataFrame, batch: int) -> None:
        if self.is_new(batch):
            super().add(settle(rows, "postings"), batch)

    def stage(self, rows: DataFrame, batch: int) -> None:
        """Rows are read twice: to find the shelves' first blocks, and to write."""
        shares = [i / self.shelves for i in range(self.shelves)]
        least, firsts = rows.agg(F.min("part"), F.percentile_approx("part", shares)).first()
        shelf = _last_not_after(F.col("block"), sorted({least, *(firsts or [])}))
        super().stage(rows.withColumnRenamed("part", "block").withColumn("part", shelf), batch)

    def ends(self) -> dict[int, float]:
        """For each shelf a block that it surely ends before. Where a later shelf of its batch is gone, it is a later one than need be."""
        found: dict[int, float] = {}
        by_batch = sorted((batch, part) for part, batch in self.folders())
        for _, group in itertools.groupby(by_batch, lambda f: f[0]):
            parts = [part for _, part in group]
            for part, end in zip(parts, [*parts[1:], math.inf]):
                found[part] = max(end, found.get(part, end))
        return found


def _last_not_after(value: Column, sorted_values: list[int | None]) -> Column:
    """The last of the values that is not after the column's, found by halving; the first, if all are."""
    if len(sorted_values) == 1:
        return F.lit(sorted_values[0]).cast("bigint")
    half = len(sorted_values) // 2
    low, high = _last_not_after(value, sorted_values[:half]), _last_not_after(value, sorted_values[half:])
    return F.when(value < sorted_values[half], low).otherwise(high)


def index_table(spark: SparkSession, path: str) -> IndexTable:
    return IndexTable(spark, path)


def seconds(ts: str, df: DataFrame) -> Column:
    """A time column as whole seconds; numbers are seconds already."""
    kind = df.schema[ts].dataType.typeName()
    if kind == "timestamp_ntz":
        return F.timestamp_diff("SECOND", F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"), F.col(ts))
    return F.unix_seconds(ts) if kind == "timestamp" else F.col(ts).cast("bigint")


def postings(
    docs: DataFrame, doc_id: str, text: str, ts: str, user: str, inserted: str | None = None, span: int = SPAN
) -> DataFrame:
    """Postings with their block, ``part``; made inside each row. Rows without id or date are skipped."""
    counted = term_counts(tokens(F.col(text)))
    day = F.to_date(inserted) if inserted else F.lit(None).cast("date")
    rows = docs.select(
        seconds(ts, docs).alias("at"), F.col(user).cast("bigint").alias("user"), F.col(doc_id).cast("bigint").alias("doc_id"),
        day.alias("inserted"), F.explode(counted).alias("p"),
    )
    return rows.where("at IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("p.term").alias("term"), "at", "user", "doc_id", F.col("p.tf").alias("tf"), "inserted",
        F.floor(F.col("at") / span).alias("part"),
    )


def index_day(table: IndexTable, day_postings: DataFrame, day: dt.date | None, batch: int) -> None:
    """Put one insert day's postings in place of those the index has of it (None: rows never stamped)."""
    if not table.is_new(batch):
        return
    fresh = settle(day_postings.where(F.col("inserted").eqNullSafe(F.lit(day))), "day")
    same = F.col("inserted").eqNullSafe(F.lit(day).cast("date"))
    # Bounded by the number of shelves; the others stay as they are.
    touched = sorted(r[0] for r in table.shelved().where(same).select("part").distinct().collect())
    table.stage(table.read(touched).where(~same).unionByName(fresh), batch)
    table.commit(batch, touched)


def _matching(
    table: IndexTable, parts: list[int], terms: list[str], start: int | None, end: int | None, users: DataFrame | list[int] | None
) -> DataFrame:
    """(doc_id, at, user) of the hits on these shelves, once each."""
    rows = table.read(parts).where(F.col("term").isin(terms))
    if start is not None:
        rows = rows.where(F.col("at") >= start)
    if end is not None:
        rows = rows.where(F.col("at") <= end)
    if isinstance(users, DataFrame) or users:
        rows = by_ids(rows, users, "user")
    return rows.groupBy("doc_id", "at").agg(F.max("user").alias("user"))


def shelves_between(table: IndexTable, start: int | None, end: int | None, span: int = SPAN) -> dict[int, float]:
    """The shelves that may hold blocks of the dates, with the block each ends before."""
    low = None if start is None else start // span
    high = None if end is None else end // span
    return {p: e for p, e in table.ends().items() if (low is None or e > low) and (high is None or p <= high)}


def all_hits(
    table: IndexTable, q: str, start: int | None = None, end: int | None = None,
    users: DataFrame | list[int] | None = None, span: int = SPAN,
) -> DataFrame:
    """(doc_id, at, user) of every document that holds a term of ``q``."""
    terms, _ = literal_terms(table.spark, q, 1)
    return _matching(table, sorted(shelves_between(table, start, end, span)), terms, start, end, users)


def newest_hits(
    table: IndexTable, q: str, k: int, start: int | None = None, end: int | None = None,
    users: DataFrame | list[int] | None = None, offset: int = 0, span: int = SPAN,
) -> DataFrame:
    """(doc_id, at, user) of the ``k`` newest hits from ``offset`` on, newest first, ties by id."""
    terms, _ = literal_terms(table.spark, q, 1)
    ends = shelves_between(table, start, end, span)
    left = sorted(ends, key=lambda p: (ends[p], p))
    hits, count, width = None, 0, 1
    while left and count < k + offset:
        some, left = left[-width:], left[:-width]
        found = settle(_matching(table, sorted(some), terms, start, end, users), "hits")
        # Shelves of several batches overlap, so a document indexed twice may come from two of them.
        hits = found if hits is None else hits.union(found).groupBy("doc_id", "at").agg(F.max("user").alias("user"))
        # What is as new as the end of an unread shelf may not be all there is of its time.
        count, width = hits.where(F.col("at") >= ends[left[-1]] * span).count() if left else 0, width * 2
    if hits is None:
        hits = _matching(table, [], terms, start, end, None)
    return hits.orderBy(F.desc("at"), "doc_id").offset(offset).limit(k)


def with_documents(hits: DataFrame, docs: DataFrame, doc_id: str) -> DataFrame:
    """The shown hits' documents: the documents are cut to them before anything else."""
    shown = settle(hits.select(F.col("doc_id").alias("_shown")), "shown")
    return docs.join(shown, docs[doc_id] == shown["_shown"], "left_semi")
