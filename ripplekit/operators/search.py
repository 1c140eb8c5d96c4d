"""Text search over a postings table ``(term, doc_id, tf)``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplekit.functions.text import page_range, term_counts, tokens
from ripplekit.operators.filters import by_ids, by_insert_date
from ripplekit.session import settle

# Folders of a stored index; a reader must use the writer's number.
BUCKETS = 256


def with_tokens(df: DataFrame, column: str, name: str = "token_set") -> DataFrame:
    """Keep the row's distinct tokens next to its text."""
    return df.withColumn(name, F.array_sort(F.array_distinct(tokens(F.col(column)))))


def build_postings(docs: DataFrame, doc_id: str, text: str, keep: tuple[str, ...] = (), spread: int | None = None) -> DataFrame:
    """One row per (term, document) with its count; counted inside each row, so
    the build is a single narrow stage over the documents.

    ``spread`` deals the documents to so many tasks first, for tables of fewer row groups than cores."""
    if spread:
        docs = docs.select(doc_id, *keep, text).repartition(spread)
    counted = term_counts(tokens(F.col(text)))
    return docs.select(F.col(doc_id).alias("doc_id"), *keep, F.explode(counted).alias("p")).select(
        F.col("p.term").alias("term"), "doc_id", *keep, F.col("p.tf").alias("tf")
    )


def write_postings(postings: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "append") -> None:
    """Append postings laid out by term hash; a frequent term's folder gets as
    many files as AQE needs to keep tasks even."""
    (
        postings.withColumn("term_bucket", term_bucket(F.col("term"), buckets))
        .hint("rebalance", "term_bucket")
        .sortWithinPartitions("term_bucket", "term")
        .write.mode(mode)
        .partitionBy("term_bucket")
        .parquet(path)
    )


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def index_rows(docs: DataFrame, doc_id: str, text: str, ts: str) -> DataFrame:
    """Postings of any selection of rows (a day, a week, listed ids, a CSV);
    rows without a usable date are skipped."""
    return build_postings(docs.filter(F.col(ts).isNotNull()), doc_id, text, (ts,))


def index_increment(
    docs: DataFrame, doc_id: str, text: str, ts: str, day: dt.date | None, inserted: str = "dbinserted"
) -> DataFrame:
    """Postings of one insert date (None: rows never stamped)."""
    return index_rows(by_insert_date(docs, day, inserted), doc_id, text, ts)


def index_ids(docs: DataFrame, ids: list[int] | DataFrame, doc_id: str, text: str, ts: str) -> DataFrame:
    """Postings of the listed rows."""
    return index_rows(by_ids(docs, ids, doc_id), doc_id, text, ts)


def query_terms(q: str) -> Column:
    return F.array_distinct(tokens(F.lit(q)))


def literal_terms(spark: SparkSession, q: str, buckets: int) -> tuple[list[str], list[int]]:
    """The query's terms and their folders, as values: the text is tokenised once, by the index's own rule."""
    row = spark.range(1).select(query_terms(q).alias("t")).select(
        "t", F.transform("t", lambda x: term_bucket(x, buckets)).alias("b")
    ).first()
    return row["t"], sorted(set(row["b"]))


def match_any(postings: DataFrame, q: str, buckets: int = BUCKETS) -> DataFrame:
    """Ids of documents holding a query term, once per term they hold.

    On a stored index only the terms' folders are listed, and in them only row
    groups that may hold a term are read.
    """
    terms, folders = literal_terms(postings.sparkSession, q, buckets)
    if "term_bucket" in postings.columns:
        postings = postings.filter(F.col("term_bucket").isin(folders))
    return postings.filter(F.col("term").isin(terms)).select("doc_id")


def _time_range(docs: DataFrame, ts: str, start: object, end: object) -> DataFrame:
    """Each bound that is given, inclusive."""
    if start is not None:
        docs = docs.filter(F.col(ts) >= F.lit(start))
    if end is not None:
        docs = docs.filter(F.col(ts) <= F.lit(end))
    return docs


def top_hits(hits: DataFrame, ts: str, tie: str, k: int | None, offset: int = 0) -> DataFrame:
    """Newest hits, all or ``k`` from ``offset`` on, each with the number of all hits.

    The hits are written once and then counted and ranked from there, so the
    search itself runs once.
    """
    hits = settle(hits, "hits")
    total = hits.agg(F.count("*").alias("n")).scalar()
    page = hits.orderBy(F.desc(ts), tie).offset(offset) if offset else hits.orderBy(F.desc(ts), tie)
    return (page if k is None else page.limit(k)).withColumn("total_hits", total)


def search(
    postings: DataFrame | None,
    docs: DataFrame,
    q: str,
    start: object = None,
    end: object = None,
    user_ids: list[int] | DataFrame | None = None,
    k: int | None = None,
    doc_id: str = "id",
    user: str = "user_id",
    ts: str = "created_at",
    offset: int = 0,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Documents matching any term of ``q`` in a date range and user set, newest
    first.  An empty ``q`` lists by range only, and an empty user list filters
    no user.  The postings are cut to the query's terms before the semi join."""
    rows = _time_range(docs, ts, start, end)
    if isinstance(user_ids, DataFrame) or user_ids:
        rows = by_ids(rows, user_ids, user)
    if q:
        matched = match_any(postings, q, buckets)
        rows = rows.join(matched, rows[doc_id] == matched["doc_id"], "left_semi")
    return top_hits(rows, ts, doc_id, k, offset)


def search_forum(
    postings: DataFrame | None,
    posts: DataFrame,
    q: str,
    start: int | None = None,
    end: int | None = None,
    floor: str | None = None,
    uids: list[int] | None = None,
    k: int | None = None,
    offset: int = 0,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Forum posts by words, time, floor range (``"3-7"`` or ``"3"``) and users."""
    rows = posts
    if floor:
        span = page_range(F.lit(floor))
        rows = rows.filter(F.col("floor").between(span["first"], span["last"]))
    shown = rows.select("pid", "uid", "tid", "time_secs")
    return search(postings, shown, q, start, end, uids, k, "pid", "uid", "time_secs", offset, buckets)
