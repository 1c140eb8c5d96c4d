"""Scans: API dumps, CSV, id lists, feeds, weekly tables and per-network tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplekit.functions.times import parse_pubdate
from ripplekit.operators.filters import by_insert_date
from ripplekit.sources.writers import CSV_ESCAPES, CSV_NULL

# API error-code prefixes after which a record is given up.
FATAL_ERROR_CODES = ["40302", "40023", "40031"]

RSS_ITEM_SCHEMA = (
    "title STRING, link STRING, guid STRING, description STRING, author STRING, "
    "comments STRING, category STRING, pubDate STRING"
)


def read_payloads(spark: SparkSession, path: str, schema: str, whole_file: bool = False) -> DataFrame:
    """JSON dumps whose documents are one object or an array of objects.

    One document per line splits across tasks; ``whole_file`` is for dumps with
    one document spread over a file.  Unreadable records are dropped.
    """
    return (
        spark.read.schema(f"{schema}, _corrupt STRING")
        .option("multiLine", whole_file)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(path)
        .filter(F.col("_corrupt").isNull())
        .drop("_corrupt")
    )


def split_errors(df: DataFrame, columns: tuple[str, ...] = ("error",)) -> tuple[DataFrame, DataFrame]:
    """Rows without an error, and error records marked ``fatal`` or not.

    ``columns`` are the fields a network reports errors in, first one set wins.
    """
    error = F.coalesce(*columns)
    ok = df.filter(error.isNull()).drop(*columns)
    code = F.substring(error, 1, 5)
    errors = df.filter(error.isNotNull()).select(
        "*", code.alias("error_code"), code.isin(FATAL_ERROR_CODES).alias("fatal")
    )
    return ok, errors


def _csv(
    spark: SparkSession, path: str, schema: str, header: bool, sep: str, multi_line: bool
) -> tuple[DataFrame, list[T.StructField]]:
    fields = T._parse_datatype_string(schema).fields
    # Files of write_csv double a quote and have no line breaks; foreign ones may escape it and may have them.
    own = {} if multi_line else {"nullValue": CSV_NULL}
    raw = (
        spark.read.schema(f"{schema}, _corrupt STRING")
        .options(header=header, sep=sep, quote='"', escape="\\" if multi_line else '"', multiLine=multi_line)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", **own)
        .csv(path)
    )
    return raw, fields


def _all_asked(fields: list[T.StructField]) -> Column:
    """Always true, of all columns: the reader notices a bad field only where the field is asked for."""
    return F.greatest(F.lit(0), *[F.isnull(f"`{f.name}`").cast("int") for f in fields]) >= 0


def read_csv(
    spark: SparkSession, path: str, schema: str, header: bool = True, sep: str = ",", multi_line: bool = False
) -> DataFrame:
    """Records of files that ``write_csv`` made, one a line, so that files split.

    ``multi_line`` reads foreign files, whose quoted fields may hold line breaks
    and backslash escapes; such a file is one task.  Records that cannot be read
    are left to ``unreadable_csv``.
    """
    raw, fields = _csv(spark, path, schema, header, sep, multi_line)

    def value(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if multi_line or f.dataType.typeName() != "string":
            return c
        for plain, escape in reversed(CSV_ESCAPES.items()):
            c = F.replace(c, F.lit(escape), F.lit(plain))
        return c.alias(f.name)

    return raw.filter(F.col("_corrupt").isNull() & _all_asked(fields)).select([value(f) for f in fields])


def unreadable_csv(
    spark: SparkSession, path: str, schema: str, header: bool = True, sep: str = ",", multi_line: bool = False
) -> DataFrame:
    """The records, as text, that ``read_csv`` leaves out."""
    raw, fields = _csv(spark, path, schema, header, sep, multi_line)
    return raw.filter(F.col("_corrupt").isNotNull() & _all_asked(fields)).select(F.col("_corrupt").alias("record"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One id per line: the whole line, else its first CSV field, else skipped."""
    whole = F.trim("value").try_cast("bigint")
    first = F.trim(F.split_part("value", F.lit(","), F.lit(1))).try_cast("bigint")
    return spark.read.text(path).select(F.coalesce(whole, first).alias("id")).filter("id IS NOT NULL")


def _rss_items(df: DataFrame, xml: str) -> DataFrame:
    items = F.regexp_extract_all(F.col(xml), F.lit(r"(?s)(<item\b.*?</item>)"), F.lit(1))
    keep = [c for c in df.columns if c != xml]

    def once(value: Column) -> Column:
        """Out of a generator, so that filters and fields further up do not copy the parsing."""
        return F.explode(F.array(value))

    return (
        df.select(*keep, F.explode(items).alias("item"))
        .select(*keep, once(F.from_xml("item", RSS_ITEM_SCHEMA)).alias("item"))
        .select(*keep, "item.*")
        .withColumnRenamed("pubDate", "written")
        .select("*", once(parse_pubdate(F.col("written"))).alias("pubdate"))
    )


def read_rss(df: DataFrame, xml: str) -> DataFrame:
    """One row per dated ``<item>`` of a feed column; other columns are kept.

    ``pubdate`` is in UTC; items without a readable date are ``undated_items``.
    """
    return _rss_items(df, xml).filter("pubdate IS NOT NULL").drop("written")


def undated_items(df: DataFrame, xml: str) -> DataFrame:
    """The items ``read_rss`` leaves out, with their date as ``written``."""
    return _rss_items(df, xml).filter("pubdate IS NULL").drop("pubdate")


def _iso_key(year: Column, week: Column) -> Column:
    return year * 100 + week


def in_iso_weeks(start: dt.datetime, end: dt.datetime) -> Column:
    """Every ISO week that intersects the period, across year ends."""
    first, last = start.isocalendar(), end.isocalendar()
    key = _iso_key(F.col("iso_year"), F.col("iso_week"))
    return key.between(first[0] * 100 + first[1], last[0] * 100 + last[1])


def scan_period(
    weekly: DataFrame, start: dt.datetime, end: dt.datetime, columns: list[str]
) -> DataFrame:
    """Weeks overlapping the period; on a weekly-partitioned table the filter
    touches partition columns only, so other weeks are never listed or read."""
    return weekly.filter(in_iso_weeks(start, end)).select(*columns)


def scan_network(
    tables: dict[str, DataFrame], network: str, day: dt.date | None, inserted: str = "dbinserted"
) -> DataFrame:
    """Posts of one network inserted on ``day`` (or never stamped when None)."""
    return by_insert_date(tables[network], day, inserted).withColumn("network", F.lit(network))
