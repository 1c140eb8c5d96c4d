"""Sinks: weekly tables, delimited and JSON reports, appended logs and counters."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplekit.functions.times import with_iso_week
from ripplekit.operators.windows import dedupe_first
from ripplekit.session import settle


def _by_week(df: DataFrame, ts: str) -> DataFrame:
    """Rows with their week, in files of even size: ``rebalance`` lets AQE split a
    week that holds far more rows than others and merge small ones."""
    return with_iso_week(df, ts).hint("rebalance", "iso_year", "iso_week")


def write_weekly(df: DataFrame, path: str, key: str = "id", ts: str = "created_at") -> None:
    """Insert rows under their creation ISO week; rows whose key the week holds already are ignored.

    Only the batch's weeks are read, and only new rows are appended, so a late row
    joins its week and a repeated batch changes nothing. A folder without files, as an empty
    first batch leaves it, is a table without rows. ``sources.parts.insert_weeks`` does the same
    with a commit for each batch, so that a half-written one is not seen.
    """
    batch = settle(with_iso_week(dedupe_first(df, [key], [ts]), ts), "weekly-batch")
    try:
        stored = df.sparkSession.read.schema(batch.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        weeks = [r[0] for r in batch.select(_week_number()).distinct().collect()]  # bounded by the calendar
        have = stored.filter(_week_number().isin(weeks)).select(F.col(key).alias("_have"))
        batch = batch.join(have, batch[key] == have["_have"], "left_anti")
    (
        batch.hint("rebalance", "iso_year", "iso_week")
        .write.mode("append").partitionBy("iso_year", "iso_week").parquet(path)
    )


def _week_number() -> Column:
    return F.col("iso_year") * 100 + F.col("iso_week")


def replace_weeks(df: DataFrame, path: str, ts: str = "created_at") -> None:
    """Write whole weeks: those that rows fall in are replaced, the others stay."""
    (
        _by_week(df, ts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("iso_year", "iso_week")
        .parquet(path)
    )


# How a backslash and line breaks are written, so that a record is one line.
CSV_ESCAPES = {"\\": "\\b", "\n": "\\n", "\r": "\\r"}
CSV_NULL = "\\N"


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """Delimited report, one line a record; nested columns are written as JSON text.

    ``read_csv`` undoes the escapes and tells null from empty text.
    """
    def written(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("array", "struct", "map"):
            c = F.to_json(c)
        elif f.dataType.typeName() != "string":
            return c
        for plain, escape in CSV_ESCAPES.items():
            c = F.replace(c, F.lit(plain), F.lit(escape))
        return c.alias(f.name)

    (
        df.select([written(f) for f in df.schema.fields])
        .write.mode("overwrite")
        .options(sep=sep, header=header, quote='"', escape='"', nullValue=CSV_NULL)
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def report_json(top: DataFrame, generated_ms: Column, k: int, order: str = "count") -> DataFrame:
    """One ``{rts: [...], dategen: ms}`` document of the report's first ``k`` rows."""
    fields = [order] + [c for c in top.columns if c != order]
    first = top.orderBy(*[F.desc(c) for c in fields]).limit(k)
    rows = F.sort_array(F.collect_list(F.struct(*fields)), asc=False)
    doc = F.struct(rows.alias("rts"), generated_ms.alias("dategen"))
    return first.agg(F.to_json(doc).alias("document"))


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_counts(counts: DataFrame, path: str, buckets: int = 64) -> None:
    """Keyed counters, laid out by key hash so that one key reads one folder."""
    (
        counts.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
        .hint("rebalance", "bucket")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(path)
    )
