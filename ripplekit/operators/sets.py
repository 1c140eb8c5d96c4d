"""Set operations over tables and id lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_weeks(frames: list[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def tag_worklist(df: DataFrame, state: str, kind: str | None = None) -> DataFrame:
    """An id list as ``(id, type, state)`` worklist rows."""
    return df.select("id", F.col("type") if kind is None else F.lit(kind).alias("type"), F.lit(state).alias("state"))


def merge_id_files(frames: list[DataFrame]) -> DataFrame:
    """Distinct ids of several lists (a report sorts them when it is written)."""
    return union_all([f.toDF("id") for f in frames]).distinct()


def minus(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    return wanted.select("id").subtract(stored.select("id"))
