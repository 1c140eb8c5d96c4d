"""Registration of queries and their checking SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplekit.plans.roles import Roles, oracle
from ripplekit.session import tune

AS_OF = dt.datetime(2024, 1, 31)
START = dt.datetime(2024, 1, 5)
END = dt.datetime(2024, 1, 25)
BEFORE = dt.datetime(2024, 1, 20)

REGISTRY: dict[str, tuple[Callable[[Roles], DataFrame], str | None]] = {}


def query(key: str, sql: str | None = None):
    def register(fn: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
        if key in REGISTRY:
            raise KeyError(f"{key} registered twice")
        REGISTRY[key] = (fn, sql)
        return fn

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Roles], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Roles(tune(spark), sf_dir))

    return {key: bind(fn) for key, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {key: oracle(sql) for key, (_, sql) in REGISTRY.items() if sql}


def ntz(value: dt.datetime | dt.date) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def api_date(ts: str) -> Column:
    """Timestamp in the API's text form."""
    return F.concat(
        F.date_format(ts, "EEE MMM dd HH:mm:ss"), F.lit(" +0800 "), F.date_format(ts, "yyyy")
    )


def joined(items: Column) -> Column:
    """An array as comparable text; null items as ``~``."""
    return F.concat_ws(
        ",", F.transform(items, lambda x: F.coalesce(x.cast("string"), F.lit("~")))
    )
