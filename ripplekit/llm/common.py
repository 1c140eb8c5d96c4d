"""What the operators of this folder share: session settings, table reads and row-wise Arrow maps."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ripplekit.session import tune

# Python workers hold one Arrow batch at a time; both bounds keep that small
# whatever the length of the texts.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def session(spark: SparkSession) -> SparkSession:
    tune(spark)
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, start: Callable[[], Callable[..., Iterable[tuple]]], ddl: str) -> DataFrame:
    """Rows made from single rows.

    ``start`` is called once per task and returns the function that turns the
    values of one row into any number of output rows.
    """
    fields = to_arrow_schema(T._parse_datatype_string(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            rows = [row for values in zip(*(c.to_pylist() for c in batch.columns)) for row in work(*values)]
            columns = zip(*rows) if rows else [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, fields)], schema=fields
            )

    return df.mapInArrow(run, ddl)


def map_stream(df: DataFrame, work: Callable[[Iterator[tuple]], Iterable[tuple]], ddl: str, size: int = 8 << 20) -> DataFrame:
    """Rows made from a task's rows as they come: ``work`` is called once per task with an iterator of them.

    What it yields goes out in batches of about ``size`` bytes of text, a row at least.
    """
    fields = to_arrow_schema(T._parse_datatype_string(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = work(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        while True:
            rows, room = [], size
            for row in itertools.islice(found, 1000):
                rows.append(row)
                room -= sum(len(v) for v in row if isinstance(v, str | bytes | list))
                if room < 0:
                    break
            if not rows:
                return
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    return df.mapInArrow(run, ddl)
