"""Session settings and the shared folder jobs may write intermediate tables to."""

from __future__ import annotations

import contextlib
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on.  UTC keeps ``timestamp_ntz``
# conversions free of daylight-saving gaps; the skew settings let AQE split a
# hot join key without operator-side salting.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ripplekit")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory under the cluster's shared folder.

    The cluster names the folder in ``spark.checkpoint.dir``.  Where it is unset,
    as in tests, a local master, whose driver and executors are one process, gets
    a temporary folder.
    """
    return f"{_application_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def _application_dir(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/ripplekit-{spark.sparkContext.applicationId}"


def forget_intermediates(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder; call it when its results are stored."""
    delete_paths(spark, [_application_dir(spark)])


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of any file system Spark can reach, in the order given; missing ones are no error."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run within delete their shuffle files as they end, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class Scratch:
    """Settled tables whose folders go when they are not needed any more, and whose shuffle files go at once."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it again; ``name`` may be written anew, and is then another folder."""
        path = shared_dir(self.spark, name)
        with shuffles_freed(self.spark):
            df.write.parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def forget(self, *names: str, last: int = 0) -> None:
        """Delete these tables' folders but the ``last`` ones."""
        for name in names:
            held = self.paths.get(name, [])
            gone = held[: len(held) - last]
            delete_paths(self.spark, gone)
            self.paths[name] = held[len(gone) :]


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="ripplekit-")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a small intermediate result (a top-k list) once and read it back.

    It is then computed once however often the plan uses it, does not depend on
    executors staying alive, and has an exact size for join planning.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
