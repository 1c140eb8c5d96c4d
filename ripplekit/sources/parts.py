"""Tables of parts (key buckets, weeks, days) that batches add to or replace, each batch seen whole or not at all.

A batch writes its rows to a folder of its own, ``data/batch=N/part=P``, and then one small
file, ``commits/batch=N``, that lists the folders which are the table from now on. Readers
take the newest list and open only its folders, so parts a batch does not touch are neither read nor
written, a batch that stopped half-way is not seen, and repeating it overwrites what it left
behind. A batch whose number is committed already changes nothing. Batches come one after
the other, with rising numbers, as ``foreachBatch`` gives them. Lists are bounded by the number of
parts and of batches that added to one since it was last replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplekit.functions.times import with_iso_week
from ripplekit.operators.windows import dedupe_first
from ripplekit.session import delete_paths, settle

COMMIT = "part BIGINT, folder BIGINT"


class PartTable:
    """A table under ``path``; ``schema`` (a DDL text or a StructType) names its columns without ``part``.

    Files are sorted by the columns of ``sort``, so that filters on them skip row groups and pages.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, sort: tuple[str, ...] = ()) -> None:
        self.sort = sort
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    # Reading.

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(f"{COMMIT}, batch BIGINT").parquet(f"{self.path}/commits")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def last_batch(self) -> int | None:
        """The number of the newest committed batch."""
        commits = self._commits()
        return commits.agg(F.max("batch")).first()[0] if commits is not None else None

    def folders(self) -> list[tuple[int, int]]:
        """(part, batch) of the folders that are the table now."""
        last = self.last_batch()
        if last is None:
            return []
        found = self._commits().where((F.col("batch") == last) & F.col("part").isNotNull())
        return sorted((r.part, r.folder) for r in found.collect())

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """The table's rows, with ``part``; those of some parts only, if given."""
        return self._read([(p, b) for p, b in self.folders() if parts is None or p in set(parts)])

    def _read(self, folders: list[tuple[int, int]]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("part", T.LongType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        data = f"{self.path}/data"
        paths = [f"{data}/batch={b}/part={p}" for p, b in folders]
        reader = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
        return reader.option("basePath", data).parquet(*paths).drop("batch")

    # Writing.

    def stage(self, rows: DataFrame, batch: int) -> None:
        """Write a batch's rows (with ``part``) where nobody looks yet."""
        (
            rows.select(*self.schema.names, "part").hint("rebalance", "part").sortWithinPartitions("part", *self.sort)
            .write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/data/batch={batch}")
        )

    def commit(self, batch: int, replaced: list[int]) -> None:
        """Make a staged batch part of the table; of the replaced parts only its rows stay."""
        staged = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("part", T.LongType())]))
        parts = [r[0] for r in staged.parquet(f"{self.path}/data/batch={batch}").select("part").distinct().collect()]
        gone = set(replaced)
        now = [(p, b) for p, b in self.folders() if p not in gone] + [(p, batch) for p in parts]
        # A list without parts still has a row, so that the batch counts as committed.
        listed = self.spark.createDataFrame(sorted(now) or [(None, None)], COMMIT)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")

    def is_new(self, batch: int) -> bool:
        """False for a batch that is committed; numbers must rise."""
        last = self.last_batch()
        if last is None or batch > last:
            return True
        if self._commits().where(F.col("batch") == batch).isEmpty() and not self._tidied(batch):
            raise ValueError(f"batch {batch} comes after {last}")
        return False

    def _tidied(self, batch: int) -> bool:
        """Commits older than the oldest list kept were made: tidying keeps the newest ones only."""
        return batch < self._commits().agg(F.min("batch")).first()[0]

    def add(self, rows: DataFrame, batch: int) -> None:
        """Rows that join their parts."""
        if self.is_new(batch):
            self.stage(rows, batch)
            self.commit(batch, [])

    def replace(self, rows: DataFrame, batch: int, parts: list[int] | None = None) -> None:
        """Rows in place of all that their parts (and those listed) held."""
        if self.is_new(batch):
            self.stage(rows, batch)
            staged = self.spark.read.schema("part BIGINT").parquet(f"{self.path}/data/batch={batch}")
            self.commit(batch, sorted({*(parts or []), *(r[0] for r in staged.distinct().collect())}))

    def tidy(self) -> None:
        """Delete folders and lists that the newest list has outdated; no reader may still be using them."""
        commits, last = self._commits(), self.last_batch()
        if last is None:
            return
        old = commits.where(F.col("batch") < last)
        current = set(self.folders())
        named = {(r.part, r.folder) for r in old.where("part IS NOT NULL").select("part", "folder").distinct().collect()}
        lists = sorted(r[0] for r in old.select("batch").distinct().collect())
        delete_paths(self.spark, [f"{self.path}/data/batch={b}/part={p}" for p, b in sorted(named - current)])
        delete_paths(self.spark, [f"{self.path}/commits/batch={b}" for b in lists])


class KeyedTable(PartTable):
    """A table with unique keys, laid out by key hash in ``buckets`` parts.

    A batch rewrites only the buckets its keys fall in. Rows with a null in a key column are
    left out: they match nothing, so each run would insert them again.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: list[str], buckets: int = 256) -> None:
        super().__init__(spark, path, schema)
        self.keys, self.buckets = keys, buckets

    def bucketed(self, rows: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in self.schema.fields}
        bucket = F.pmod(F.xxhash64(*[F.col(k).cast(kinds[k]) for k in self.keys]), F.lit(self.buckets))
        return rows.dropna(subset=self.keys).withColumn("part", bucket)

    def load(self, rows: DataFrame, batch: int) -> None:
        """The table's rows, in place of all it held."""
        self.replace(self.bucketed(rows), batch, [p for p, _ in self.folders()])

    def write_back(self, rows: DataFrame, batch: int, change: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Write the table's next state, ``change(stored, rows)``, for the buckets of the batch's keys.

        ``change`` is any keyed write (``upsert``, ``insert_ignore``, ``tombstone``, ...): what becomes of
        a row may depend on its key's rows only.
        """
        if not self.is_new(batch):
            return
        rows = settle(self.bucketed(rows), "batch")
        touched = sorted(r[0] for r in rows.select("part").distinct().collect())  # at most ``buckets``
        stored = self.read(touched).select(*self.schema.names)
        self.stage(self.bucketed(change(stored, rows.drop("part"))), batch)
        self.commit(batch, touched)


def fold_log(table: KeyedTable, log: str, upto: int, change: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """Write the log's entries up to a batch back to the table, then delete them, oldest first.

    If it stops in between, entries the table has are told by ``last_batch`` and skipped by
    ``unfolded``, and folding again only deletes them.
    """
    entries = table.spark.read.parquet(log).where(F.col("batch").between(0, upto))
    last = table.last_batch()
    table.write_back(entries if last is None else entries.where(F.col("batch") > last), upto, change)
    done = sorted(r[0] for r in entries.select("batch").distinct().collect())
    delete_paths(table.spark, [f"{log}/batch={b}" for b in done])


def unfolded(table: KeyedTable, log: str) -> DataFrame:
    """The log's entries that the table does not hold yet."""
    entries, last = table.spark.read.parquet(log), table.last_batch()
    return entries if last is None else entries.where(F.col("batch") > last)


def insert_weeks(table: PartTable, rows: DataFrame, batch: int, key: str = "id", ts: str = "created_at") -> None:
    """Insert rows under their creation ISO week, ignoring keys that the week holds; seen whole once committed."""
    if not table.is_new(batch):
        return
    dated = with_iso_week(dedupe_first(rows, [key], [ts]), ts)
    dated = settle(dated.withColumn("part", F.col("iso_year").cast("bigint") * 100 + F.col("iso_week")), "batch")
    weeks = [r[0] for r in dated.select("part").distinct().collect()]  # bounded by the calendar
    have = table.read(weeks).select(F.col(key).alias("_have"))
    table.stage(dated.join(have, dated[key] == have["_have"], "left_anti"), batch)
    table.commit(batch, [])
