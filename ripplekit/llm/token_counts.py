"""Token counts kept in a cache table under digests of the text and of the tokenizer.

Texts are joined to the cache by their digests. Of the texts without a count, one
of each digest is encoded, and the new counts are appended to the cache, a Parquet
table with a folder for each tokenizer version. Byte-level tokenizers change no
character before they split, so normalising a text is reading null as empty.

Defined results: null and empty texts have no bytes and no tokens; repeated texts
are encoded once and each row gets the count; texts are encoded whole; other
columns are ignored; an empty table gives an empty one and appends nothing.
If two runs append the same digest, the counts are equal and one is read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplekit.llm.common import map_rows
from ripplekit.llm.words import library_spaced
from ripplekit.session import settle

STORED = "digest binary, n_tokens bigint, tokenizer string"


def version(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def stored_counts(spark, cache: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer; an empty cache is made if there is none."""
    spark.createDataFrame([], STORED).write.mode("ignore").partitionBy("tokenizer").parquet(cache)
    return (
        spark.read.schema(STORED)
        .parquet(cache)
        .where(F.col("tokenizer") == tokenizer)
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )


def count_tokens(docs: DataFrame, path: str, cache: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens) of every row; the cache gains the texts it did not have."""
    spark, tokenizer = docs.sparkSession, version(path)
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest")
    missing = (
        docs.select(digest, body.alias("text"))
        .join(stored_counts(spark, cache, tokenizer), "digest", "left_anti")
        .dropDuplicates(["digest"])
    )

    def start():
        ids = library_spaced(path).ids
        return lambda row_digest, row_text: [(row_digest, len(ids(row_text)) // 4)]

    counted = map_rows(missing, start, "digest binary, n_tokens bigint")
    counted.withColumn("tokenizer", F.lit(tokenizer)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    keyed = docs.select(F.col(key), digest, F.octet_length(body).cast("bigint").alias("n_bytes"))
    # Written first: with a table on the other side Spark can split the rows of a hot text.
    known = settle(stored_counts(spark, cache, tokenizer), "counts")
    return keyed.join(known, "digest", "left").select(key, "n_bytes", "n_tokens")
