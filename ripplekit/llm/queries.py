"""The registered queries of this folder, over whole tables, and checking SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplekit.llm import (
    bpe_automaton,
    conversations,
    language_id,
    main_text,
    neighbours,
    packing,
    phrases,
    quality,
    secret_scan,
    sharding,
    simhash,
    token_counts,
    url_filter,
)
from ripplekit.llm.common import table
from ripplekit.llm.sql import conversations_sql, phrases_sql
from ripplekit.session import shared_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
LONG = 1024


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.BASE]
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    found = language_id.predict_language(docs, network)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_automaton.encode(table(spark, sf_dir, "documents"), BYTE_BPE)
    decoded = bpe_automaton.decode(encoded, BYTE_BPE)
    return decoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(table(spark, sf_dir, "documents"), WORD_BPE, with_ids=False)
    return packing.pack(parts)


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache of its own for each call, so that every distinct text is encoded once."""
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, BYTE_BPE, shared_dir(spark, "token-counts"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LONG)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents")).drop("lang", "source")


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_text(table(spark, sf_dir, "pages"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_secret_scan, op2_url_filter, op3_language_id, op4_bpe_codec, op5_packing, op6_neighbours, op7_simhash,
        op8_sharding, op9_token_counts, op10_quality, op11_main_text, op12_phrases, op13_conversations, pipeline,
    )
    return {f.__name__: f for f in named}


def _url_sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    sites = sorted(url_filter.SITES, key=lambda s: -len(s.name))
    fits = [
        f"(host = {quoted(s.host)} OR ends_with(host, {quoted('.' + s.host)})) AND starts_with(path, {quoted(s.path)})"
        for s in sites
    ]
    case = lambda values: "CASE " + " ".join(f"WHEN {f} THEN {v}" for f, v in zip(fits, values)) + " END"
    patterns = sorted(url_filter.PATTERNS, key=lambda p: (p.verdict, p.name))
    matched = "CASE " + " ".join(
        f"WHEN regexp_matches(host || path, {quoted(p.pattern)}) THEN {quoted(p.name)}" for p in patterns
    )
    blocking = ", ".join(quoted(p.name) for p in patterns if p.verdict == "block")
    return f"""
    WITH cut AS (
      SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (
      SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    judged AS (
      SELECT *, {case([quoted(s.name) for s in sites])} AS rule, {case([quoted(s.verdict) for s in sites])} AS said,
             {matched} END AS fitted FROM split)
    SELECT page_id, host, path, rule,
           coalesce(said, CASE WHEN fitted IN ({blocking}) THEN 'block' END, 'allow') AS verdict,
           CASE WHEN rule IS NULL THEN fitted END AS pattern
    FROM judged"""


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": _url_sql(), "op12_phrases": phrases_sql(), "op13_conversations": conversations_sql()}
