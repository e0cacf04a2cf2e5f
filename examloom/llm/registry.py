"""Registered queries of the corpus operators, one per operator, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, licenses, order_minhash, quality, secrets, simhash, suffixes, tokens, urls
from .common import spread, table

Query = Callable[[SparkSession, str], DataFrame]

CONTEXT_TOKENS = 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and whole texts of all documents."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of every document: how many matches, the best covered one, and all of them as name:start:end (places in words)."""
    found = licenses.scan(documents(spark, sf_dir))
    best = F.element_at(F.array_sort(F.transform("licenses", lambda m: F.struct((-m["coverage"]).alias("worst"), (-m["matched"]).alias("fewest"), m["license"].alias("license")))), 1)
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_matches"),
        F.when(F.size("licenses") > 0, best["license"]).alias("license"),
        F.when(F.size("licenses") > 0, -best["worst"]).alias("coverage"),
        F.array_join(F.transform("licenses", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string"))), ",").alias("matches"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in 400-byte strings found elsewhere, and the digest of what remains."""
    found = suffixes.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document and the component of near-duplicates it belongs to."""
    found = simhash.with_components(documents(spark, sf_dir))
    return found.select("doc_id", simhash.written(F.col("simhash")).alias("fingerprint"), "component_id")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base spans, and all spans."""
    docs = documents(spark, sf_dir)
    found = secrets.scan(docs)
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.written(secrets.base(F.col("secrets"))), 256).alias("base_sha256"),
        secrets.written(F.col("secrets")).alias("spans"),
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents: one row for each contaminated document and item."""
    found = decontaminate.with_hits(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.item_id", "hit.coverage", "hit.tiles", "hit.first_word")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from labels outside the held-out third."""
    docs = documents(spark, sf_dir)
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id",
        F.coalesce(quality.remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 32k piece vocabulary, and whether they exceed a 4096-token context."""
    docs = documents(spark, sf_dir)
    counted = tokens.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > CONTEXT_TOKENS).alias("over_limit"),
    )


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document under the 50k byte vocabulary and the text decoded from them, as digests."""
    docs = documents(spark, sf_dir)
    both = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.default_model()).drop("url")


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash of every document and of its edited text, compared with each other and with the next document."""
    return order_minhash.with_next(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_simhash": op3_simhash,
    "op4_secret_scan": op4_secret_scan,
    "op5_decontaminate": op5_decontaminate,
    "op6_quality": op6_quality,
    "op7_token_counts": op7_token_counts,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_url_filter": op9_url_filter,
    "op10_order_minhash": op10_order_minhash,
}

ORACLE_SQL: dict[str, str] = {
    "op9_url_filter": urls.judge_sql(urls.default_model()),
}
