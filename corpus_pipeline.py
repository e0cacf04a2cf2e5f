"""The corpus pipeline: raw documents to token ids, in five stages.

Every stage works on what its predecessor kept, written as Parquet and read
again; all but the last return the columns of documents. Counted as part of
``examloom.llm``.

Odd rows, in every stage: a null or empty text is scored, masked and encoded as
an empty one (a null stays null) and is no benchmark item; rows with a null id
are judged like others but never as near-duplicates; repeated rows are judged
alike, and near-dedup leaves one of them; columns besides those of documents are
dropped, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from examloom.llm import bpe, decontaminate, quality, secrets, simhash
from examloom.llm.common import checkpoint_dir, remove_folder, table
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose score, learnt from the labelled part of them, is below one half."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, out_col="__score").where(F.col("__score") >= 0.5).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of every group of near-duplicates: operator 3's components, joined where texts are similar beyond their fingerprints."""
    return simhash.keep_one(docs, by_fingerprint=True).select(*COLUMNS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; n_chars follows the masked text."""
    masked = secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))
    return masked.select(*COLUMNS)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them: a text that does not come back is an error."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    ids = F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("decoded text differs from the encoded one")).cast("array<int>"))
    return both.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids"))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("secrets", secrets_stage),
    ("encode", encode_stage),
]

#: No stage but the secret scan can be expressed in SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What each but the last returns is written to the shared checkpoint folder and read again; the one before it is then deleted."""
    folder = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
