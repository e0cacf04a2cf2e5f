"""Answer keys and questions that arrive as files, matched batch by batch.

A stream of canonical JSON lines is read by declared schema; every batch is
matched and joined like any other data and written under its own batch number,
so that a batch that is repeated after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from examloom import schemas
from examloom.operators import validation


def stream(spark: SparkSession, folder: str, kind: str, files_per_batch: int = 100) -> DataFrame:
    """Questions or answers from JSON lines that are dropped into a folder."""
    schema = {"questions": schemas.QUESTIONS, "answers": schemas.ANSWERS}[kind]
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def each_batch(frame: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies a flow to what has arrived, until there is no more; the result of batch n is the partition ``batch=n`` of ``out``."""

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return frame.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def reference_counts(questions: DataFrame) -> DataFrame:
    """How often each reference of each paper has arrived; as a stream, state is one row per reference."""
    return questions.groupBy("paper_id", "question_ref").agg(F.count("*").alias("n"))


def arrived_totals(counts: DataFrame, expected: int) -> DataFrame:
    """Missing and repeated questions of the papers seen so far, from a table of ``reference_counts``."""
    number = F.regexp_extract("question_ref", "([0-9]+)", 1)
    rows = counts.select("paper_id", F.nullif(number, F.lit("")).cast("int").alias("number"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("__i"))
    return validation.paper_totals(counts.select("paper_id").distinct(), rows, "paper_id", "number", expected)
