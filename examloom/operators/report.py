"""Parsed papers as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.functions import text as tx


def question_lines(questions: DataFrame) -> DataFrame:
    """(paper_id, number, line): number, status, stem in short and options of each question."""
    options = F.array_join(F.transform("option_texts", lambda t, i: F.concat(F.char(F.lit(65) + i), F.lit(": "), F.coalesce(tx.preview(t), F.lit("[visual]")))), " | ")
    line = F.concat(F.lit("Q"), F.col("number").cast("string"), F.lit(" ["), F.col("status"), F.lit("] "), tx.preview(F.col("stem")), F.lit("\n    "), options)
    return questions.select("paper_id", "number", line.alias("line"))


def paper_report(questions: DataFrame, totals: DataFrame) -> DataFrame:
    """(paper_id, report): detected, missing and repeated numbers, then the questions in order."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "line"))), lambda s: s["line"]), "\n")
    bodies = question_lines(questions).groupBy("paper_id").agg(body.alias("__body"))
    listed = lambda c: F.coalesce(F.nullif(F.array_join(F.col(c).cast("array<string>"), ", "), F.lit("")), F.lit("none"))
    head = F.concat(F.lit("Paper "), F.col("paper_id"), F.lit("\nDetected: "), F.col("detected").cast("string"), F.lit("\nMissing: "), listed("missing"), F.lit("\nDuplicate: "), listed("duplicate"))
    return totals.join(bodies, "paper_id", "left").select("paper_id", F.concat_ws("\n", head, "__body").alias("report"))


def structured_report(questions: DataFrame, parts: DataFrame) -> DataFrame:
    """(paper_id, report) of structured papers: stems in short, and parts with their marks, sub-parts set in."""
    marks = F.coalesce(F.concat(F.lit(" ["), F.col("marks").cast("string"), F.lit("]")), F.lit(""))
    indent = F.when(F.col("parent").isNull(), "  ").otherwise("    ")
    line = F.concat(indent, F.lit("("), "label", F.lit(")"), marks, F.lit(" "), tx.preview(F.col("prompt"), 93))
    listed = parts.groupBy("paper_id", "question").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", line.alias("line")))), lambda s: s["line"]), "\n").alias("__parts"))
    rows = questions.join(listed, ["paper_id", "question"], "left")
    head = F.concat(F.lit("Q"), F.col("question").cast("string"), F.lit(" ["), "status", F.lit("] "), F.coalesce(F.nullif(tx.preview(F.col("stem"), 123), F.lit("")), F.lit("(empty)")))
    body = F.struct("question", F.concat_ws("\n", head, "__parts").alias("text"))
    return rows.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(body)), lambda s: s["text"]), "\n").alias("report"))
