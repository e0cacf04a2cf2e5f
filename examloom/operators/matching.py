"""Questions against answers: match reports, joins and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions.text import norm_ref


def match_report(questions: DataFrame, answers: DataFrame, question_ref: str = "question_ref", answer_ref: str = "question_ref") -> DataFrame:
    """One row per reference: state (matched, unmatched: question only, unused: answer only) and the rows on either side.

    References are normalized; repeats are counted before the join, so a
    reference that is repeated a million times is one row of it. Rows on a side
    above 1 are duplicates and don't undo a match.
    """
    q = questions.groupBy(norm_ref(F.col(question_ref)).alias("ref")).agg(F.count("*").alias("n_questions"))
    a = answers.groupBy(norm_ref(F.col(answer_ref)).alias("ref")).agg(F.count("*").alias("n_answers"))
    state = F.when(F.col("n_answers").isNull(), "unmatched").when(F.col("n_questions").isNull(), "unused").otherwise("matched")
    both = q.join(a, "ref", "full_outer").withColumn("state", state)
    return both.select("ref", "state", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_questions", "n_answers")])


def is_complete(report: DataFrame, expected: int | None = None) -> DataFrame:
    """One row: whether every question has an answer and the other way round, without repeats, and as many as expected."""
    bad = F.count_if((F.col("state") != "matched") | (F.col("n_questions") > 1) | (F.col("n_answers") > 1))
    matched = F.count_if(F.col("state") == "matched")
    whole = (bad == 0) & (F.lit(True) if expected is None else matched == expected)
    return report.agg(matched.alias("n_matched"), whole.alias("complete"))


def join_records(questions: DataFrame, answers: DataFrame, position: Column) -> DataFrame:
    """Every question row with its answer: of repeated answers the one of the last position.

    ``questions`` has question_ref and requires_review, ``answers``
    question_ref, answer and explanation. Added: answer, explanation,
    explanation_source (mark_scheme for an explanation that isn't empty),
    status (NEEDS_REVIEW if asked for or if there is no answer, else DRAFT)
    and requires_review as the status says.
    """
    last = answers.groupBy(norm_ref(F.col("question_ref")).alias("__ref")).agg(F.max_by(F.struct("answer", "explanation"), position).alias("__last"))
    joined = questions.withColumn("__ref", norm_ref(F.col("question_ref"))).join(last, "__ref", "left")
    review = F.col("requires_review") | F.col("__last").isNull()
    given = F.coalesce(F.col("__last.explanation") != "", F.lit(False))
    others = [F.col(c) for c in questions.columns if c != "requires_review"]
    return joined.select(
        *others,
        F.col("__last.answer").alias("answer"),
        F.col("__last.explanation").alias("explanation"),
        F.when(given, "mark_scheme").alias("explanation_source"),
        F.when(review, "NEEDS_REVIEW").otherwise("DRAFT").alias("status"),
        review.alias("requires_review"),
    )


def merge_answer_pages(answers: DataFrame, key: list[str], position: Column) -> DataFrame:
    """One answer per key: the first, unless it has no explanation and a later one has one that isn't empty: then the first such."""
    row = F.struct("answer", "explanation")
    explained = F.coalesce(F.col("explanation") != "", F.lit(False))
    merged = answers.groupBy(*key).agg(
        F.min_by(row, position).alias("first"),
        F.min_by(F.when(explained, row), F.when(explained, position)).alias("later"),
    )
    one = F.when(F.col("first.explanation").isNotNull(), F.col("first")).otherwise(F.coalesce("later", "first"))
    return merged.withColumn("one", one).select(*key, "one.answer", "one.explanation")


def merge_continued(parts: DataFrame, key: list[str], position: str) -> DataFrame:
    """Parts of a question on several pages as one: contents appended in order, review if any asks for it, options and page of the first.

    The appended content is what the operator returns, so it grows with a
    question's parts.
    """
    content = F.transform(F.array_sort(F.collect_list(F.struct(position, "content"))), lambda p: p["content"])
    return parts.groupBy(*key).agg(
        content.alias("contents"),
        F.bool_or("requires_review").alias("requires_review"),
        F.min_by("options", position).alias("options"),
        F.min(position).alias("source_page"),
    )
