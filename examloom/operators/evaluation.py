"""Checks of a parsed paper as rows, and their roll-up into sections and axes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.operators.validation import FAILED, NEEDS_REVIEW, NOT_EVALUATED, PASSED, rolled_up

#: Questions that every evaluation looks at, and element-space-digit as readers leave it.
REGRESSION_REFS = ("Q1", "Q2", "Q4", "Q7", "Q8", "Q29", "Q32", "Q38", "Q40")
SPACED_FORMULA = r"\b[A-Z][a-z]?\s+\d\b"
#: Sections, and the axis that each counts for.
AXES = {
    "segmentation": "schema_validity",
    "option_fidelity": "schema_validity",
    "notation": "source_fidelity",
    "visuals": "source_fidelity",
    "answer_alignment": "answer_alignment",
    "syllabus": None,
    "regression": None,
}
COLUMNS = ("paper_id", "section", "code", "status", "question_ref", "message")


def check(section: str, code: str, status: Column, message: Column, ref: Column | None = None) -> list[Column]:
    none = F.lit(None).cast("string")
    return [F.lit(section).alias("section"), F.lit(code).alias("code"), status.alias("status"), (none if ref is None else ref).alias("question_ref"), message.alias("message")]


def _passes(ok: Column, otherwise: str | Column = FAILED) -> Column:
    return F.when(ok, PASSED).otherwise(F.lit(otherwise) if isinstance(otherwise, str) else otherwise)


def _listed(c: str) -> Column:
    return F.array_join(F.col(c).cast("array<string>"), ",")


def segmentation(totals: DataFrame, matches: DataFrame, expected: int) -> DataFrame:
    """Missing, repeated and counted questions, and those without an answer.

    ``totals``: paper_id, detected, missing, duplicate; ``matches``: paper_id,
    ref, state. Unmatched questions fail a paper in which nothing matched and
    are up for review otherwise.
    """
    by = matches.groupBy("paper_id").agg(F.count_if(F.col("state") == "matched").alias("n"), F.count_if(F.col("state") == "unmatched").alias("u"))
    rows = totals.join(by, "paper_id", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "u": F.coalesce("u", F.lit(0))})
    unmatched = F.when(F.col("n") > 0, NEEDS_REVIEW).otherwise(FAILED)
    checks = [
        check("segmentation", "MISSING_QUESTION_REFS", _passes(F.size("missing") == 0), _listed("missing")),
        check("segmentation", "DUPLICATE_QUESTION_REFS", _passes(F.size("duplicate") == 0), _listed("duplicate")),
        check("segmentation", "QUESTION_COUNT", _passes(F.col("detected") == expected), F.concat_ws(" of ", F.col("detected").cast("string"), F.lit(str(expected)))),
        check("segmentation", "UNMATCHED_QUESTIONS", _passes(F.col("u") == 0, unmatched), F.col("u").cast("string")),
    ]
    return _exploded(rows, checks)


def _exploded(rows: DataFrame, checks: list[list[Column]]) -> DataFrame:
    return rows.select("paper_id", F.inline(F.array(*[F.struct(*c) for c in checks]))).select(*COLUMNS)


def _or_pass(found: DataFrame, papers: DataFrame, section: str, code: str) -> DataFrame:
    """Findings, and one pass for every paper without any."""
    clean = papers.select("paper_id").distinct().join(found, "paper_id", "left_anti")
    return found.unionByName(clean.select("paper_id", *check(section, code, F.lit(PASSED), F.lit(""))).select(*COLUMNS))


def option_fidelity(questions: DataFrame) -> DataFrame:
    """Options without text or picture, and questions whose options all read alike.

    ``questions``: paper_id, question_ref, option_texts (A to D, null for a
    picture), option_evidenced (A to D).
    """
    labels = F.array(*[F.lit(x) for x in "ABCD"])
    missing = F.filter(labels, lambda x, i: ~F.element_at("option_evidenced", i + 1))
    bad = questions.where(F.size(missing) > 0).select("paper_id", *check("option_fidelity", "UNEVIDENCED_OPTIONS", F.lit(FAILED), F.array_join(missing, ","), F.col("question_ref")))
    texts = F.filter(F.transform("option_texts", lambda t: F.lower(F.trim(F.coalesce(t, F.lit(""))))), lambda t: t != "")
    alike = questions.where((F.size(texts) >= 2) & (F.size(F.array_distinct(texts)) == 1))
    alike = alike.select("paper_id", *check("option_fidelity", "SUSPICIOUS_DUPLICATE_OPTION_TEXT", F.lit(NEEDS_REVIEW), F.lit(""), F.col("question_ref")))
    return _or_pass(bad.select(*COLUMNS), questions, "option_fidelity", "UNEVIDENCED_OPTIONS").unionByName(alike.select(*COLUMNS))


def notation(questions: DataFrame) -> DataFrame:
    """Elements and digits set apart by a reader, in stem or options."""
    blob = F.concat_ws(" ", "stem", F.array_join("option_texts", " "))
    bad = questions.where(blob.rlike(SPACED_FORMULA)).select("paper_id", *check("notation", "SPACED_FORMULA_DIGITS", F.lit(NEEDS_REVIEW), F.lit(""), F.col("question_ref")))
    return _or_pass(bad.select(*COLUMNS), questions, "notation", "SPACED_FORMULA_DIGITS")


def visuals(questions: DataFrame) -> DataFrame:
    """Pictures that are wanted and missing, boxes turned inside out, options still without theirs.

    ``questions``: visual_required, assets (array of struct<x0, y0, x1, y1>), visual_pending.
    """
    inverted = F.exists("assets", lambda a: (a["x1"] <= a["x0"]) | (a["y1"] <= a["y0"]))
    rules = (
        ("VISUAL_WITHOUT_ASSET", F.col("visual_required") & (F.size("assets") == 0), FAILED),
        ("INVERTED_BBOX", inverted, FAILED),
        ("VISUAL_OPTIONS_PENDING", F.col("visual_pending"), NEEDS_REVIEW),
    )
    found = [questions.where(test).select("paper_id", *check("visuals", code, F.lit(status), F.lit(""), F.col("question_ref"))).select(*COLUMNS) for code, test, status in rules]
    return _or_pass(found[0].unionByName(found[1]).unionByName(found[2]), questions, "visuals", "VISUAL_WITHOUT_ASSET")


def answer_alignment(matches: DataFrame, expected: int) -> DataFrame:
    """A key at all, repeated and unused answers, coverage. ``matches``: paper_id, ref, state, n_questions, n_answers."""
    rows = matches.groupBy("paper_id").agg(
        F.sum("n_answers").alias("answers"),
        F.count_if(F.col("n_answers") > 1).alias("repeated"),
        F.count_if(F.col("state") == "unused").alias("unused"),
        F.count_if(F.col("state") == "matched").alias("matched"),
    )
    text = lambda c: F.col(c).cast("string")
    checks = [
        check("answer_alignment", "ANSWER_KEY_PRESENT", _passes(F.col("answers") > 0), text("answers")),
        check("answer_alignment", "DUPLICATE_ANSWER_REFS", _passes(F.col("repeated") == 0), text("repeated")),
        check("answer_alignment", "UNUSED_ANSWERS", _passes(F.col("unused") == 0, NEEDS_REVIEW), text("unused")),
        check("answer_alignment", "ANSWER_COVERAGE", _passes(F.col("matched") == expected, NEEDS_REVIEW), text("matched")),
    ]
    return _exploded(rows, checks)


def syllabus(classified: DataFrame) -> DataFrame:
    """How many questions have a topic and how many need a look. ``classified``: paper_id, leaf, status. Nothing classified: not evaluated."""
    rows = classified.groupBy("paper_id").agg(F.count("*").alias("n"), F.count("leaf").alias("with_leaf"), F.count_if(F.col("status") == NEEDS_REVIEW).alias("open"))
    none = F.col("with_leaf") == 0
    checks = [
        check("syllabus", "SYLLABUS_COVERAGE", F.when(none, NOT_EVALUATED).when(F.col("with_leaf") == F.col("n"), PASSED).otherwise(NEEDS_REVIEW), F.col("with_leaf").cast("string")),
        check("syllabus", "SYLLABUS_NEEDS_REVIEW", F.when(none, NOT_EVALUATED).when(F.col("open") == 0, PASSED).otherwise(NEEDS_REVIEW), F.col("open").cast("string")),
    ]
    return _exploded(rows, checks)


def regression(questions: DataFrame, refs: tuple[str, ...] = REGRESSION_REFS) -> DataFrame:
    """The fixed questions of every paper: there, with a stem, with all options shown."""
    wanted = questions.select("paper_id").distinct().select("paper_id", F.explode(F.array(*[F.lit(r) for r in refs])).alias("question_ref"))
    rows = wanted.join(questions.select("paper_id", "question_ref", "stem", "option_evidenced"), ["paper_id", "question_ref"], "left")
    whole = (F.coalesce(F.trim("stem"), F.lit("")) != "") & F.forall("option_evidenced", lambda e: e)
    status = F.when(F.col("option_evidenced").isNull(), FAILED).when(whole, PASSED).otherwise(NEEDS_REVIEW)
    return rows.select("paper_id", *check("regression", "REGRESSION_CASE", status, F.lit(""), F.col("question_ref"))).select(*COLUMNS)


def sections(checks: DataFrame) -> DataFrame:
    """Status of every section of every paper; sections without checks are not evaluated."""
    names = F.array(*[F.lit(s) for s in AXES])
    every = checks.select("paper_id").distinct().select("paper_id", F.explode(names).alias("section"))
    return every.join(checks.groupBy("paper_id", "section").agg(rolled_up(F.col("status")).alias("status")), ["paper_id", "section"], "left").withColumn("status", F.coalesce("status", F.lit(NOT_EVALUATED)))


def axes(checks: DataFrame) -> DataFrame:
    """Status of every axis of every paper, over all checks of its sections."""
    axis = F.element_at(F.create_map(*[F.lit(x) for s, a in AXES.items() if a for x in (s, a)]), F.col("section"))
    return checks.withColumn("axis", axis).where(F.col("axis").isNotNull()).groupBy("paper_id", "axis").agg(rolled_up(F.col("status")).alias("status"))
