"""Missing, repeated and surplus questions; statuses of checks and their roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statuses of checks, from harmless to worst.
PASSED, NOT_EVALUATED, NEEDS_REVIEW, FAILED = "passed", "not_evaluated", "needs_review", "failed"


def paper_totals(papers: DataFrame, questions: DataFrame, paper: str, number: str, expected: int) -> DataFrame:
    """Per paper: detected questions, numbers of 1..expected that are missing, numbers that occur twice, and the status.

    Numbers are counted per paper first, so a paper with a third of all rows
    is a handful of counts when its numbers meet. ``missing`` and
    ``duplicate`` are ascending arrays; papers without questions miss all;
    null numbers count as detected only. Status is review if anything is off.
    """
    counts = questions.groupBy(F.col(paper).alias("__paper"), F.col(number).alias("__number")).agg(F.count("*").alias("n"))
    found = counts.groupBy("__paper").agg(
        F.sum("n").alias("detected"),
        F.collect_set(F.when(F.col("__number").between(1, expected), F.col("__number"))).alias("seen"),
        F.array_sort(F.collect_list(F.when(F.col("n") > 1, F.col("__number")))).alias("duplicate"),
    )
    numbers = F.sequence(F.lit(1), F.lit(expected))
    joined = papers.join(found, papers[paper] == found["__paper"], "left")
    none = F.array().cast("array<int>")
    rows = joined.select(
        *papers.columns,
        F.coalesce("detected", F.lit(0)).cast("long").alias("detected"),
        F.array_except(numbers, F.coalesce(F.col("seen").cast("array<int>"), none)).alias("missing"),
        F.coalesce(F.col("duplicate").cast("array<int>"), none).alias("duplicate"),
    )
    mismatch = F.col("detected") != expected
    review = (F.size("missing") > 0) | (F.size("duplicate") > 0) | mismatch
    return rows.withColumns({"count_mismatch": mismatch, "status": F.when(review, "review").otherwise("pass")})


def rolled_up(status: Column) -> Column:
    """One status of a group of checks, as an aggregate.

    No check, or none evaluated: not_evaluated. Else the worst: failed before
    needs_review before passed; some unevaluated checks don't spoil a pass.
    """
    return (
        F.when(F.count_if(status == FAILED) > 0, FAILED)
        .when(F.count_if(status == NEEDS_REVIEW) > 0, NEEDS_REVIEW)
        .when(F.count_if(status != NOT_EVALUATED) == 0, NOT_EVALUATED)
        .otherwise(PASSED)
    )


def issue(when: Column, code: str, message: str | Column, severity: str = "error") -> Column:
    """An issue, or null."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(when, F.struct(F.lit(code).alias("code"), text.alias("message"), F.lit(severity).alias("severity")))


def issues(*found: Column) -> Column:
    return F.filter(F.array(*found), lambda i: i.isNotNull())


def option_evidenced(text: Column, has_asset: Column) -> Column:
    """An option counts if it has text or a picture."""
    return (F.coalesce(F.trim(text), F.lit("")) != "") | F.coalesce(has_asset, F.lit(False))


def validate_questions(questions: DataFrame) -> DataFrame:
    """Issues and status of parsed questions.

    Expects stem, options (map of label to struct<text, requires_visual>),
    visual_required, visual_pending, option_assets (array of labels or null
    for a shared one) and has_bbox. Errors make the status review; the
    warning about the missing box does not.
    """
    found = [issue(F.coalesce(F.trim("stem"), F.lit("")) == "", "EMPTY_STEM", "the stem is empty")]
    for label in "ABCD":
        option = F.element_at("options", label)
        shown = F.exists("option_assets", _shown(label))
        blank = F.coalesce(F.trim(option["text"]), F.lit("")) == ""
        visual = F.coalesce(option["requires_visual"], F.lit(False))
        found += [
            issue(option.isNull(), "MISSING_OPTION", f"option {label} is missing"),
            issue(option.isNotNull() & visual & ~shown, "VISUAL_OPTION_EXTRACTION_PENDING", f"option {label} needs a picture"),
            issue(option.isNotNull() & ~visual & blank & ~shown, "MISSING_OPTION_TEXT", f"option {label} has no text"),
        ]
    found += [
        issue(F.col("visual_required") & F.col("visual_pending"), "VISUAL_EXTRACTION_PENDING", "a picture is still to be cut out"),
        issue(~F.col("has_bbox"), "MISSING_BOUNDING_BOX", "the question has no place on its page", "warning"),
    ]
    checked = questions.withColumn("issues", issues(*found))
    bad = F.exists("issues", lambda i: i["severity"] == "error")
    return checked.withColumn("status", F.when(bad, "review").otherwise("pass"))


def _shown(label: str):
    return lambda a: a.isNull() | (a == label)


def validate_canonical(records: DataFrame) -> DataFrame:
    """Issues of canonical questions: reference, options and pictures.

    Expects question_ref, mode (text, math, table, mixed, composite_visual),
    labels (array of the options' labels), n_columns and row_widths (of table
    options), asset, asset_exists, and image_assets (of content blocks). All
    issues are errors.
    """
    wanted = F.array(*[F.lit(x) for x in "ABCD"])
    labels = F.coalesce("labels", F.array().cast("array<string>"))
    distinct = F.array_distinct(labels)
    table, composite = F.col("mode") == "table", F.col("mode") == "composite_visual"
    widths = F.coalesce("row_widths", F.array().cast("array<int>"))
    found = issues(
        issue(F.coalesce(F.trim("question_ref"), F.lit("")) == "", "MISSING_REF", "the question has no reference"),
        issue(F.size(labels) == 0, "MISSING_OPTIONS", "the question has no options"),
        issue(F.size(distinct) < F.size(labels), "DUPLICATE_OPTION_LABELS", "a label occurs twice"),
        issue((F.size(labels) > 0) & (F.size(F.array_except(wanted, distinct)) > 0), "INCOMPLETE_OPTIONS", "labels of A to D are missing"),
        issue(table & F.exists(widths, lambda w: (w > 0) & (w != F.col("n_columns"))), "TABLE_OPTION_COLUMN_MISMATCH", "a row is not as wide as the header"),
        issue(table & F.exists(widths, lambda w: w == 0), "TABLE_OPTION_EMPTY_ROW", "a row has no cells"),
        issue(composite & (F.coalesce("asset", F.lit("")) == ""), "MISSING_COMPOSITE_ASSET", "the options' picture is missing"),
        issue((F.coalesce("asset", F.lit("")) != "") & ~F.coalesce("asset_exists", F.lit(False)), "MISSING_ASSET_FILE", "the picture's file is missing"),
        issue(F.exists("image_assets", lambda a: F.coalesce(F.trim(a), F.lit("")) == ""), "EMPTY_IMAGE_BLOCK", "an image block has no picture"),
    )
    return records.withColumn("issues", found).withColumn("ok", F.size("issues") == 0)


def validate_structured(questions: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    """Issues and status of structured questions: no stem and no parts (an error), parts without a prompt or sub-parts (warnings). Any issue makes the status review."""
    children = parts.where(F.col("parent").isNotNull()).select(*keys, F.col("parent").alias("part"), F.lit(True).alias("__child")).distinct()
    empty = parts.join(children, [*keys, "part"], "left").where((F.coalesce(F.trim("prompt"), F.lit("")) == "") & F.col("__child").isNull())
    found = F.struct(F.lit("EMPTY_PART").alias("code"), F.concat(F.lit("part ("), "label", F.lit(") has no prompt")).alias("message"), F.lit("warning").alias("severity"))
    counts = parts.groupBy(*keys).agg(F.count("*").alias("__n"))
    joined = questions.join(counts, keys, "left").join(empty.groupBy(*keys).agg(F.array_sort(F.collect_list(found)).alias("__empty")), keys, "left")
    blank = issue((F.coalesce(F.trim("stem"), F.lit("")) == "") & F.col("__n").isNull(), "EMPTY_QUESTION", "the question has neither stem nor parts")
    rows = joined.withColumn("issues", F.concat(issues(blank), F.coalesce("__empty", F.filter(F.array(blank), lambda i: F.lit(False)))))
    return rows.drop("__n", "__empty").withColumn("status", F.when(F.size("issues") > 0, "review").otherwise("pass"))
