"""Whole flows: a multiple-choice paper from its layout, a structured paper, and an ingest of questions and answers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions import boxes
from examloom.functions import text as tx
from examloom.operators import layout, matching, options, segment, spatial, validation


@dataclass(frozen=True)
class Layout:
    """Frames of ``examloom.sources.pages``: lines, images, tables and page sizes of any number of papers."""

    lines: DataFrame
    images: DataFrame
    tables: DataFrame
    pages: DataFrame

    def stored(self, folder: str) -> Layout:
        """The frames written as Parquet and read again, so that the reader behind them runs once, however often a flow looks at them."""
        spark, found = self.pages.sparkSession, {}
        for name in ("lines", "images", "tables", "pages"):
            frame = getattr(self, name)
            frame.write.mode("overwrite").parquet(f"{folder}/{name}")
            found[name] = spark.read.schema(frame.schema).parquet(f"{folder}/{name}")
        return Layout(**found)


def ordered_lines(found: Layout) -> DataFrame:
    """Lines in reading order with the height of their page."""
    sized = found.lines.join(found.pages.select("paper_id", "page", F.col("height").alias("page_height")), ["paper_id", "page"], "left")
    return layout.reading_order(sized)


def parse_mcq(found: Layout, expected: int) -> DataFrame:
    """Questions of multiple-choice papers: number, stem, options (map of label to struct<text, requires_visual>), pages, box, visual cue.

    The box goes around the lines and figures on the question's first page; it
    is null if there are none. The layout is looked at many times: give one that
    is ``stored`` if its reader is dear.

    Lines are cut into questions; options come from the best run of labels or
    from an option table; what stands before the options, and in no table or
    figure, is the stem.
    """
    lines = ordered_lines(found)
    height = F.col("page_height")
    starts = segment.greedy_starts(segment.candidates(lines, height), "paper_id", ["line_index"], expected)
    owned = segment.slices(lines, starts, height)
    keys = ["paper_id", "question"]
    at = starts.select("paper_id", "number", "page", "y0")
    images = spatial.owners(at, found.images.withColumn("y", (F.col("y0") + F.col("y1")) / 2), "paper_id").where(F.col("owner").isNotNull()).withColumnRenamed("owner", "question")
    begins = starts.select("paper_id", F.col("number").alias("question"), F.col("line_index").alias("start_index"), "stem_prefix")
    body = owned.join(begins, keys).withColumn("pos", F.col("line_index"))
    rest = body.where(F.col("line_index") != F.col("start_index"))
    runs = options.run_markers(options.markers(rest).withColumn("pos", F.col("line_index") * 10 + F.col("on_line")), keys)
    marked = runs.withColumn("pos", F.col("line_index"))
    texts = options.option_texts(marked, rest, images, keys)
    tables = spatial.tables_off_figures(found.tables, images, ["paper_id", "page"])
    spans = owned.groupBy(*keys).agg(F.min(F.struct("page", "y0")).alias("a"), F.max(F.struct("page", "y1")).alias("b"))
    bands = spans.select("paper_id", F.col("question").alias("number"), F.col("a.page").alias("page"), F.col("a.y0").alias("y0"), F.col("b.page").alias("page_end"), (F.col("b.y1") + 40).alias("y_end"))
    inside = spatial.in_bands(bands, tables.withColumn("y", (F.col("y0") + F.col("y1")) / 2)).withColumnRenamed("number", "question")
    chosen = options.with_table_options(texts, options.table_options(inside, keys), keys)
    first = marked.groupBy(*keys).agg(F.min("line_index").alias("first_option"))
    stem_lines = rest.join(first, keys, "left").where(F.coalesce(F.col("line_index") < F.col("first_option"), F.lit(True)) & ~tx.strip(F.col("text")).isin("A", "B", "C", "D"))
    stem_lines = options.off_annotations(stem_lines, images, [*keys, "page"])
    stem_lines = layout.without_table_text(spatial.lines_off_figures(stem_lines, images, [*keys, "page"]), inside, [*keys, "page"])
    pieces = stem_lines.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("line_index", F.col("text").alias("t")))), lambda s: s["t"]).alias("pieces"))
    maps = chosen.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("label", F.struct("text", "requires_visual")))).alias("options"))
    around = owned.groupBy(*keys).agg(F.min("page").alias("page_start"), F.max("page").alias("page_end"))
    sides = ("x0", "y0", "x1", "y1")
    seen = owned.select(*keys, "page", *sides).unionByName(images.select(*keys, "page", *sides)).join(around.select(*keys, F.col("page_start").alias("page")), [*keys, "page"])
    around = around.join(seen.groupBy(*keys).agg(*spatial.union_box()).select(*keys, F.struct(*sides).alias("box")), keys, "left")
    rows = begins.join(around, keys).join(pieces, keys, "left").join(maps, keys, "left")
    n_images = images.groupBy(*keys).agg(F.count("*").alias("n_images"))
    stem = tx.collapse(F.regexp_replace(F.concat_ws(" ", F.nullif("stem_prefix", F.lit("")), F.array_join("pieces", " ")), r"(?i)-\s*end of section\s*-?", ""))
    rows = rows.join(n_images, keys, "left").withColumn("stem", stem)
    visual = tx.needs_visual(F.col("stem")) | F.coalesce(F.exists(F.map_values("options"), lambda o: o["requires_visual"]), F.lit(False))
    return rows.select("paper_id", F.col("question").alias("number"), "stem", "options", "page_start", "page_end", "box", F.coalesce("n_images", F.lit(0)).alias("n_images"), visual.alias("visual_required"))


def validated(questions: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Questions of ``parse_mcq`` with issues and status.

    ``assets`` are the pictures that have been cut out: paper_id, number and
    label (of an option, null for one of all options, ``stem`` for the stem's).
    Without any, all that a question needs is still to be cut out.
    """
    none = F.array().cast("array<string>")
    labels = F.array(*[F.lit(x) for x in "ABCD"])
    empty = F.transform(labels, lambda x: F.struct(x, F.struct(F.lit(None).cast("string").alias("text"), F.lit(False).alias("requires_visual"))))
    filled = questions.withColumn("options", F.coalesce("options", F.map_from_entries(empty)))
    if assets is None:
        shown = filled.withColumns({"option_assets": none, "n_assets": F.lit(0)})
    else:
        stem = F.coalesce(F.col("label") == "stem", F.lit(False))
        # A null in the list stands for the picture of all options.
        listed = assets.groupBy("paper_id", "number").agg(F.flatten(F.collect_list(F.when(~stem, F.array("label")))).alias("option_assets"), F.count("*").alias("n_assets"))
        shown = filled.join(listed, ["paper_id", "number"], "left").withColumns({"option_assets": F.coalesce("option_assets", none), "n_assets": F.coalesce("n_assets", F.lit(0))})
    pending = F.col("visual_required") & (F.col("n_assets") == 0)
    return validation.validate_questions(shown.withColumns({"visual_pending": pending, "has_bbox": F.col("box").isNotNull()})).drop("n_assets")


def paper_totals(questions: DataFrame, papers: DataFrame, expected: int) -> DataFrame:
    return validation.paper_totals(papers.select("paper_id").distinct(), questions, "paper_id", "number", expected)


def titles(found: Layout) -> DataFrame:
    """The title of each paper: of its first twelve lines up to three that are no page number, and none from the first question on. Papers without any have none."""
    text = tx.strip(F.col("text"))
    so_far = segment.Window.partitionBy("paper_id").orderBy("line_index").rowsBetween(segment.Window.unboundedPreceding, segment.Window.currentRow)
    head = ordered_lines(found).where(F.col("line_index") < segment.TITLE_LINES).withColumn("__text", text)
    begun = F.max(F.col("__text").rlike(r"(?i)^q\s*\d").cast("int")).over(so_far)
    kept = head.withColumn("__q", begun).where((F.col("__q") == 0) & ~F.col("__text").rlike(segment.PAGE_ONLY))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("line_index", "__text"))), lambda s: s["__text"])
    return kept.groupBy("paper_id").agg(F.nullif(tx.strip(F.array_join(F.slice(pieces, 1, segment.TITLE_PIECES), " ")), F.lit("")).alias("title"))


def run_name(title: Column, paper_code: Column, year: Column, started: Column) -> Column:
    """The id of a run: title, or code and year of the paper, and the time in UTC."""
    base = F.coalesce(title, F.concat_ws("-", paper_code, year.cast("string")))
    return F.concat_ws("-", F.regexp_replace(base, r"[^\p{L}\p{N}_-]", "-"), F.date_format(started, "yyyyMMdd'T'HHmmss'Z'"))


def documents(pages: DataFrame, role: str) -> DataFrame:
    """One row for each file that was read: role, path, sha256, pages (null if it failed) and error."""
    return pages.groupBy("paper_id").agg(F.first("sha256").alias("sha256"), F.max("page").alias("page_count"), F.min("error").alias("error")).select(F.lit(role).alias("role"), F.col("paper_id").alias("path"), "sha256", "page_count", "error")


def canonical(questions: DataFrame) -> DataFrame:
    """Questions of ``parse_mcq`` as canonical ones, with the columns that ``ingest`` asks for."""
    label = lambda x: F.struct(F.lit(x).alias("label"), F.element_at("options", x)["text"].alias("content"))
    items = F.filter(F.array(*[F.when(F.element_at("options", x).isNotNull(), label(x)) for x in "ABCD"]), lambda o: o.isNotNull())
    visual = F.exists(F.map_values("options"), lambda o: o["requires_visual"])
    content = F.filter(F.array(F.when(F.coalesce("stem", F.lit("")) != "", F.struct(F.lit("text").alias("type"), F.col("stem").alias("value")))), lambda b: b.isNotNull())
    return questions.select(
        "paper_id", F.col("number").alias("pos"), F.col("page_start").alias("page"), F.col("number").cast("string").alias("question_ref"), content.alias("content"), items.alias("items"),
        F.when(F.coalesce(visual, F.lit(False)), "composite_visual").otherwise("text").alias("mode"), F.coalesce(F.transform(items, lambda o: o["label"]), F.array().cast("array<string>")).alias("labels"),
        F.lit(None).cast("int").alias("n_columns"), F.lit(None).cast("array<int>").alias("row_widths"), F.lit(None).cast("string").alias("asset"), F.lit(None).cast("boolean").alias("asset_exists"),
        F.array().cast("array<string>").alias("image_assets"), F.coalesce(F.col("status") != "pass", F.lit(False)).alias("requires_review"),
    )


def option_facts(questions: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Canonical questions (``schemas.QUESTIONS``) with what validation asks of their options; ``assets`` lists the names of pictures that exist."""
    options = F.col("options")
    of = lambda c: F.transform(c, lambda o: o["label"])
    labels = F.coalesce(F.when(options["mode"].isin("text", "math", "mixed"), of(options["items"])).when(options["mode"] == "table", of(options["rows"])).otherwise(options["labels"]), F.array().cast("array<string>"))
    facts = questions.withColumns(
        {
            "mode": options["mode"], "labels": labels, "n_columns": F.size(options["columns"]), "row_widths": F.transform(options["rows"], lambda r: F.size(r["cells"])), "asset": options["asset"],
            "image_assets": F.transform(F.filter("content", lambda b: b["type"] == "image"), lambda b: b["asset"]),
        }
    )
    if assets is None:
        return facts.withColumn("asset_exists", F.lit(False))
    known = assets.select(F.col("name").alias("asset"), F.lit(True).alias("asset_exists")).distinct()
    return facts.join(known, "asset", "left").withColumn("asset_exists", F.coalesce("asset_exists", F.lit(False)))


def parse_structured(found: Layout) -> tuple[DataFrame, DataFrame]:
    """Questions (number, stem, marks_total) and parts (with parent) of structured papers, up to their answers."""
    lines = ordered_lines(found)
    starts = segment.increasing_starts(segment.structured_candidates(lines), "paper_id", ["line_index"])
    text = tx.strip(F.col("text"))
    so_far = segment.Window.partitionBy("paper_id").orderBy("line_index").rowsBetween(segment.Window.unboundedPreceding, segment.Window.currentRow)
    usable = lines.withColumn("__a", F.max(text.rlike(segment.ANSWERS_START).cast("int")).over(so_far)).where(F.col("__a") == 0).drop("__a")
    marked = usable.join(starts.select("paper_id", "line_index", "number", "stem_prefix"), ["paper_id", "line_index"], "left")
    owned = marked.withColumn("question", F.last("number", ignorenulls=True).over(so_far)).where(F.col("question").isNotNull())
    keys = ["paper_id", "question"]
    body = owned.where(F.col("number").isNull())
    parts = segment.nest_parts(segment.parts(body, keys), keys)
    first = parts.groupBy(*keys).agg(F.min("part").alias("__first"))
    stems = owned.join(first, keys, "left").where(F.coalesce(F.col("line_index") < F.col("__first"), F.lit(True)))
    stems = stems.where(F.col("number").isNotNull() | ~(text.rlike(segment.PAGE_ONLY) | text.rlike(segment.ANSWER_DOTS) | text.rlike(segment.TOTAL)))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("line_index", F.coalesce("stem_prefix", "text").alias("t")))), lambda s: s["t"])
    questions = stems.groupBy(*keys).agg(segment.without_marks(F.array_join(pieces, " ")).alias("stem"))
    questions = questions.join(segment.marks_total(owned, keys), keys, "left")
    return questions.withColumn("visual_required", tx.needs_visual(F.col("stem"))), parts


def ingest(questions: DataFrame, answers: DataFrame, run_id: str, expected: int | None = None, whole: bool = True) -> dict[str, DataFrame]:
    """Canonical questions and answers matched, joined and validated: match_report, records, issues and stages.

    ``questions``: paper_id, pos, page, question_ref, mode, labels, n_columns,
    row_widths, asset, asset_exists, image_assets, requires_review;
    ``answers``: pos, page, question_ref, answer, explanation. Records that
    validation finds fault with are demoted to NEEDS_REVIEW. Unless ``whole``, a
    match that leaves something over doesn't fail its stage.
    """
    merged = matching.merge_answer_pages(answers.withColumn("question_ref", tx.norm_ref(F.col("question_ref"))), ["question_ref"], F.struct("page", "pos"))
    report = matching.match_report(questions, merged)
    records = matching.join_records(questions, merged.withColumn("__one", F.lit(0)), F.col("__one"))
    checked = validation.validate_canonical(records)
    lost = validation.issues(
        validation.issue(F.col("answer").isNull(), "MISSING_ANSWER", "the question has no answer"),
        validation.issue(F.col("answer").isNotNull() & ~F.array_contains(F.coalesce("labels", F.array().cast("array<string>")), F.col("answer")), "ANSWER_NOT_IN_OPTIONS", "the answer is no option"),
    )
    checked = checked.withColumn("issues", F.concat("issues", lost))
    checked = checked.withColumns({"ok": F.size("issues") == 0, "status": F.when(F.size("issues") > 0, "NEEDS_REVIEW").otherwise(F.col("status")), "requires_review": F.col("requires_review") | (F.size("issues") > 0)})
    of_report = report.select(
        tx.printed_ref(F.col("ref")).alias("question_ref"),
        F.explode(
            validation.issues(
                validation.issue(F.col("n_questions") > 1, "DUPLICATE_QUESTION_REFS", "the question occurs twice"),
                validation.issue(F.col("n_answers") > 1, "DUPLICATE_ANSWER_REFS", "the answer occurs twice"),
                validation.issue(F.col("state") == "unmatched", "UNMATCHED_QUESTION", "the question has no answer"),
                validation.issue(F.col("state") == "unused", "UNUSED_ANSWER", "the answer has no question"),
            )
        ).alias("i"),
    ).select("question_ref", "i.*")
    of_records = checked.select("question_ref", F.explode("issues").alias("i")).select("question_ref", "i.*")
    issues = of_report.unionByName(of_records)
    if expected is not None:
        n = questions.agg(F.count("*").alias("n")).where(F.col("n") != expected)
        issues = issues.unionByName(n.select(F.lit(None).cast("string").alias("question_ref"), F.lit("QUESTION_COUNT_MISMATCH").alias("code"), F.concat_ws(" of ", F.col("n").cast("string"), F.lit(str(expected))).alias("message"), F.lit("error").alias("severity")))
    complete = matching.is_complete(report, expected)
    stages = complete.select(F.lit(run_id).alias("run_id"), F.lit("match").alias("stage"), F.when(F.col("complete") | F.lit(not whole), "succeeded").otherwise("failed").alias("status"), F.concat(F.col("n_matched").cast("string"), F.lit(" matched")).alias("message"))
    faults = issues.agg(F.count("*").alias("n"))
    stages = stages.unionByName(faults.select(F.lit(run_id).alias("run_id"), F.lit("validate").alias("stage"), F.when(F.col("n") == 0, "succeeded").otherwise("failed").alias("status"), F.concat(F.col("n").cast("string"), F.lit(" issues")).alias("message")))
    return {"match_report": report, "records": checked, "issues": issues, "stages": stages}


def pixel_crops(regions: DataFrame, width: int, height: int, padding: int = 2) -> DataFrame:
    """Regions (ymin, xmin, ymax, xmax of 0 to 1000) with the pixel box to cut out."""
    box = boxes.norm_to_pixels(F.col("ymin"), F.col("xmin"), F.col("ymax"), F.col("xmax"), F.lit(width), F.lit(height), padding)
    return regions.withColumn("crop", box)
