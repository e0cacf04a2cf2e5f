"""Questions and answers that a model reads from page images.

The model is the caller's: a function from one page (paper_id, page, context,
image) to JSON text. It runs on the executors, a page at a time, and is tried
again on errors. What it says is read by declared schemas; a page whose answer
is no such JSON, or that fails in every attempt, becomes one question up for
review, so that nothing is lost unnoticed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom import schemas
from examloom.functions import text as tx
from examloom.operators import crops, matching

#: Reads one page: a dict with paper_id, page, context and image (bytes or None).
Extractor = Callable[[dict[str, Any]], str]
ATTEMPTS = 3

BLOCKS = f"array<struct<{schemas._FIELDS(schemas.BLOCK)}>>"
OPTIONS = f"struct<{schemas._FIELDS(schemas.OPTIONS)}>"
PAGE_QUESTIONS = f"struct<questions:array<struct<question_ref:string,content:{BLOCKS},options:{OPTIONS},stem_visuals:array<struct<bbox:array<double>>>,options_bbox:array<double>,requires_review:boolean>>,_corrupt:string>"
PAGE_ANSWERS = "struct<answers:array<struct<question_ref:string,answer:string,explanation:string>>,_corrupt:string>"


def said(pages: DataFrame, extractor: Extractor, attempts: int = ATTEMPTS) -> DataFrame:
    """``pages`` (paper_id, page, context, image) with what the model says of each, or its last error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page in batch.to_dict("records"):
                text = error = None
                for _ in range(max(1, attempts)):
                    try:
                        text, error = extractor(page), None
                        break
                    except Exception as e:  # the model's own errors belong to its page
                        error = f"{type(e).__name__}: {e}"
                rows.append((page["paper_id"], page["page"], text, error))
            yield pd.DataFrame(rows, columns=["paper_id", "page", "said", "error"])

    return pages.select("paper_id", "page", "context", "image").mapInPandas(run, "paper_id string, page int, said string, error string")


def _read(pages: DataFrame, schema: str, field: str) -> DataFrame:
    read = pages.withColumn("__read", F.from_json("said", schema, {"columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("__read").isNull() | F.col("__read._corrupt").isNotNull() | F.col(f"__read.{field}").isNull()
    return read.withColumn("error", F.coalesce("error", F.when(bad, F.lit("the answer is not of the declared form"))))


def questions(pages: DataFrame, extractor: Extractor, attempts: int = ATTEMPTS) -> DataFrame:
    """Canonical questions as they stand on their pages (``schemas.QUESTIONS`` with stem_visuals and options_bbox), and a placeholder for every failed page."""
    read = _read(said(pages, extractor, attempts), PAGE_QUESTIONS, "questions")
    good = read.where(F.col("error").isNull()).select("paper_id", "page", F.posexplode("__read.questions").alias("pos", "q"))
    region = F.array(F.struct("page", F.lit(None).cast("array<double>").alias("bbox")))
    good = good.select(
        "paper_id", "pos", "page", tx.norm_ref(F.col("q.question_ref")).alias("question_ref"), F.coalesce("q.content", F.array().cast(BLOCKS)).alias("content"), "q.options",
        region.alias("source_regions"), F.coalesce("q.requires_review", F.lit(False)).alias("requires_review"), "q.stem_visuals", "q.options_bbox",
    )
    none = lambda kind: F.lit(None).cast(kind)
    text = F.concat(F.lit("[parse failed on page "), F.col("page").cast("string"), F.lit(": "), F.col("error"), F.lit("]"))
    block = F.from_json(F.to_json(F.struct(F.lit("text").alias("type"), text.alias("value"))), BLOCKS[6:-1])
    options = F.from_json(F.lit('{"mode": "composite_visual", "asset": "", "labels": ["A", "B", "C", "D"]}'), OPTIONS)
    failed = read.where(F.col("error").isNotNull()).select(
        "paper_id", F.lit(0).alias("pos"), "page", F.concat(F.lit("page-"), F.col("page").cast("string"), F.lit("-failed")).alias("question_ref"), F.array(block).alias("content"), options.alias("options"),
        region.alias("source_regions"), F.lit(True).alias("requires_review"), none("array<struct<bbox:array<double>>>").alias("stem_visuals"), none("array<double>").alias("options_bbox"),
    )
    return good.unionByName(failed)


def materialized(found: DataFrame) -> DataFrame:
    """Questions with names for their pictures: the n-th picture of the stem goes to the n-th image block, or behind all; image blocks without one are dropped.

    Composite options without a box are up for review. ``pictures`` lists what
    is to be cut out: name, role and bbox.
    """
    ref = F.col("question_ref")
    visuals = F.coalesce("stem_visuals", F.array().cast("array<struct<bbox:array<double>>>"))
    name = lambda i: crops.asset_name(ref, F.lit("stem"), i)
    image = lambda i, v: F.from_json(F.to_json(F.struct(F.lit("image").alias("type"), name(i).alias("asset"), v["bbox"].alias("bbox"))), BLOCKS[6:-1])
    named = F.transform(visuals, lambda v, i: image(i + 1, v))
    is_image = lambda b: b["type"] == "image"
    seen = lambda i: F.size(F.filter(F.slice("content", F.lit(1), i + 1), is_image))
    placed = F.transform("content", lambda b, i: F.when(is_image(b), F.get(named, seen(i) - 1)).otherwise(b))
    rest = F.slice(named, F.size(F.filter("content", is_image)) + 1, F.greatest(F.lit(0), F.size(named)))
    content = F.filter(F.concat(placed, rest), lambda b: b.isNotNull())
    box = F.coalesce("options.bbox", "options_bbox")
    mode = F.col("options.mode")
    shown = mode.isin("composite_visual", "mixed") & box.isNotNull()
    options = F.when(shown, F.col("options").withField("asset", crops.asset_name(ref, F.lit("options"), F.lit(None))).withField("bbox", box)).otherwise(F.col("options"))
    of_options = F.filter(F.array(F.when(shown, F.struct(crops.asset_name(ref, F.lit("options"), F.lit(None)).alias("name"), F.lit("options").alias("role"), box.alias("bbox")))), lambda p: p.isNotNull())
    pictures = F.concat(F.transform(visuals, lambda v, i: F.struct(name(i + 1).alias("name"), F.lit("stem").alias("role"), v["bbox"].alias("bbox"))), of_options)
    review = F.col("requires_review") | ((mode == "composite_visual") & box.isNull())
    return found.withColumns({"content": content, "options": options, "pictures": pictures, "requires_review": review}).drop("stem_visuals", "options_bbox")


def merged(found: DataFrame) -> DataFrame:
    """Questions that go on over several pages as one: content and regions in order, the first options and page, review if any part wants it."""
    rows = found.withColumn("__at", F.struct("page", "pos"))
    parts = matching.merge_continued(rows.withColumnRenamed("__at", "turn").select("paper_id", "question_ref", "turn", "content", "requires_review", "options"), ["paper_id", "question_ref"], "turn")
    regions = found.groupBy("paper_id", "question_ref").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page", "pos", "source_regions"))), lambda r: r["source_regions"])).alias("source_regions"))
    return parts.select("paper_id", "question_ref", F.flatten("contents").alias("content"), "options", "requires_review", F.col("source_page.page").alias("page")).join(regions, ["paper_id", "question_ref"])


def answers(pages: DataFrame, extractor: Extractor, attempts: int = ATTEMPTS) -> DataFrame:
    """Answers (``schemas.ANSWERS``) from the pages of a key or mark scheme, merged by reference; failed pages give none."""
    read = _read(said(pages, extractor, attempts), PAGE_ANSWERS, "answers").where(F.col("error").isNull())
    rows = read.select("paper_id", "page", F.posexplode("__read.answers").alias("pos", "a")).select("paper_id", "pos", "page", tx.norm_ref(F.col("a.question_ref")).alias("question_ref"), F.upper(F.trim("a.answer")).alias("answer"), "a.explanation")
    kept = matching.merge_answer_pages(rows, ["paper_id", "question_ref"], F.struct("page", "pos"))
    return kept
