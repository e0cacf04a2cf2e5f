"""Rows of the question bank's tables, and replacing a bank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.functions import text as tx
from examloom.operators import classify

VISUAL_OPTION = "[visual option]"


def question_id(bank: Column, ref: Column) -> Column:
    """The same id for the same bank and reference, so that writing twice changes nothing."""
    return F.sha2(F.concat_ws("|", bank, ref), 256)


def question_rows(records: DataFrame, bank: Column) -> DataFrame:
    """Rows of the question table: ref, stem, requires_review and a nested payload, written as JSON."""
    return records.select(
        question_id(bank, F.col("ref")).alias("question_id"),
        tx.printed_ref(F.col("ref")).alias("question_ref"),
        "stem",
        F.when(F.col("requires_review"), "needs_review").otherwise("parsed").alias("status"),
        F.to_json("payload").alias("payload"),
    )


def bank_row(spark: SparkSession, bank: str, source_files: list[str], syllabus: str | None = None) -> DataFrame:
    """The bank's own row: its id is a hash of its name, the syllabus is JSON or null."""
    row = spark.createDataFrame([(bank, source_files, syllabus)], "name string, source_files array<string>, syllabus string")
    return row.select(F.sha2("name", 256).alias("id"), "name", "source_files", "syllabus")


def full_question_rows(records: DataFrame, bank: Column, paper: Column) -> DataFrame:
    """Rows of the question table with all of its columns.

    ``records``: question_ref, content (blocks with type, value, latex),
    options, page, source_regions, answer, explanation, explanation_source,
    status, requires_review and, where they are classified, topic, parent_topic,
    subject, syllabus_code, topic_confidence, topic_match_reasoning,
    topic_match_method, parse_warnings. ``paper`` is a struct with paper_code.
    Stems join text, notation and formula blocks; one without any is named by
    its reference.
    """
    has = set(records.columns)
    given = lambda c, kind: F.col(c) if c in has else F.lit(None).cast(kind)
    spoken = F.transform("content", lambda b: F.when(b["type"].isin("text", "chemistry"), b["value"]).when(b["type"] == "math", b["latex"]))
    stem = F.trim(F.array_join(F.filter(spoken, lambda t: F.coalesce(t, F.lit("")) != ""), " "))
    source = F.struct(paper.alias("paperIdentity"), F.col("question_ref").alias("questionRef"), "content", "options", F.col("page").alias("sourcePage"), F.col("source_regions").alias("sourceRegions"))
    answered = F.when(F.col("answer").isNotNull(), F.to_json(F.struct(F.col("answer").alias("value"), "explanation", "explanation_source")))
    known = F.when(F.col("status").isin("DRAFT", "NEEDS_REVIEW", "APPROVED", "PUBLISHED"), F.col("status")).otherwise("DRAFT")
    none = lambda kind: F.lit(None).cast(kind)
    columns = {
        "id": question_id(bank, tx.norm_ref(F.col("question_ref"))),
        "bank_id": F.sha2(bank, 256),
        "number": F.col("question_ref"),
        "stem": F.when(stem != "", stem).otherwise(F.concat(F.lit("Question "), "question_ref")),
        "marks": F.lit(1),
        "correct_answer": F.col("answer"),
        "question_type": F.lit("mcq"),
        "bloom_level": F.lit("unspecified"),
        "difficulty": F.lit("unspecified"),
        "type_confidence": F.lit(0.0),
        "bloom_confidence": F.lit(0.0),
        "tags": F.array().cast("array<string>"),
        "topic": given("topic", "string"),
        "parent_topic": given("parent_topic", "string"),
        "subject": F.coalesce(given("subject", "string"), F.lit("Chemistry")),
        "syllabus_code": F.coalesce(given("syllabus_code", "string"), classify.syllabus_of(paper["paper_code"])),
        "topic_confidence": given("topic_confidence", "double"),
        "topic_match_reasoning": given("topic_match_reasoning", "string"),
        "topic_match_method": given("topic_match_method", "string"),
        "status": F.when(F.col("requires_review"), "NEEDS_REVIEW").otherwise(known),
        "parse_warnings": F.coalesce(given("parse_warnings", "array<string>"), F.array().cast("array<string>")),
        "source": F.to_json(source),
        "answer_source": answered,
        "parts": none("string"),
        "keep_together": F.lit(False),
        "set_context": none("string"),
    }
    return records.select(*[c.alias(n) for n, c in columns.items()])


def full_option_rows(records: DataFrame, bank: Column) -> DataFrame:
    """Rows of the option table for every mode of options: texts, formulae, table rows joined by bars, ``[composite visual]``, ``[mixed]`` for a mixed one with neither."""
    o = F.col("options")
    of_items = lambda text: F.transform(o["items"], lambda i: F.struct(i["label"].alias("label"), F.coalesce(text(i), F.lit("")).alias("text")))
    filled = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit("[mixed]"))
    listed = (
        F.when(o["mode"] == "text", of_items(lambda i: i["content"]))
        .when(o["mode"] == "math", of_items(lambda i: i["latex"]))
        .when(o["mode"] == "mixed", of_items(lambda i: filled(i["content"], i["latex"])))
        .when(o["mode"] == "table", F.transform(o["rows"], lambda r: F.struct(r["label"].alias("label"), F.array_join(r["cells"], " | ").alias("text"))))
        .otherwise(F.transform(o["labels"], lambda x: F.struct(x.alias("label"), F.lit("[composite visual]").alias("text"))))
    )
    ref = tx.norm_ref(F.col("question_ref"))
    rows = records.select(ref.alias("ref"), "answer", F.posexplode(listed).alias("sort_order", "o"))
    return rows.select(
        F.sha2(F.concat_ws("|", bank, "ref", "o.label"), 256).alias("id"), question_id(bank, F.col("ref")).alias("question_id"), "o.label", "o.text",
        F.coalesce(F.col("o.label") == F.col("answer"), F.lit(False)).alias("is_correct"), "sort_order", F.lit(None).cast("string").alias("media"),
    )


def full_media_rows(records: DataFrame, bank: Column, source_key: Column, pictures: DataFrame, public: str) -> DataFrame:
    """Rows of the media table: the content's pictures, then the options' one, numbered by place; those that were never cut out (``pictures``: name, width, height) are left out.

    They lie under ``exam_questions/<paper and question>/<name>`` of a store
    whose addresses begin with ``public``.
    """
    shown = lambda name, role: F.struct(name.alias("name"), F.lit(role).alias("role"))
    stem = F.transform(F.filter("content", lambda b: (b["type"] == "image") & (F.coalesce(b["asset"], F.lit("")) != "")), lambda b: shown(b["asset"], "stem"))
    options = F.filter(F.array(F.when(F.col("options.mode").isin("composite_visual", "mixed") & (F.coalesce("options.asset", F.lit("")) != ""), shown(F.col("options.asset"), "options"))), lambda a: a.isNotNull())
    rows = records.select(tx.norm_ref(F.col("question_ref")).alias("ref"), source_key.alias("key"), "page", F.posexplode(F.concat(stem, options)).alias("image_index", "a")).select("*", "a.name", "a.role")
    path = F.concat(F.lit("exam_questions/"), F.replace("key", F.lit("|"), F.lit("_")), F.lit("/"), "name")
    none = F.lit(None).cast("string")
    return rows.join(pictures.select("name", "width", "height"), "name").select(
        F.sha2(F.concat_ws("|", bank, "ref", "image_index"), 256).alias("id"), question_id(bank, F.col("ref")).alias("question_id"), path.alias("storage_path"), F.concat(F.lit(public), path).alias("public_url"),
        F.col("page").alias("page_number"), "image_index", "width", "height", F.lit(None).cast("array<double>").alias("bbox"), none.alias("caption"), none.alias("description"), "role", none.alias("option_label"),
    )


def option_rows(records: DataFrame, bank: Column) -> DataFrame:
    """Rows of the option table, A to D for each question: question_ref, texts (array) and answer (a label)."""
    ids = records.select(question_id(bank, F.col("question_ref")).alias("question_id"), "question_ref", "answer", F.posexplode("texts").alias("i", "text"))
    label = F.char(F.lit(65) + F.col("i"))
    return ids.select(
        F.sha2(F.concat_ws("|", bank, "question_ref", label), 256).alias("option_id"),
        "question_id",
        label.alias("label"),
        F.when(F.coalesce(F.trim("text"), F.lit("")) == "", VISUAL_OPTION).otherwise(F.col("text")).alias("option_text"),
        (label == F.col("answer")).alias("is_correct"),
        (F.col("i") + 1).alias("sort_order"),
    )


def media_rows(records: DataFrame, bank: Column) -> DataFrame:
    """Rows of the media table: the stem's pictures, then the options'; numbered by place, whether or not the ones before were found."""
    assets = F.concat(
        F.transform("stem_assets", lambda p: F.struct(p.alias("path"), F.lit("stem").alias("role"))),
        F.transform(F.filter(F.array("options_asset"), lambda p: p.isNotNull()), lambda p: F.struct(p.alias("path"), F.lit("options").alias("role"))),
    )
    found = records.select(question_id(bank, F.col("question_ref")).alias("question_id"), F.posexplode(assets).alias("image_index", "asset"))
    return found.select("question_id", "image_index", "asset.path", "asset.role")


def replace_bank(rows: DataFrame, path: str, bank: str) -> None:
    """Writes the rows of one bank as a partition of a Parquet table and replaces that partition only."""
    rows.withColumn("bank", F.lit(bank)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bank").parquet(path)


def write_run(frames: dict[str, DataFrame], folder: str) -> None:
    """The result files of a run, each as JSON lines in a folder of its own."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").json(f"{folder}/{name}")
