"""python -m examloom: parse papers, ingest questions with their answers, or run one of the registered queries."""

from __future__ import annotations

import argparse
import datetime
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.operators import options, report, sinks, validation
from examloom.plans import paper, registry
from examloom.sources import pages, pdf

READERS = {"json": pages.json_reader, "pdf": pdf.pdf_reader, "text": pages.text_reader}
VERSIONS = {"examloom": "2", "schema": "canonical/v1"}
DEFAULT_EXPECTED = 40


def parser() -> argparse.ArgumentParser:
    whole = argparse.ArgumentParser(prog="examloom")
    commands = whole.add_subparsers(dest="command", required=True)
    parse = commands.add_parser("parse", help="papers to questions and a report")
    parse.add_argument("folder")
    parse.add_argument("out")
    parse.add_argument("--mode", choices=("mcq", "structured"), default="mcq")
    parse.add_argument("--expected", type=int, default=DEFAULT_EXPECTED)
    parse.add_argument("--reader", choices=sorted(READERS), default="json")
    ingest = commands.add_parser("ingest", help="questions and answers matched, validated and, if asked for, put into a bank")
    ingest.add_argument("questions", help="canonical JSON lines (*.jsonl), or a folder of pages")
    ingest.add_argument("answers", help="canonical JSON lines (*.jsonl), an answer key (*.json), or a folder of key pages")
    ingest.add_argument("out")
    ingest.add_argument("--run-id")
    ingest.add_argument("--title")
    ingest.add_argument("--exam-year", type=int, default=2023)
    ingest.add_argument("--paper-code", default="6092/01")
    ingest.add_argument("--expected-count", type=int)
    ingest.add_argument("--reader", choices=sorted(READERS), default="json")
    ingest.add_argument("--allow-partial-match", action="store_true")
    ingest.add_argument("--bank", help="folder of the bank's tables")
    ingest.add_argument("--bank-name")
    serve = commands.add_parser("serve", help="a small HTTP service: uploads to ingest, and pages to look at results")
    serve.add_argument("out", help="folder of the runs, shared by all executors")
    serve.add_argument("--host", default="127.0.0.1")
    serve.add_argument("--port", type=int, default=8000)
    run = commands.add_parser("query", help="a registered query over a folder of tables")
    run.add_argument("name", choices=sorted(registry.QUERIES))
    run.add_argument("tables")
    run.add_argument("out")
    return whole


def load_env(path: str, override: bool = False) -> str | None:
    """Puts the NAME=value lines of a file into the environment; names that are set already stay unless ``override``. No file: nothing happens."""
    if not os.path.isfile(path):
        return None
    with open(path, encoding="utf-8") as f:
        for name, _, value in (line.strip().partition("=") for line in f if "=" in line and not line.lstrip().startswith("#")):
            if name.strip() and (override or name.strip() not in os.environ):
                os.environ[name.strip()] = value.strip().strip("'\"")
    return path


def main(argv: list[str] | None = None) -> int:
    """Returns 0 if all is well, 1 if a paper needs review or a stage has failed, 2 if there is nothing to read."""
    args = parser().parse_args(argv)
    load_env(".env")
    spark = SparkSession.builder.appName("examloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "query":
        registry.QUERIES[args.name](spark, args.tables).write.mode("overwrite").parquet(args.out)
        return 0
    if args.command == "ingest":
        stages = ingest(spark, args)
        print(json.dumps(stages, indent=2))
        return int(any(s["status"] == "failed" for s in stages))
    if args.command == "serve":
        from examloom import service

        service.serve(spark, args.host, args.port, args.out)
        return 0
    found = pages.read_files(spark, args.folder, pages.with_attempts(READERS[args.reader])).persist()
    try:
        return _parse(found, args.out, args.expected, args.mode)
    finally:
        found.unpersist()


def _layout(read: DataFrame) -> paper.Layout:
    return paper.Layout(pages.lines(read), pages.images(read), pages.tables(read), pages.page_sizes(read))


def _parse(found: DataFrame, out: str, expected: int, mode: str) -> int:
    read = found.where(F.col("error").isNull())
    if read.isEmpty():
        return 2
    layout = _layout(read).stored(f"{out}/layout")
    failed = found.where(F.col("error").isNotNull()).select("paper_id", "error")
    if mode == "structured":
        questions, parts = paper.parse_structured(layout)
        keys = ["paper_id", "question"]
        checked = validation.validate_structured(questions, parts, keys)
        frames = {"questions": checked, "parts": parts, "titles": paper.titles(layout), "reports": report.structured_report(checked, parts)}
        judged = ("questions",)
    else:
        questions = paper.validated(paper.parse_mcq(layout, expected))
        totals = paper.paper_totals(questions, layout.pages, expected)
        texts = F.transform(F.array(*[F.lit(x) for x in "ABCD"]), lambda x: F.element_at("options", x)["text"])
        frames = {"questions": questions, "totals": totals, "reports": report.paper_report(questions.withColumn("option_texts", texts), totals)}
        judged = ("questions", "totals")
    sinks.write_run(frames | {"failed_files": failed}, out)
    written = [found.sparkSession.read.schema("status string").json(f"{out}/{n}") for n in judged]
    return int(not failed.isEmpty() or any(not w.where(F.col("status") != "pass").isEmpty() for w in written))


def _questions(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame | None]:
    """Questions as ``paper.ingest`` takes them, and the files they were read from."""
    if args.questions.endswith(".jsonl"):
        return paper.option_facts(pages.canonical_from_json(spark, args.questions, "questions")), None
    found = pages.read_files(spark, args.questions, pages.with_attempts(READERS[args.reader]))
    layout = _layout(found.where(F.col("error").isNull())).stored(f"{args.out}/layout")
    return paper.canonical(paper.validated(paper.parse_mcq(layout, args.expected_count or DEFAULT_EXPECTED))), found


def _answers(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame | None]:
    if args.answers.endswith(".jsonl"):
        return pages.canonical_from_json(spark, args.answers, "answers"), None
    if args.answers.endswith(".json"):
        return pages.answers_from_json(spark, args.answers), None
    found = pages.read_files(spark, args.answers, pages.with_attempts(READERS[args.reader]))
    text = found.where(F.col("error").isNull()).select("paper_id", "page", F.col("raw_text").alias("text"))
    entries = options.key_entries(text, args.expected_count or DEFAULT_EXPECTED)
    return entries.select("paper_id", F.col("number").alias("pos"), "page", F.col("number").cast("string").alias("question_ref"), "answer", F.lit(None).cast("string").alias("explanation")), found


def ingest(spark: SparkSession, args: argparse.Namespace) -> list[dict[str, str]]:
    """Runs the stages of an ingest and writes what each gives; the stages with their status."""
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    one = spark.range(1).select(paper.run_name(F.lit(args.title).cast("string"), F.lit(args.paper_code), F.lit(args.exam_year), F.lit(now)).alias("id"))
    run_id = args.run_id or one.first()["id"]
    stages, frames = [], {}
    for name, read in (("questions", _questions), ("answers", _answers)):
        try:
            frame, files = read(spark, args)
            sinks.write_run({name: frame} | ({f"{name}_files": paper.documents(files, name)} if files is not None else {}), args.out)
            frames[name] = spark.read.schema(frame.schema).json(f"{args.out}/{name}")
            stages.append((run_id, f"parse_{name}", "succeeded", f"{frames[name].count()} {name}"))
        except Exception as e:  # a stage that fails ends the run, and the manifest says why
            stages.append((run_id, f"parse_{name}", "failed", f"{type(e).__name__}: {e}"[:2000]))
            break
    result = None
    if len(frames) == 2:
        result = paper.ingest(frames["questions"], frames["answers"], run_id, args.expected_count, not args.allow_partial_match)
        sinks.write_run({"matching_report": result["match_report"], "matched_questions": result["records"], "validation_report": result["issues"]}, args.out)
        stages += [tuple(r) for r in result["stages"].collect()]
    if result is not None and args.bank and "options" in result["records"].columns:
        name = args.bank_name or run_id
        records = spark.read.schema(result["records"].schema).json(f"{args.out}/matched_questions")
        bank, identity = F.lit(name), F.struct(F.lit(args.paper_code).alias("paper_code"), F.lit(args.exam_year).alias("source_exam_year"))
        sinks.replace_bank(sinks.bank_row(spark, name, [args.questions, args.answers]), f"{args.bank}/question_banks", name)
        sinks.replace_bank(sinks.full_question_rows(records, bank, identity), f"{args.bank}/questions", name)
        sinks.replace_bank(sinks.full_option_rows(records, bank), f"{args.bank}/question_options", name)
        stages.append((run_id, "bank", "succeeded", f"{records.count()} questions in {name}"))
    manifest = spark.createDataFrame(stages, "run_id string, stage string, status string, message string")
    extra = {"paper_code": args.paper_code, "exam_year": args.exam_year, "title": args.title, "expected_question_count": args.expected_count or 0, "versions": VERSIONS}
    sinks.write_run({"document_manifest": manifest.withColumn("run", F.lit(json.dumps(extra)))}, args.out)
    return [dict(zip(("run_id", "stage", "status", "message"), s)) for s in stages]


if __name__ == "__main__":
    sys.exit(main())
