"""The command line and streams of arriving files."""

import json

from examloom import __main__ as cli
from examloom.operators import matching
from examloom.streaming import arrivals
from pyspark.sql import functions as F


def line(text, x, y, width=200.0):
    return {"text": text, "x0": x, "y0": y, "x1": x + width, "y1": y + 12, "block_index": 0, "line_no": 0}


def test_parse_command(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    assert cli.main(["parse", str(folder), str(out), "--expected", "1"]) == 2
    lines = [line("1 Which metal is it?", 77.0, 80.0)] + [line(f"{c} metal {c.lower()}", 101.0, 120.0 + 20 * i) for i, c in enumerate("ABCD")]
    (folder / "p.json").write_text(json.dumps([{"page": 1, "width": 595.3, "height": 841.9, "lines": lines, "images": [], "tables": []}]))
    assert cli.main(["parse", str(folder), str(out), "--expected", "1"]) == 0
    text = spark.read.json(f"{out}/reports").first()["report"]
    assert "Q1 [pass] Which metal is it?" in text and "D: metal d" in text
    assert cli.main(["parse", str(folder), str(out), "--expected", "2"]) == 1


def test_streams(spark, tmp_path):
    arrive = tmp_path / "answers"
    arrive.mkdir()
    rows = [{"paper_id": "p", "pos": i, "page": 1, "question_ref": f"Q{n}", "answer": "A", "explanation": None} for i, n in enumerate((1, 2, 2))]
    (arrive / "a.json").write_text("\n".join(map(json.dumps, rows)))
    merge = lambda df: matching.merge_answer_pages(df, ["paper_id", "question_ref"], F.struct("page", "pos"))
    for _ in range(2):
        query = arrivals.each_batch(arrivals.stream(spark, str(arrive), "answers"), merge, str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    counts = arrivals.reference_counts(arrivals.stream(spark, str(arrive), "answers"))
    query = counts.writeStream.outputMode("complete").format("memory").queryName("arrived").trigger(availableNow=True).start()
    query.awaitTermination()
    got = arrivals.arrived_totals(spark.table("arrived"), 3).first()
    assert (got["detected"], got["missing"], got["duplicate"]) == (3, [3], [2])


def canonical(ref, **more):
    base = {"paper_id": "p", "pos": int(ref), "page": 1, "question_ref": ref, "content": [{"type": "text", "value": f"stem {ref}"}], "source_regions": [{"page": 1, "bbox": None}], "requires_review": False}
    items = [{"label": x, "content": f"{x}{ref}", "latex": None, "asset": None} for x in "ABCD"]
    return base | {"options": {"mode": "text", "items": items}} | more


def test_ingest_command(spark, tmp_path, capsys):
    questions = [canonical("1"), canonical("2", options={"mode": "table", "columns": ["x", "y"], "rows": [{"label": x, "cells": [x, "1"]} for x in "ABCD"]}), canonical("3", options={"mode": "composite_visual", "labels": list("ABCD"), "asset": "q03-options.png"})]
    answers = [{"paper_id": "k", "pos": i, "page": 1, "question_ref": r, "answer": "B", "explanation": "why" if i else None} for i, r in enumerate(("Q1", "02", "3"))]
    q, a, out, bank = (str(tmp_path / n) for n in ("q.jsonl", "a.jsonl", "out", "bank"))
    open(q, "w").write("\n".join(map(json.dumps, questions)))
    open(a, "w").write("\n".join(map(json.dumps, answers)))
    assert cli.main(["ingest", q, a, out, "--run-id", "r", "--expected-count", "3", "--bank", bank, "--bank-name", "b"]) == 1  # the picture of question 3 is missing
    stages = {r["stage"]: r["status"] for r in spark.read.json(f"{out}/document_manifest").collect()}
    assert stages == {"parse_questions": "succeeded", "parse_answers": "succeeded", "match": "succeeded", "validate": "failed", "bank": "succeeded"}
    assert [(r["question_ref"], r["code"]) for r in spark.read.json(f"{out}/validation_report").collect()] == [("3", "MISSING_ASSET_FILE")]
    rows = {r["number"]: r for r in spark.read.parquet(f"{bank}/questions").collect()}
    assert len(rows["1"].asDict()) == 27 and rows["1"]["stem"] == "stem 1" and rows["1"]["status"] == "DRAFT" and rows["3"]["status"] == "NEEDS_REVIEW" and rows["1"]["syllabus_code"] == "6092"
    assert json.loads(rows["2"]["answer_source"]) == {"value": "B", "explanation": "why", "explanation_source": "mark_scheme"}
    texts = {(r["question_id"], r["label"]): (r["text"], r["is_correct"]) for r in spark.read.parquet(f"{bank}/question_options").collect()}
    assert texts[rows["2"]["id"], "B"] == ("B | 1", True) and texts[rows["3"]["id"], "A"] == ("[composite visual]", False) and len(texts) == 12
    assert cli.main(["ingest", q, str(tmp_path / "none.jsonl"), str(tmp_path / "out2")]) == 1
    assert [s["status"] for s in json.loads(capsys.readouterr().out.split("]\n")[-2] + "]")] == ["succeeded", "failed"]


def test_ingest_of_pages_and_structured_papers(spark, tmp_path):
    folder, key, out = tmp_path / "in", tmp_path / "key", tmp_path / "out"
    folder.mkdir()
    key.mkdir()
    lines = [line("1 Which metal is it?", 77.0, 80.0)] + [line(f"{c} metal {c.lower()}", 101.0, 120.0 + 20 * i) for i, c in enumerate("ABCD")]
    (folder / "p.json").write_text(json.dumps([{"page": 1, "width": 595.3, "height": 841.9, "lines": lines, "images": [], "tables": []}]))
    (key / "k.json").write_text(json.dumps([{"page": 1, "width": 1.0, "height": 1.0, "raw_text": "Answers\n1 C", "lines": [], "images": [], "tables": []}]))
    assert cli.main(["ingest", str(folder), str(key), str(out), "--expected-count", "1", "--title", "P 1"]) == 0
    record = spark.read.json(f"{out}/matched_questions").first()
    assert (record["question_ref"], record["answer"], record["status"], record["content"][0]["value"]) == ("1", "C", "DRAFT", "Which metal is it?")
    assert spark.read.json(f"{out}/document_manifest").first()["run_id"].startswith("P-1-2")
    assert spark.read.json(f"{out}/questions_files").first()["page_count"] == 1
    paper_lines = [line("Ammonia paper", 200.0, 40.0), line("3", 300.0, 50.0), line("Q1 Name it.", 77.0, 80.0), line("(a) Now. [2]", 77.0, 100.0)]
    (folder / "p.json").write_text(json.dumps([{"page": 1, "width": 595.3, "height": 841.9, "lines": paper_lines, "images": [], "tables": []}]))
    assert cli.main(["parse", str(folder), str(out), "--mode", "structured"]) == 0
    assert spark.read.json(f"{out}/titles").first()["title"] == "Ammonia paper"
    assert "(a) [2] Now." in spark.read.json(f"{out}/reports").first()["report"]


def test_environment_file(tmp_path, monkeypatch):
    monkeypatch.setenv("EXAMLOOM_A", "kept")
    monkeypatch.delenv("EXAMLOOM_B", raising=False)
    path = tmp_path / "env"
    path.write_text("# no\nEXAMLOOM_A=1\nEXAMLOOM_B = 'two=2'\n\nbroken\n")
    assert cli.load_env(str(path)) and cli.load_env(str(tmp_path / "none")) is None
    assert (cli.os.environ["EXAMLOOM_A"], cli.os.environ["EXAMLOOM_B"]) == ("kept", "two=2")
    monkeypatch.delenv("EXAMLOOM_B")
