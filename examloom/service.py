"""A small HTTP service over the command line's flows: uploads to ingest, and pages to look at what a run gave.

GET /health; POST /ingest/mcq (a form with question_pdf and answer_pdf, and
title, year, paper_code, expected_question_count, run_id); GET / lists the runs,
GET /RUN shows the questions of one. For a desk, not for the open net: there is
no login, and uploads are ingested one after the other.
"""

from __future__ import annotations

import html
import json
import os
import re
import socket
import threading
import uuid
from email import message_from_bytes
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from examloom import __main__ as cli

MOST_BYTES = 200 << 20
ATTEMPTS = 20
MOST_SHOWN = 500
RUN_NAME = re.compile(r"[A-Za-z0-9_-]{1,100}")


class Refused(ValueError):
    """The caller's fault: answered with 400."""


def form(content_type: str, body: bytes) -> dict[str, tuple[str | None, bytes]]:
    """The parts of an uploaded form: name to file name and content."""
    message = message_from_bytes(b"Content-Type: " + content_type.encode() + b"\r\n\r\n" + body)
    if not message.is_multipart():
        raise Refused("a form with files is expected")
    return {part.get_param("name", header="content-disposition"): (part.get_filename(), part.get_payload(decode=True) or b"") for part in message.get_payload()}


def ingest_upload(spark: SparkSession, root: str, parts: dict[str, tuple[str | None, bytes]]) -> dict[str, Any]:
    """Puts the two files into the run's folder and ingests them."""
    text = {k: v.decode("utf-8", "replace").strip() for k, (name, v) in parts.items() if name is None}
    run = text.get("run_id") or f"upload-{uuid.uuid4().hex[:12]}"
    if not RUN_NAME.fullmatch(run):
        raise Refused("run_id holds letters, digits, - and _ only")
    out = f"{root}/{run}"
    for field in ("question_pdf", "answer_pdf"):
        name, content = parts.get(field, (None, b""))
        if not name or not name.lower().endswith(".pdf"):
            raise Refused(f"{field} must be a PDF")
        os.makedirs(f"{out}/{field}", exist_ok=True)
        with open(f"{out}/{field}/{os.path.basename(name)}", "wb") as f:
            f.write(content)
    line = ["ingest", f"{out}/question_pdf", f"{out}/answer_pdf", out, "--reader", "pdf", "--run-id", run, "--title", text.get("title") or parts["question_pdf"][0]]
    for field, option in (("year", "--exam-year"), ("paper_code", "--paper-code"), ("expected_question_count", "--expected-count")):
        if text.get(field):
            line += [option, text[field]]
    try:
        args = cli.parser().parse_args(line)
    except SystemExit:
        raise Refused("a field has a wrong value") from None
    stages = cli.ingest(spark, args)
    kinds = ("questions", "answers", "matched_questions", "validation_report")
    return {"run_id": run, "ok": all(s["status"] == "succeeded" for s in stages), "output_dir": out, "stages": stages, "expected_question_count": args.expected_count, "artifacts": {k: f"{out}/{k}" for k in kinds}}


def run_page(spark: SparkSession, root: str, run: str) -> str:
    """The questions of a run as a page."""
    rows = spark.read.schema("question_ref string, answer string, status string, content array<struct<type:string,value:string>>").json(f"{root}/{run}/matched_questions")
    shown = rows.withColumn("stem", F.array_join(F.transform("content", lambda b: b["value"]), " ")).orderBy(F.length("question_ref"), "question_ref").limit(MOST_SHOWN).collect()
    cells = "".join(f"<tr><td>{html.escape(r['question_ref'] or '')}<td>{html.escape(r['stem'] or '')}<td>{html.escape(r['answer'] or '')}<td>{html.escape(r['status'] or '')}" for r in shown)
    return f"<h1>{html.escape(run)}</h1><table border=1><tr><th>Question<th>Stem<th>Answer<th>Status{cells}</table>"


def handler(spark: SparkSession, root: str) -> type[BaseHTTPRequestHandler]:
    one = threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def answer(self, code: int, body: Any) -> None:
            page = isinstance(body, str)
            data = (f"<!doctype html><meta charset=utf-8>{body}" if page else json.dumps(body)).encode()
            self.send_response(code)
            self.send_header("Content-Type", "text/html; charset=utf-8" if page else "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self) -> None:
            path = self.path.split("?")[0].strip("/")
            runs = sorted(n for n in os.listdir(root) if RUN_NAME.fullmatch(n)) if os.path.isdir(root) else []
            if path == "health":
                self.answer(200, {"status": "ok"})
            elif not path:
                self.answer(200, "<h1>Runs</h1><ul>" + "".join(f'<li><a href="/{n}">{n}</a>' for n in runs) + "</ul>")
            elif path in runs and os.path.isdir(f"{root}/{path}/matched_questions"):
                self.answer(200, run_page(spark, root, path))
            else:
                self.answer(404, {"detail": "not found"})

        def do_POST(self) -> None:
            size = int(self.headers.get("Content-Length") or 0)
            if self.path.strip("/") != "ingest/mcq":
                return self.answer(404, {"detail": "not found"})
            if size > MOST_BYTES:
                return self.answer(413, {"detail": f"at most {MOST_BYTES} bytes"})
            try:
                parts = form(self.headers.get("Content-Type") or "", self.rfile.read(size))
                with one:
                    self.answer(200, ingest_upload(spark, root, parts))
            except Refused as e:
                self.answer(400, {"detail": str(e)})
            except Exception as e:  # the service outlives a failed run
                self.answer(500, {"detail": f"{type(e).__name__}: {e}"[:1000]})

        def log_message(self, *args: Any) -> None:
            pass

    return Handler


def free_port(host: str, wanted: int, attempts: int = ATTEMPTS) -> int:
    """The wanted port, or the next one that nobody listens on."""
    for port in range(wanted, wanted + attempts):
        with socket.socket() as s:
            s.setsockopt(socket.SOL_SOCKET, socket.SO_REUSEADDR, 1)
            try:
                s.bind((host, port))
                return port
            except OSError:
                continue
    raise OSError(f"no free port from {wanted} on")


def server(spark: SparkSession, host: str, port: int, root: str) -> ThreadingHTTPServer:
    return ThreadingHTTPServer((host, free_port(host, port)), handler(spark, root))


def serve(spark: SparkSession, host: str, port: int, root: str) -> None:
    with server(spark, host, port, root) as http:
        print(f"http://{host}:{http.server_port}/")
        try:
            http.serve_forever()
        except KeyboardInterrupt:
            pass
