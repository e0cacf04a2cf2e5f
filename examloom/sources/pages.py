"""Page sources: files through a pluggable reader, pre-extracted JSON, plain text, and answer keys as JSON.

Decoding a page format is the reader's business: it gets the bytes of one file
and yields pages. A file that fails gives one row with its error; the job goes
on.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom import schemas

#: Reads the bytes of one file into pages: dicts with page, width, height, raw_text, used_ocr, lines, images and tables.
Reader = Callable[[bytes], Iterable[dict[str, Any]]]

BOXED = "struct<text:string,x0:double,y0:double,x1:double,y1:double,block_index:int,line_no:int,font_size:double,flags:int,reading_order:int>"
IMAGE = "struct<x0:double,y0:double,x1:double,y1:double,block_index:int>"
TABLE = "struct<x0:double,y0:double,x1:double,y1:double,headers:array<string>,rows:array<array<string>>>"
PAGE = f"page int, width double, height double, raw_text string, used_ocr boolean, lines array<{BOXED}>, images array<{IMAGE}>, tables array<{TABLE}>"
EXTRACTED = f"paper_id string, sha256 string, error string, {PAGE}"
LEAST_ROWS, LEAST_COLUMNS, LEAST_CELLS = 2, 2, 3
ATTEMPTS = 3


def json_reader(content: bytes) -> Iterable[dict[str, Any]]:
    """Pages that another program has extracted: a JSON list, or an object with ``pages``."""
    found = json.loads(content)
    return found["pages"] if isinstance(found, dict) else found


def text_reader(content: bytes) -> Iterable[dict[str, Any]]:
    """Pages of plain text, parted by form feeds; their lines get made-up places."""
    for number, text in enumerate(content.decode("utf-8", "replace").split("\f"), 1):
        usable = [s for s in map(str.strip, text.splitlines()) if s]
        height = 841.9 / (len(usable) + 2)
        lines = [{"text": s, "x0": 72.0, "y0": 40 + i * height, "x1": 555.3, "y1": 40 + (i + 1) * height, "block_index": i, "line_no": 0} for i, s in enumerate(usable)]
        yield {"page": number, "width": 595.3, "height": 841.9, "raw_text": text, "used_ocr": False, "lines": lines}


def with_attempts(reader: Reader, attempts: int = ATTEMPTS) -> Reader:
    """A reader that is tried again, without waiting; the last error counts."""

    def read(content: bytes) -> Iterable[dict[str, Any]]:
        for left in range(max(1, attempts) - 1, -1, -1):
            try:
                return list(reader(content))
            except Exception:
                if not left:
                    raise
        return []

    return read


def extract(files: DataFrame, reader: Reader) -> DataFrame:
    """Pages of ``files`` (paper_id, content). Files are read a few at a time; each page is a row, a failed file one row with ``error``."""
    keys = ("page", "width", "height", "raw_text", "used_ocr", "lines", "images", "tables")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for paper, content in zip(batch["paper_id"], batch["content"]):
                content = bytes(content)
                sha = hashlib.sha256(content).hexdigest()
                try:
                    rows += [(paper, sha, None, *[p.get(k) for k in keys]) for p in reader(content)]
                except Exception as e:  # the reader's own errors, whatever they are, belong to its file
                    rows.append((paper, sha, f"{type(e).__name__}: {e}", *[None] * len(keys)))
            yield pd.DataFrame(rows, columns=["paper_id", "sha256", "error", *keys])

    return files.select("paper_id", "content").mapInPandas(run, EXTRACTED)


def read_files(spark: SparkSession, path: str, reader: Reader, glob: str = "*") -> DataFrame:
    """``extract`` over the files of a folder; a file's name is its paper_id."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return extract(files.select(F.element_at(F.split("path", "/"), -1).alias("paper_id"), "content"), reader)


def lines(pages: DataFrame) -> DataFrame:
    return pages.select("paper_id", "page", F.posexplode("lines").alias("pos", "l")).select("paper_id", "page", "pos", "l.*")


def images(pages: DataFrame) -> DataFrame:
    return pages.select("paper_id", "page", F.posexplode("images").alias("pos", "i")).select("paper_id", "page", "pos", "i.*")


def tables(pages: DataFrame) -> DataFrame:
    """Tables worth the name: two rows and columns and three cells that aren't empty, the header's counted."""
    found = pages.select("paper_id", "page", F.posexplode("tables").alias("pos", "t")).select("paper_id", "page", "pos", "t.*")
    cells = F.filter(F.concat(F.flatten("rows"), F.coalesce("headers", F.array().cast("array<string>"))), lambda c: F.coalesce(F.trim(c), F.lit("")) != "")
    width = F.array_max(F.transform("rows", F.size))
    return found.where((F.size("rows") >= LEAST_ROWS) & (F.coalesce(width, F.lit(0)) >= LEAST_COLUMNS) & (F.size(cells) >= LEAST_CELLS))


def page_sizes(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("page").isNotNull()).select("paper_id", "page", "width", "height")


def answers_from_json(spark: SparkSession, path: str) -> DataFrame:
    """An answer key as JSON, ``{"answers": {"Q1": "B", ...}}``, or a list of objects with question_ref and answer; other labels than A to D are an error."""
    read = spark.read.text(path, wholetext=True).withColumn("paper_id", F.element_at(F.split(F.input_file_name(), "/"), -1))
    listed = F.from_json("value", "struct<answers:array<struct<question_ref:string,answer:string>>>")["answers"]
    mapped = F.map_entries(F.from_json("value", "struct<answers:map<string,string>>")["answers"])
    pairs = F.coalesce(mapped.cast("array<struct<question_ref:string,answer:string>>"), listed)
    rows = read.select("paper_id", F.posexplode(pairs).alias("pos", "a"))
    letter = F.upper(F.trim("a.answer"))
    known = F.when(letter.isin("A", "B", "C", "D"), letter).otherwise(F.raise_error(F.concat(F.lit("no option label: "), F.coalesce(letter, F.lit("null")))).cast("string"))
    return rows.select("paper_id", "pos", F.lit(None).cast("int").alias("page"), F.col("a.question_ref").alias("question_ref"), known.alias("answer"), F.lit(None).cast("string").alias("explanation"))


def canonical_from_json(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Questions or answers that an extractor has written as JSON lines, by declared schema; a malformed line fails the read."""
    return spark.read.schema({"questions": schemas.QUESTIONS, "answers": schemas.ANSWERS}[kind]).option("mode", "FAILFAST").json(path)
