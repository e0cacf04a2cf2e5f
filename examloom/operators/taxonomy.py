"""Syllabus text to topics and subtopics, read twice: from the table of contents and from the content itself.

Reading a syllabus is a scan with state over one document, so each reading is
a fold in Python over that document's marked lines; documents run in parallel.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How headings, topics and subtopics look.
TOPIC = re.compile(r"^\s*(\d{1,2})\.\s+([A-Za-z].+?)\s*$")
TOPIC_NUMBER = re.compile(r"^\s*(\d{1,2})\.\s*$")
SUBTOPIC = re.compile(r"^\s*(\d{1,2}\.\d+)\s+([A-Za-z].+?)\s*$")
SECTION_LINE = re.compile(r"(?i)^SECTION\s+[IVX]+\s*:\s*(.+)$")
SECTION_ALONE = re.compile(r"(?i)^SECTION\s+[IVX]+\s*:?\s*$")
CONTENTS_SECTION = re.compile(r"^\s*(?:SECTION\s+)?([IVX]+)(?:\.|\s*[:\-]|\s)\s*(.+?)\s*$")
ROMAN_ALONE = re.compile(r"^\s*[IVX]+\.\s*$")
CONTENT, CONTENTS = re.compile(r"(?i)SUBJECT\s+CONTENT"), re.compile(r"(?i)CONTENT\s+STRUCTURE")
END = re.compile(r"(?i)SUMMARY\s+OF\s+KEY\s+QUANTITIES.*|PRACTICAL\s+ASSESSMENT|NOTES\s+FOR\s+QUALITATIVE\s+ANALYSIS")
COLUMN_HEADS = {"SECTIONS", "TOPICS", "PAGE"}
HEADS = {"content", "learning outcomes", "overview"}
OUTCOME_HEADS = {"content", "learning outcomes", "candidates should be able to:"}
CONTENTS_LINES, MOST_TOPICS, SHORT_TITLE = 60, 20, 3
_CHARACTERS = {0x00A0: " ", 0x2009: " ", 0xFB01: "fi", 0xFB02: "fl"}

TOPICS = "array<struct<number:int,title:string,section:string,subtopics:array<struct<code:string,title:string,outcomes:string>>>>"


def clean_lines(text: str) -> list[str]:
    return [line.translate(_CHARACTERS).strip() for line in (text or "").splitlines()]


def _last_heading(lines: list[str], heading: re.Pattern[str]) -> int | None:
    """The last line that is a heading; failing that, the last that holds it."""
    for test in (heading.fullmatch, heading.search):
        found = [i for i, line in enumerate(lines) if test(line)]
        if found:
            return found[-1]
    return None


def contents_block(lines: list[str]) -> list[str]:
    start = _last_heading(lines, CONTENTS)
    if start is None:
        return []
    rest = range(start + 1, len(lines))
    return lines[start : next((i for i in rest if CONTENT.search(lines[i])), start + CONTENTS_LINES)]


def content_block(lines: list[str]) -> list[str]:
    start = _last_heading(lines, CONTENT)
    if start is None:
        return lines
    rest = range(start + 1, len(lines))
    return lines[start : next((i for i in rest if END.fullmatch(lines[i])), len(lines))]


def _title(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip(" :-")


def marks(lines: Iterable[str], contents: bool) -> Iterator[tuple]:
    """Lines as marks: ("section", title), ("topic", number, title), ("subtopic", code, title) or ("text", line).

    A section or topic number may stand alone; the next line that begins with
    a letter is its title (for a topic it must be the very next). In a table
    of contents a section needs its Roman numeral in capitals and a separator:
    a line that merely begins with i, v or x is no section.
    """
    section_open, number_open = False, None
    alone = ROMAN_ALONE if contents else SECTION_ALONE
    for line in filter(None, lines):
        if contents and line.upper() in COLUMN_HEADS:
            continue
        letter = line[0].isascii() and line[0].isalpha()
        if alone.match(line):
            section_open = True
            continue
        if section_open and letter:
            section_open = False
            yield "section", _title(line)
            continue
        if contents and (m := CONTENTS_SECTION.match(line)) and not _title(m[2]).isdigit() and _title(m[2]):
            yield "section", _title(m[2])
            continue
        if not contents and (m := SECTION_LINE.match(line)):
            yield "section", _title(m[1])
            continue
        pending, number_open = number_open, None
        if pending is not None and letter and line.lower() not in HEADS:
            yield "topic", pending, line
        elif m := TOPIC.match(line):
            if 1 <= int(m[1]) <= MOST_TOPICS and len(m[2]) > SHORT_TITLE:
                yield "topic", int(m[1]), m[2]
            elif not contents:
                yield "text", line
        elif m := TOPIC_NUMBER.match(line):
            number_open = int(m[1])
        elif m := SUBTOPIC.match(line):
            yield "subtopic", m[1], m[2]
        else:
            yield "text", line


def read_contents(text: str) -> list[dict]:
    """Topics of the table of contents; the first mention of a number counts, titles of up to three letters don't."""
    section, topics = None, {}
    for mark in marks(contents_block(clean_lines(text)), contents=True):
        if mark[0] == "section":
            section = mark[1]
        elif mark[0] == "topic" and len(mark[2]) > SHORT_TITLE:
            topics.setdefault(mark[1], {"number": mark[1], "title": mark[2], "section": section, "subtopics": []})
    return [topics[n] for n in sorted(topics)]


def read_content(text: str) -> list[dict]:
    """Topics with subtopics and their outcomes from the content; a code that comes again replaces its forerunner."""
    section, topics, topic, sub = None, {}, None, None
    for mark in marks(content_block(clean_lines(text)), contents=False):
        if mark[0] == "section":
            section = mark[1]
        elif mark[0] == "topic":
            topic, sub = {"number": mark[1], "title": mark[2], "section": section, "subtopics": {}}, None
            topics[mark[1]] = topic
        elif mark[0] == "subtopic":
            if topic is None:
                number = int(mark[1].split(".")[0])
                topic = topics.setdefault(number, {"number": number, "title": f"Topic {number}", "section": section, "subtopics": {}})
            topic["subtopics"].pop(mark[1], None)
            sub = topic["subtopics"][mark[1]] = {"code": mark[1], "title": mark[2], "outcomes": []}
        elif sub is not None and mark[1].lower() not in OUTCOME_HEADS:
            sub["outcomes"].append(mark[1])
    for t in topics.values():
        t["subtopics"] = [s | {"outcomes": " ".join(s["outcomes"])} for s in t["subtopics"].values()]
    return [topics[n] for n in sorted(topics)]


def topics(syllabi: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, number, title, section, subtopics) of every syllabus: both readings merged by number.

    The longer title, the first section that isn't empty, and the content's
    subtopics if it has any.
    """

    @F.pandas_udf(TOPICS)
    def first(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([read_contents(t) for t in texts], dtype=object)

    @F.pandas_udf(TOPICS)
    def second(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([read_content(t) for t in texts], dtype=object)

    a = syllabi.select(id_col, F.explode(first(text_col)).alias("s")).select(id_col, F.col("s.number").alias("number"), "s")
    b = syllabi.select(id_col, F.explode(second(text_col)).alias("d")).select(id_col, F.col("d.number").alias("number"), "d")
    both = a.join(b, [id_col, "number"], "full_outer")
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    longer = filled(F.col("d.title")) & (F.length("d.title") > F.coalesce(F.length("s.title"), F.lit(0)))
    return both.select(
        id_col,
        "number",
        F.when(longer, F.col("d.title")).otherwise(F.col("s.title")).alias("title"),
        F.when(filled(F.col("s.section")), F.col("s.section")).otherwise(F.col("d.section")).alias("section"),
        F.when(F.size("d.subtopics") > 0, F.col("d.subtopics")).otherwise(F.coalesce("s.subtopics", "d.subtopics")).alias("subtopics"),
    )


def leaves(found: DataFrame, id_col: str) -> DataFrame:
    """The leaves that questions are classified by: subtopics, or a topic without any; ``leaf`` numbers them in order."""
    exploded = found.select(id_col, "number", "title", "section", F.posexplode_outer("subtopics").alias("at", "sub"))
    return exploded.select(
        id_col,
        (F.col("number") * 1000 + F.coalesce("at", F.lit(0))).alias("leaf"),
        F.coalesce("sub.code", F.col("number").cast("string")).alias("code"),
        F.col("title").alias("topic_title"),
        "section",
        F.col("sub.title").alias("title"),
        F.col("sub.outcomes").alias("outcomes"),
    )
