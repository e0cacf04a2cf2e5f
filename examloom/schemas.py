"""Declared schemas of the engine's inputs; nothing is inferred.

``layout`` tables come from page readers, ``canonical`` ones from extractors.
A ``pos`` column keeps the order in which a source gave its rows.
"""

from __future__ import annotations

BOX = "x0 double, y0 double, x1 double, y1 double"
LINES = f"paper_id string, page int, pos int, text string, {BOX}, block_index int, line_no int, font_size double, flags int, reading_order int"
IMAGES = f"paper_id string, page int, pos int, {BOX}, block_index int"
TABLES = f"paper_id string, page int, pos int, {BOX}, headers array<string>, rows array<array<string>>"
PAGES = "paper_id string, page int, width double, height double, raw_text string, used_ocr boolean"

BLOCK = "type string, value string, latex string, columns array<string>, rows array<array<string>>, asset string, bbox array<double>, items array<string>"
OPTIONS = (
    "mode string, items array<struct<label:string,content:string,latex:string,asset:string>>, columns array<string>, "
    "rows array<struct<label:string,cells:array<string>>>, labels array<string>, asset string, bbox array<double>"
)
_FIELDS = lambda s: ",".join(f.replace(" ", ":", 1) for f in s.split(", "))
QUESTIONS = (
    f"paper_id string, pos int, page int, question_ref string, content array<struct<{_FIELDS(BLOCK)}>>, options struct<{_FIELDS(OPTIONS)}>, "
    "source_regions array<struct<page:int,bbox:array<double>>>, requires_review boolean"
)
ANSWERS = "paper_id string, pos int, page int, question_ref string, answer string, explanation string"
STAGES = "run_id string, stage string, status string, message string"
