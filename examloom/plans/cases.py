"""Registered queries over small papers written down here, as the shared tables hold none; what they must give is written down as well."""

from __future__ import annotations

import json
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom import schemas
from examloom.functions import boxes
from examloom.operators import blocks, classify, crops, evaluation, figures, layout, matching, options, report, spatial, taxonomy, validation
from examloom.plans import paper
from examloom.plans.registration import expected, query
from examloom.sources import extractors, png


class Page:
    """Lines, images and tables of one paper, in order."""

    def __init__(self, name: str):
        self.name, self.lines, self.images, self.tables = name, [], [], []

    def line(self, text: str, x: float = 101.3, y: float = 100.0, page: int = 1, x1: float | None = None) -> Page:
        end = x + max(12, 6 * len(text)) if x1 is None else x1
        self.lines.append((self.name, page, len(self.lines), text, float(x), float(y), float(end), float(y + 12), 0, 0, 10.0, 0, None))
        return self

    def number(self, n: int, stem: str = "", y: float = 80.0, page: int = 1) -> Page:
        return self.line(f"{n} {stem}" if stem else str(n), 77.2, y, page, 400.0 if stem else 87.2)

    def choices(self, texts: list[str], y: float, page: int = 1, x: float = 129.0) -> Page:
        for i, (label, text) in enumerate(zip("ABCD", texts)):
            self.line(label, y=y + 20 * i, page=page).line(text, x, y + 20 * i, page)
        return self

    def image(self, x0: float, y0: float, x1: float, y1: float, page: int = 1) -> Page:
        self.images.append((self.name, page, len(self.images), float(x0), float(y0), float(x1), float(y1), 0))
        return self

    def table(self, x0: float, y0: float, x1: float, y1: float, headers: list[str], rows: list[list[str]], page: int = 1) -> Page:
        self.tables.append((self.name, page, len(self.tables), float(x0), float(y0), float(x1), float(y1), headers, rows))
        return self


def laid_out(spark: SparkSession, papers: list[Page]) -> paper.Layout:
    frame = lambda name, schema: spark.createDataFrame([r for p in papers for r in getattr(p, name)], schema)
    sizes = sorted({(r[0], r[1], 595.3, 841.9, "", False) for p in papers for rows in (p.lines, p.images, p.tables) for r in rows})
    return paper.Layout(frame("lines", schemas.LINES), frame("images", schemas.IMAGES), frame("tables", schemas.TABLES), spark.createDataFrame(sizes, schemas.PAGES))


def _mcq_papers() -> list[Page]:
    several = Page("several").number(1).line("The first line of a stem", y=80).line("and the second", y=95).line("and a third?", y=110)
    several.choices(["one", "two", "three", "four"], 140).line("goes on", 129.0, 147)
    two = Page("two").number(1, "Which is one?").choices(["red", "blue", "green", "10 cm3"], 100).number(2, "What is two?", 220).line("25", 174.0, 230).choices(["a b", "c d", "e f", "g h"], 250)
    two.number(40, "August", 400).line("Turn over", y=500).line("page foot", y=830)
    columns = Page("columns").number(1, "How many protons are there?").line("A student is given a table of them", y=100)
    for i, cells in enumerate(["16 18 14", "16 18 18", "18 16 14", "18 18 16"]):
        columns.line("ABCD"[i], y=120 + 20 * i)
        for k, cell in enumerate(cells.split()):
            columns.line(cell, 150.0 + 60 * k, 120 + 20 * i)
    inline = Page("inline").number(1, "Which statements are correct?").line("A 1, 2 and 3 B 1 and 2 only C 2 and 3 only D 3 only", y=120)
    inline.number(2, "Which substance is a base?", 200).line("A ammonium chloride", y=220).line("B sodium oxide", y=240).line("C water", y=260).line("D wax", y=280)
    turned = Page("turned").number(1, "The values are shown in the two tables here?", 700).line("first value", y=720).line("second value", y=80, page=2).choices(["x one", "x two", "x three"], 100, 2)
    pictures = Page("pictures").number(1, "Which structure is shown below?")
    for label, x, y in (("A", 101.3, 200), ("B", 329.2, 200), ("C", 101.3, 360), ("D", 329.2, 360)):
        pictures.line(label, x, y).image(x + 20, y, x + 120, y + 100)
    tables = Page("tables").number(1, "The table gives data about four gases.").line("gas", 120.0, 120).line("density", 300.0, 120).table(100, 100, 540, 200, ["gas", "density"], [["x", "1"], ["y", "2"]])
    tables.line("Which gas is light?", y=210).choices(["w", "x", "y", "z"], 230).number(2, "Which row is correct?", 400).line("0.5", 220.0, 430).image(200, 420, 400, 440)
    tables.table(100, 445, 540, 505, ["", "acid", "base"], [["A", "2, 1", "2, 7"], ["B", "1", "7"], ["C 3", "5", ""], ["x", "y", "D"]])
    graph = Page("graph").number(1, "The heating curve is of which substance?").image(120, 120, 400, 300).choices(["ice", "wax", "tin", "lead"], 320)
    normal = Page("normal").number(1, "Which metal is extracted by electrolysis of its ore?").choices(["iron and calcium", "zinc and copper", "sodium only", "gold only"], 120)
    return [normal, several, two, columns, inline, turned, pictures, tables, graph]


MCQ_COLUMNS = "paper_id VARCHAR, number INT, stem VARCHAR, a VARCHAR, b VARCHAR, c VARCHAR, d VARCHAR, page_start INT, page_end INT, n_images BIGINT, visual_required BOOLEAN, top DOUBLE, bottom DOUBLE"
MCQ_ROWS = [
    ("normal", 1, "Which metal is extracted by electrolysis of its ore?", "iron and calcium", "zinc and copper", "sodium only", "gold only", 1, 1, 0, False, 80.0, 192.0),
    ("several", 1, "The first line of a stem and the second and a third?", "one goes on", "two", "three", "four", 1, 1, 0, False, 80.0, 212.0),
    ("two", 1, "Which is one?", "red", "blue", "green", "10 cm3", 1, 1, 0, False, 80.0, 172.0),
    ("two", 2, "What is two? 25", "a b", "c d", "e f", "g h 40 August", 1, 1, 0, False, 220.0, 412.0),
    ("columns", 1, "How many protons are there? A student is given a table of them", "16 18 14", "16 18 18", "18 16 14", "18 18 16", 1, 1, 0, False, 80.0, 192.0),
    ("inline", 1, "Which statements are correct?", "1, 2 and 3", "1 and 2 only", "2 and 3 only", "3 only", 1, 1, 0, False, 80.0, 132.0),
    ("inline", 2, "Which substance is a base?", "ammonium chloride", "sodium oxide", "water", "wax", 1, 1, 0, False, 200.0, 292.0),
    ("turned", 1, "The values are shown in the two tables here? first value second value", "x one", "x two", "x three", None, 1, 2, 0, True, 700.0, 732.0),
    ("pictures", 1, "Which structure is shown below?", None, None, None, None, 1, 1, 4, True, 80.0, 460.0),
    ("tables", 1, "The table gives data about four gases. Which gas is light?", "w", "x", "y", "z", 1, 1, 0, False, 80.0, 302.0),
    ("tables", 2, "Which row is correct?", "2, 1 | 2, 7", "1 | 7", "3 5", "x | y", 1, 1, 1, False, 400.0, 442.0),
    ("graph", 1, "The heating curve is of which substance?", "ice", "wax", "tin", "lead", 1, 1, 1, True, 80.0, 392.0),
]


@query(expected(MCQ_COLUMNS, MCQ_ROWS))
def mcq_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine multiple-choice papers from layout to questions: stems and options over lines, columns, tables and pictures, traps, a turn of the page."""
    rows = paper.parse_mcq(laid_out(spark, _mcq_papers()), 10)
    texts = [F.element_at("options", x)["text"].alias(x.lower()) for x in "ABCD"]
    return rows.select("paper_id", "number", "stem", *texts, "page_start", "page_end", "n_images", "visual_required", F.col("box.y0").alias("top"), F.col("box.y1").alias("bottom"))


@query(
    expected(
        "number INT, status VARCHAR, codes VARCHAR",
        [
            (1, "pass", ""),
            (2, "review", "MISSING_OPTION"),
            (3, "review", "VISUAL_OPTION_EXTRACTION_PENDING,VISUAL_OPTION_EXTRACTION_PENDING,VISUAL_OPTION_EXTRACTION_PENDING,VISUAL_OPTION_EXTRACTION_PENDING,VISUAL_EXTRACTION_PENDING"),
            (4, "pass", ""),
            (5, "pass", "MISSING_BOUNDING_BOX"),
            (6, "review", "EMPTY_STEM,MISSING_OPTION_TEXT"),
        ],
    )
)
def mcq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed questions checked: a good one, a missing option, pictures still to be cut out and cut out, no place on the page, empty texts."""
    box, text = (0.0, 0.0, 9.0, 9.0), {x: (x.lower(), False) for x in "ABCD"}
    drawn = {x: (None, True) for x in "ABCD"}
    rows = [
        ("p", 1, "stem", text, box, False), ("p", 2, "stem", {k: v for k, v in text.items() if k != "D"}, box, False), ("p", 3, "stem", drawn, box, True), ("p", 4, "stem", drawn, box, True),
        ("p", 5, "stem", text, None, False), ("p", 6, " ", text | {"B": (" ", False)}, box, False),
    ]
    questions = spark.createDataFrame(rows, "paper_id string, number int, stem string, options map<string,struct<text:string,requires_visual:boolean>>, box struct<x0:double,y0:double,x1:double,y1:double>, visual_required boolean")
    assets = spark.createDataFrame([("p", 4, None), ("p", 4, "stem")], "paper_id string, number int, label string")
    checked = paper.validated(questions, assets)
    return checked.select("number", "status", F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"))


@query(
    expected(
        "question INT, part VARCHAR, parent VARCHAR, prompt VARCHAR, marks INT, marks_total INT, title VARCHAR",
        [
            (1, "a", None, "Name the process.", None, 4, "Pure chemistry 7 parts"),
            (1, "i", "a", "State the catalyst.", 1, 4, "Pure chemistry 7 parts"),
            (1, "ii", "a", "Give the temperature.", 1, 4, "Pure chemistry 7 parts"),
            (1, "b", None, "Explain the diagram shows.", 2, 4, "Pure chemistry 7 parts"),
            (2, "v", None, "alone", None, None, "Pure chemistry 7 parts"),
        ],
    )
)
def structured_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A structured paper from layout to nested parts with marks, up to its answers, and its title."""
    page = Page("p").line("Pure chemistry", y=50).line("3", 300.0, 60).line("7 parts", 300.0, 70)
    page.line("Q1 Ammonia is made from nitrogen.", 77.0, 80).line("(a) Name the process.", y=100).line("(i) State the catalyst. [1]", y=120).line(".......", y=130).line("(ii) Give the", y=140).line("temperature. [1]", y=150)
    page.line("(b) Explain the diagram shows. [2]", y=160).line("[Total: 4]", y=180).line("Q2 Second", 77.0, 200).line("7", y=210).line("(v) alone", y=220).line("Answers", y=300).line("Q1 Haber", 77.0, 320).line("Q3 no", 77.0, 340)
    found = laid_out(spark, [page])
    questions, parts = paper.parse_structured(found)
    roots = parts.select("question", F.col("part").alias("parent"), F.col("label").alias("root"))
    rows = parts.join(roots, ["question", "parent"], "left").join(questions.select("question", "marks_total"), "question").join(paper.titles(found))
    return rows.select("question", F.col("label").alias("part"), F.col("root").alias("parent"), "prompt", "marks", "marks_total", "title")


@query(
    expected(
        "n INT, role VARCHAR, headers VARCHAR, body VARCHAR",
        [
            (1, "options", ";section;description", "A;P to Q;The particles move/B;Q to R;They melt"),
            (2, "options", ";x;", "A;1;iron 2/B;3;"),
            (3, "options", ";h", "A | B | C | D;"),
            (4, "options", ";a;b", "A;1;2/B;3;4/C;5;6/D;7;8"),
            (5, "stem", None, None),
        ],
    )
)
def option_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of options: the label's column found, put first and named; whether a table belongs to the options or to the stem."""
    rows = [
        (1, ["section", "description", "Unnamed: 0"], [["P to Q", "The particles  move", "A"], ["Q to R", "They melt", "B"], ["note", "x", "y"]]),
        (2, ["x"], [["A iron", "1", "2"], ["B", "3"]]),
        (3, ["h"], [["A | B | C | D", ""]]),
        (4, ["", "a", "b"], [["A", "1", "2"], ["B", "3", "4"], ["C", "5", "6"], ["D", "7", "8"]]),
        (5, ["gas"], [["gas", "A"], ["x", "y"]]),
    ]
    frame = spark.createDataFrame(rows, "n int, h array<string>, r array<array<string>>")
    made = frame.select("n", options.table_role(F.col("r")).alias("role"), options.option_matrix(F.col("h"), F.col("r")).alias("m"))
    return made.select("n", "role", F.when(F.col("role") == "options", F.array_join("m.headers", ";")).alias("headers"), F.when(F.col("role") == "options", F.array_join(F.transform("m.rows", lambda r: F.array_join(r, ";")), "/")).alias("body"))


LISTED = "A: iron\nB: zinc\nD: lead"


@query(
    expected(
        "n INT, pos INT, type VARCHAR, text VARCHAR, asset_path VARCHAR",
        [
            (1, 0, "text", "Which is right?", None), (1, 1, "diagram", None, "1.png"), (1, 2, "table", None, None), (1, 3, "diagram", None, "2.png"), (1, 4, "options", LISTED, None),
            (2, 0, "text", "Stem alone", None), (2, 1, "table", None, None), (2, 2, "options", None, "o.png"),
            (3, 0, "options", LISTED, None),
        ],
    )
)
def content_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of questions put in order: labels of figures, leaked options and repeats dropped, diagrams given their files, options last."""
    raw = [("text", t) for t in ("Full stem here", "Which is right?", "which  is right?", "A: iron", "Label X", "iron zinc", "A iron B zinc C tin D lead", "Test 3 warming it with acid")] + [("diagram", None)] * 2 + [("table", None)]
    block = lambda pairs: [(k, t, False, None, None) for k, t in pairs]
    opts = [("A", "iron"), ("B", "zinc"), ("C", None), ("D", "lead")]
    rows = [(1, block(raw), "s", opts, True, False, ["1.png", "2.png"], None), (2, block([("text", "Stem alone"), ("diagram", None), ("table", None)]), "s", opts, False, True, [], "o.png"), (3, [], "s", opts, False, False, [], None)]
    schema = f"n int, raw_blocks array<{blocks.BLOCK}>, stem string, options array<struct<label:string,text:string>>, has_diagram boolean, visual_options boolean, stem_paths array<string>, option_path string"
    found = blocks.content(spark.createDataFrame(rows, schema))
    return found.select("n", F.posexplode("content").alias("pos", "b")).select("n", "pos", "b.type", "b.text", "b.asset_path")


@query(
    expected(
        "n INT, promoted BOOLEAN, images BIGINT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE",
        [(1, True, 1, 0.0, 0.0, 9.0, 9.0), (2, False, 1, 0.0, 0.0, 9.0, 9.0), (3, True, 2, 0.0, 0.0, 29.0, 120.0), (4, False, 1, 0.0, 0.0, 9.0, 9.0), (5, False, 0, None, None, None, None), (6, True, 3, 129.0, 522.0, 516.0, 703.0)],
    )
)
def figure_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures that turn out to be the options: a single grid, a stem's apparatus, a stem's figure above a grid, options with texts, none at all, four tiles in two rows, of which the lower one is the options; and the box around what is kept."""
    image = lambda *all_: [(1, float(y0), float(x0), float(y1), float(x1), 0) for x0, y0, x1, y1 in all_]
    rows = [
        (1, "Pick one", [None] * 4, [False] * 4, image((0, 0, 9, 9))), (2, "The apparatus shown", [None] * 4, [False] * 4, image((0, 0, 9, 9))),
        (3, "Pick", ["A", "B", "c", "..."], [False] * 4, image((0, 0, 9, 50), (0, 100, 9, 120), (20, 100, 29, 120))), (4, "Pick", ["x", "y", "z", None], [False] * 4, image((0, 0, 9, 9))),
        (5, "Pick", [None] * 4, [False] * 4, []), (6, "Pick", [None] * 4, [True] * 4, image((129, 522, 300, 600), (320, 530, 516, 610), (130, 620, 300, 703), (310, 620, 500, 700))),
    ]
    found = figures.promote(spark.createDataFrame(rows, f"n int, stem string, option_texts array<string>, option_visuals array<boolean>, images array<{figures.IMAGE}>"))
    around = figures.merged_image(F.col("images"))
    return found.withColumn("u", F.when(F.size("images") > 0, around)).select("n", "promoted", F.size("images").cast("long").alias("images"), "u.x0", "u.y0", "u.x1", "u.y1")


INGEST_ISSUES = [
    ("2", "INCOMPLETE_OPTIONS"), ("2", "ANSWER_NOT_IN_OPTIONS"), ("3", "TABLE_OPTION_COLUMN_MISMATCH"), ("3", "TABLE_OPTION_EMPTY_ROW"), ("4", "MISSING_COMPOSITE_ASSET"), ("4", "EMPTY_IMAGE_BLOCK"),
    ("5", "DUPLICATE_OPTION_LABELS"), ("5", "INCOMPLETE_OPTIONS"), ("5", "MISSING_ASSET_FILE"), ("", "MISSING_REF"), ("", "MISSING_OPTIONS"), ("", "MISSING_ANSWER"), ("Q0", "UNMATCHED_QUESTION"), ("Q77", "UNUSED_ANSWER"), (None, "QUESTION_COUNT_MISMATCH"),
]


@query(expected("kind VARCHAR, ref VARCHAR, value VARCHAR", [("issue", r, c) for r, c in INGEST_ISSUES] + [("record", r, "DRAFT" if r == "Q1" else "NEEDS_REVIEW") for r in ("Q1", "2", "3", "4", "5", "")] + [("stage", s, "failed") for s in ("match", "validate")]))
def ingest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of questions and answers: issues of every kind, the status of each record and of the stages."""
    schema = "question_ref string, mode string, labels array<string>, n_columns int, row_widths array<int>, asset string, asset_exists boolean, image_assets array<string>, requires_review boolean"
    rows = [
        ("Q1", "text", list("ABCD"), None, None, None, None, [], False), ("2", "text", list("ABC"), None, None, None, None, [], False), ("3", "table", list("ABCD"), 2, [2, 3, 0, 2], None, None, [], False),
        ("4", "composite_visual", list("ABCD"), None, None, None, None, [" "], False), ("5", "composite_visual", list("AABC"), None, None, "o.png", False, [], False), ("", "text", [], None, None, None, None, [], False),
    ]
    answers = [(1, 1, "1", "B", "why"), (2, 1, "Q02", "D", None), (3, 1, "3", "A", None), (4, 1, "4", "A", None), (5, 1, "5", "A", None), (6, 1, "77", "A", None)]
    out = paper.ingest(spark.createDataFrame(rows, schema), spark.createDataFrame(answers, "pos int, page int, question_ref string, answer string, explanation string"), "run", expected=7)
    parts = (("issue", out["issues"].select("question_ref", "code")), ("record", out["records"].select("question_ref", "status")), ("stage", out["stages"].select("stage", "status")))
    found = [frame.toDF("ref", "value").select(F.lit(kind).alias("kind"), "ref", "value") for kind, frame in parts]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    expected(
        "paper_id VARCHAR, name VARCHAR, status VARCHAR",
        [("p", "segmentation", "failed"), ("p", "option_fidelity", "failed"), ("p", "notation", "needs_review"), ("p", "visuals", "failed"), ("p", "answer_alignment", "needs_review"), ("p", "syllabus", "not_evaluated"), ("p", "regression", "failed")]
        + [("q", s, "passed") for s in evaluation.AXES]
        + [("p", "axis schema_validity", "failed"), ("p", "axis source_fidelity", "failed"), ("p", "axis answer_alignment", "needs_review")]
        + [("q", f"axis {a}", "passed") for a in ("schema_validity", "source_fidelity", "answer_alignment")],
    )
)
def evaluation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good and a bad paper evaluated: the status of every section and axis."""
    totals = spark.createDataFrame([("p", 2, [3], []), ("q", 3, [], [])], "paper_id string, detected long, missing array<int>, duplicate array<int>")
    matches = spark.createDataFrame([("p", "1", "matched", 1, 1), ("p", "2", "unmatched", 1, 0), ("q", "1", "matched", 1, 1), ("q", "2", "matched", 1, 1), ("q", "3", "matched", 1, 1)], "paper_id string, ref string, state string, n_questions long, n_answers long")
    schema = "paper_id string, question_ref string, stem string, option_texts array<string>, option_evidenced array<boolean>, visual_required boolean, visual_pending boolean, assets array<struct<x0:double,y0:double,x1:double,y1:double>>"
    good = [("q", f"Q{i}", "stem", ["a", "b", "c", "d"], [True] * 4, False, False, []) for i in (1, 2, 3)]
    bad = [("p", "Q1", "H 2 burns", ["x", "x", None, None], [True, True, False, True], True, False, []), ("p", "Q2", "", ["a", "b", "c", "d"], [True] * 4, False, False, [(5.0, 0.0, 1.0, 1.0)])]
    questions = spark.createDataFrame(good + bad, schema)
    checks = evaluation.segmentation(totals, matches, 3)
    for more in (evaluation.option_fidelity(questions), evaluation.notation(questions), evaluation.visuals(questions), evaluation.answer_alignment(matches, 3), evaluation.regression(questions, ("Q1", "Q3"))):
        checks = checks.unionByName(more)
    checks = checks.unionByName(evaluation.syllabus(spark.createDataFrame([("p", None, "needs_review"), ("q", 1, "ok")], "paper_id string, leaf int, status string")))
    of_axes = evaluation.axes(checks).select("paper_id", F.concat(F.lit("axis "), "axis").alias("name"), "status")
    return evaluation.sections(checks).select("paper_id", F.col("section").alias("name"), "status").unionByName(of_axes)


@query(
    expected(
        "kind VARCHAR, report VARCHAR",
        [
            ("mcq", "Paper p\nDetected: 1\nMissing: 2\nDuplicate: none\nQ1 [pass] Which?\n    A: a | B: [visual] | C: c | D: d"),
            ("structured", "Q1 [pass] Stem\n  (a) [2] First\n    (i) Sub\nQ2 [review] (empty)\nQ3 [review] (empty)\n  (a) "),
        ],
    )
)
def paper_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of a multiple-choice and of a structured paper as text."""
    questions = spark.createDataFrame([("p", 1, "Which?", ["a", None, "c", "d"], "pass")], "paper_id string, number int, stem string, option_texts array<string>, status string")
    totals = spark.createDataFrame([("p", 1, [2], [])], "paper_id string, detected long, missing array<int>, duplicate array<int>")
    structured = spark.createDataFrame([("p", 1, "Stem", True), ("p", 2, "", False), ("p", 3, "", False)], "paper_id string, question int, stem string, has_diagram boolean")
    parts = spark.createDataFrame([("p", 1, 5, "a", "First", 2, None), ("p", 1, 6, "i", "Sub", None, 5), ("p", 3, 9, "a", "", None, None)], "paper_id string, question int, part int, label string, prompt string, marks int, parent int")
    checked = validation.validate_structured(structured, parts, ["paper_id", "question"])
    mcq = report.paper_report(questions, totals).select(F.lit("mcq").alias("kind"), "report")
    return mcq.unionByName(report.structured_report(checked, parts).select(F.lit("structured").alias("kind"), "report"))


@query(
    expected(
        "question INT, pos INT, type VARCHAR, text VARCHAR, codes VARCHAR",
        [(1, 0, "text", "Stem", ""), (1, 1, "diagram", None, ""), (1, 2, "text", "(a) First", ""), (1, 3, "text", "(a)(i) Sub", ""), (2, None, None, None, "EMPTY_QUESTION"), (3, None, None, None, "EMPTY_PART")],
    )
)
def structured_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content of structured questions as blocks, and what is wrong with them."""
    structured = spark.createDataFrame([("p", 1, "Stem", True), ("p", 2, "", False), ("p", 3, "", False)], "paper_id string, question int, stem string, has_diagram boolean")
    parts = spark.createDataFrame([("p", 1, 5, "a", "First", 2, None), ("p", 1, 6, "i", "Sub", None, 5), ("p", 3, 9, "a", "", None, None)], "paper_id string, question int, part int, label string, prompt string, marks int, parent int")
    keys = ["paper_id", "question"]
    content = blocks.structured_content(structured, parts, keys).select("question", F.posexplode_outer("content").alias("pos", "b")).select("question", "pos", "b.type", "b.text")
    codes = validation.validate_structured(structured, parts, keys).select("question", F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"))
    return content.join(codes, "question")


SYLLABUS = """CONTENT STRUCTURE 9
CONTENT STRUCTURE
SECTIONS
I. Matter: particles
TOPICS
1. Experimental Chemistry
2.
Atomic Structure
Ionic matters are no section
SUBJECT CONTENT
SECTION I: Matter
1. Experimental Chemistry and more
Content
1.1 Experimental Design
Learning Outcomes
Candidates should be able to:
name apparatus
choose ﬁlters
2.
Atomic Structure
2.1 Atoms
old outcome
2.2 Isotopes
define isotopes and nucleon number
2.1 Atoms again
new outcome
SUMMARY OF KEY QUANTITIES
3. Nothing Here"""


@query(
    expected(
        "number INT, title VARCHAR, section VARCHAR, code VARCHAR, subtopic VARCHAR, outcomes VARCHAR, questions BIGINT",
        [
            (1, "Experimental Chemistry and more", "Matter: particles", "6092:1.1", "Experimental Design", "name apparatus choose filters", 0),
            (2, "Atomic Structure", "Matter: particles", "6092:2.2", "Isotopes", "define isotopes and nucleon number", 1),
            (2, "Atomic Structure", "Matter: particles", "6092:2.1", "Atoms again", "new outcome", 0),
        ],
    )
)
def syllabus_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A syllabus from text to topics and subtopics, and how many of four questions go to each."""
    found = taxonomy.topics(spark.createDataFrame([("s", SYLLABUS)], "sid string, text string"), "sid", "text")
    leaves = taxonomy.leaves(found, "sid")
    questions = spark.createDataFrame([(1, "Chlorine has two isotopes. Which nucleon numbers?"), (2, "the of and"), (3, None), (4, "zzz")], "q int, text string")
    hits = classify.classify(questions, leaves, "q", "text").where(F.col("status") == "ok").join(leaves.select("leaf", "code"), "leaf").groupBy("code").agg(F.count("*").alias("questions"))
    rows = found.select("number", "title", "section", F.explode("subtopics").alias("s")).select("number", "title", "section", "s.code", F.col("s.title").alias("subtopic"), "s.outcomes")
    joined = rows.join(hits, "code", "left").withColumn("questions", F.coalesce("questions", F.lit(0)).cast("long"))
    return joined.withColumn("code", classify.code(F.lit("6092/01"), F.col("code")))


@query(
    expected(
        "pos INT, text VARCHAR, x0 DOUBLE, y0 DOUBLE, y1 DOUBLE",
        [(3000, "D red brown", 100.0, 100.0, 120.0), (3001, "40 A section of a polymer is shown.", 77.2, 120.0, 140.0), (3002, "second line", 100.0, 140.0, 160.0)],
    )
)
def text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of text cut into lines, also before a question that begins inside one."""
    rows = [("p", 1, 3, "D red brown 40 A section of a polymer is shown.\nsecond line", 100.0, 100.0, 400.0, 160.0), ("p", 1, 4, "  ", 1.0, 1.0, 2.0, 2.0)]
    frame = spark.createDataFrame(rows, "paper_id string, page int, pos int, text string, x0 double, y0 double, x1 double, y1 double")
    return layout.block_lines(frame).select(F.col("pos").cast("int").alias("pos"), "text", "x0", "y0", "y1")


@query(expected("line_index INT, text VARCHAR", [(0, "2 Some stem"), (1, "Q3"), (2, "body")]))
def merged_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question labels of a second source put among the lines that lack them."""
    have, labels = Page("p").line("2 Some stem", 77.0, 200).line("body", y=260), Page("p").line("Q2", 77.0, 200).line("Q3", 77.0, 250)
    merged = layout.missing_labels(laid_out(spark, [have]).lines, laid_out(spark, [labels]).lines)
    return layout.reading_order(merged).select("line_index", "text")


@query(
    expected(
        "name VARCHAR, owner INT, near BOOLEAN",
        [("a", 3, False), ("b", 4, False), ("c", 3, False), ("d", None, False), ("e", 4, True), ("f", 5, True)],
    )
)
def figure_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures at the edges of bands, and which of them lie where two bands overlap."""
    starts = spark.createDataFrame([("p", 3, 3, 60.0), ("p", 4, 3, 377.0), ("p", 5, 4, 60.0)], "paper_id string, number int, page int, y0 double")
    points = spark.createDataFrame([("p", "a", 3, 231.0), ("p", "b", 3, 619.0), ("p", "c", 3, 57.0), ("p", "d", 3, 55.0), ("p", "e", 3, 376.0), ("p", "f", 4, 59.5)], "paper_id string, name string, page int, y double")
    both = spatial.in_bands(spatial.bands(starts), points.withColumn("y", F.col("y") - 6)).groupBy("name").agg((F.count("*") > 1).alias("near"))
    return spatial.owners(starts, points).select("name", "owner").join(both, "name", "left").withColumn("near", F.coalesce("near", F.lit(False)))


@query(expected("ref VARCHAR, box VARCHAR", [("1", "1.0,2.0,3.0,4.0"), ("2", "1.0,9.0,3.0,11.0"), ("3", None)]))
def key_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the numbers of an answer key stand on their page."""
    entries = spark.createDataFrame([("k", 1, 1), ("k", 2, 1), ("k", 3, 1)], "paper_id string, number int, page int")
    words = [("k", 1, 0, "Answers", 0.0, 0.0, 1.0, 1.0), ("k", 1, 1, "1.", 1.0, 2.0, 3.0, 4.0), ("k", 1, 2, "2)", 1.0, 9.0, 3.0, 11.0), ("k", 1, 3, "1", 5.0, 5.0, 6.0, 6.0), ("k", 2, 4, "3", 5.0, 5.0, 6.0, 6.0)]
    found = options.number_boxes(entries, spark.createDataFrame(words, "paper_id string, page int, pos int, text string, x0 double, y0 double, x1 double, y1 double"))
    sides = F.concat_ws(",", *[F.format_string("%.1f", F.col(f"box.{s}")) for s in ("x0", "y0", "x1", "y1")])
    return found.select(F.col("number").cast("string").alias("ref"), F.when(F.col("box").isNotNull(), sides).alias("box"))


@query(expected("q VARCHAR, complete BOOLEAN, n_matched BIGINT", [("padded", True, 2), ("short", False, 1)]))
def match_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every question has an answer: references with zeros in front match, a question alone doesn't."""
    q = spark.createDataFrame([("1",), ("4",)], "question_ref string")
    full, short = (spark.createDataFrame(rows, "question_ref string") for rows in ([("Q01",), ("04",)], [("1",)]))
    row = lambda name, a: matching.is_complete(matching.match_report(q, a), 2).select(F.lit(name).alias("q"), "complete", "n_matched")
    return row("padded", full).unionByName(row("short", short))


@query(expected("x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE", [(200.0, 200.0, 800.0, 1000.0), (10.0, 42.0, 100.0, 62.0)]))
def turned_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of a model's scale in points, and one whose y grows upwards turned over."""
    a = boxes.norm_to_layout(F.array(*[F.lit(x) for x in (100, 200, 500, 800)]), F.lit(1000.0), F.lit(2000.0))
    b = boxes.from_bottom_left(*[F.lit(float(x)) for x in (10, 800, 100, 780)], F.lit(842.0))
    return spark.range(1).select(F.explode(F.array(a, b)).alias("b")).select("b.*")


@query(
    expected(
        "name VARCHAR, width INT, height INT, failed BOOLEAN",
        [("q01-stem-1.png", 54, 104, False), ("q07.png", 100, 168, False), ("q02-options.png", None, None, True), ("q03-options.png", None, None, True)],
    )
)
def cut_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures cut out of page images: one region, the strips of a question over two pages, a page without an image and one with a broken one."""
    image = png.write(np.full((200, 100, 3), 255, np.uint8))
    images = spark.createDataFrame([("p", 1, image), ("p", 2, image), ("p", 3, b"broken")], "paper_id string, page int, image binary")
    regions = [("q01-stem-1.png", 0, 1, [250.0, 250.0, 750.0, 750.0]), ("q02-options.png", 0, 4, [0.0, 0.0, 9.0, 9.0]), ("q03-options.png", 0, 3, [0.0, 0.0, 9.0, 9.0])]
    wanted = spark.createDataFrame([("p", *r) for r in regions], "paper_id string, name string, strip int, page int, bbox array<double>")
    strips = spark.createDataFrame([("p", 7, 1, 0.0, 50.0, 300.0, 200.0), ("p", 7, 2, 0.0, 0.0, 300.0, 50.0)], "paper_id string, question int, page int, x0 double, y0 double, x1 double, y1 double")
    sizes = spark.createDataFrame([("p", 1, 300.0, 260.0), ("p", 2, 300.0, 260.0)], "paper_id string, page int, width double, height double")
    found = crops.cut_out(wanted.unionByName(crops.question_strips(strips, sizes)), images)
    return found.select("name", "width", "height", F.col("error").isNotNull().alias("failed"))


SAID = {
    1: [("Q01", ["a stem", None], "text", [[0.0, 0.0, 500.0, 500.0]], None), ("2", ["begins"], "composite_visual", [], [1.0, 2.0, 3.0, 4.0])],
    2: [("q2", ["goes on"], "text", [], None), ("3", [], "composite_visual", [], None)],
}


def _model(page: dict[str, Any]) -> str:
    """What a model might say of a page; of page 3 nothing."""
    block = lambda t: {"type": "image"} if t is None else {"type": "text", "value": t}
    return json.dumps({"questions": [{"question_ref": r, "content": [block(t) for t in content], "options": {"mode": mode, "labels": list("ABCD")}, "stem_visuals": [{"bbox": b} for b in boxes_], "options_bbox": box, "requires_review": False} for r, content, mode, boxes_, box in SAID[page["page"]]]})


@query(
    expected(
        "question_ref VARCHAR, page INT, content VARCHAR, asset VARCHAR, pictures VARCHAR, requires_review BOOLEAN",
        [
            ("1", 1, "text:a stem,image:q01-stem-1.png", None, "q01-stem-1.png", False),
            ("2", 1, "text:begins", "q02-options.png", "q02-options.png", False),
            ("2", 2, "text:goes on", None, "", False),
            ("3", 2, "", None, "", True),
            ("page-3-failed", 3, "text:[parse failed on page 3: KeyError: 3]", "", "", True),
        ],
    )
)
def extracted_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions that a model reads from three pages, one of which fails: references, blocks, names of pictures, placeholders."""
    pages = spark.createDataFrame([("p", n, f"page {n}", None) for n in (1, 2, 3)], "paper_id string, page int, context string, image binary")
    found = extractors.materialized(extractors.questions(pages, _model))
    shown = F.array_join(F.transform("content", lambda b: F.concat_ws(":", b["type"], F.coalesce(b["value"], b["asset"]))), ",")
    return found.select("question_ref", "page", shown.alias("content"), F.col("options.asset").alias("asset"), F.array_join(F.transform("pictures", lambda p: p["name"]), ",").alias("pictures"), "requires_review")


@query(expected("question_ref VARCHAR, content VARCHAR, n_regions INT, requires_review BOOLEAN", [("1", "a stem", 1, False), ("2", "begins goes on", 2, False), ("3", "", 1, True)]))
def merged_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions that go on over two pages put together."""
    pages = spark.createDataFrame([("p", n, "", None) for n in (1, 2)], "paper_id string, page int, context string, image binary")
    merged = extractors.merged(extractors.materialized(extractors.questions(pages, _model)))
    text = F.array_join(F.filter(F.transform("content", lambda b: b["value"]), lambda v: v.isNotNull()), " ")
    return merged.select("question_ref", text.alias("content"), F.size("source_regions").alias("n_regions"), "requires_review")
