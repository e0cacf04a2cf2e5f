"""Operators on small inputs: notation, figures, blocks, syllabus, evaluation, ingest, sources and sinks."""

import json
import re

import pytest
from examloom.functions import boxes
from examloom.functions import text as tx
from examloom.operators import blocks, chemistry, classify, evaluation, figures, layout, matching, options, report, sinks, spatial, taxonomy, validation
from examloom.plans import paper
from examloom.sources import pages
from pyspark.sql import functions as F


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw,want", [("0", "0"), ("Q00", "0"), ("Q0 5", "5"), ("", "0"), ("QQ1", "Q1"), (" q 007 ", "7"), ("page-3-failed", "PAGE-3-FAILED"), ("04", "4"), (" Q  12", "12")])
def test_norm_ref(spark, raw, want):
    assert one(spark, tx.norm_ref(F.lit(raw))) == want


def test_text_functions(spark):
    assert one(spark, tx.preview(F.lit(" a   b\n" + "c" * 120))) == "a b " + "c" * 93 + "..."
    assert one(spark, tx.slug(F.lit("Paper 1 / 2023!"))) == "paper-1-2023"
    assert one(spark, tx.collapse_repeat(F.lit("a b c a b c d e"))) == "a b c" and one(spark, tx.collapse_repeat(F.lit("a b a b"))) == "a b a b"
    refs = spark.createDataFrame([("10",), ("2",), ("X",), ("1",)], "ref string").orderBy(*tx.ref_order(F.col("ref")))
    assert [r["ref"] for r in refs.collect()] == ["1", "2", "10", "X"]
    assert one(spark, options.joined_pieces(F.array(F.lit("1, 2  and"), F.lit(" 3 A 1, 2 and 3 ")))) == "1, 2 and 3"


def test_box_functions(spark):
    crop = lambda *v, pad=0: tuple(one(spark, boxes.norm_to_pixels(*[F.lit(float(x)) for x in v], F.lit(1000), F.lit(2000), pad)))
    assert crop(250, 250, 750, 750) == (250, 500, 750, 1500) and crop(0, 0, 0, 0, pad=2) == (0, 0, 2, 2) and crop(999, 999.5, 1000, 1000) == (999, 1998, 1000, 2000)
    assert tuple(one(spark, boxes.norm_to_layout(F.array(*[F.lit(x) for x in (100, 200, 500, 800)]), F.lit(1000.0), F.lit(2000.0)))) == (200, 200, 800, 1000)
    assert one(spark, boxes.norm_to_layout(F.array(*[F.lit(x) for x in (100, 200, 101, 201)]), F.lit(1000.0), F.lit(2000.0))) is None
    assert tuple(one(spark, boxes.from_bottom_left(*[F.lit(float(x)) for x in (10, 800, 100, 780)], F.lit(842.0)))) == (10, 42, 100, 62)
    a, b = boxes.Box(*[F.lit(float(x)) for x in (0, 0, 10, 10)]), boxes.Box(*[F.lit(float(x)) for x in (10, 10, 20, 20)])
    assert one(spark, a.overlaps(b)) and one(spark, a.shared_area(b)) == 0 and one(spark, a.near(b)) is False


NOTATION = [
    ("H 2 O and C 3 H 8", "H₂O and C₃H₈"), ("A 15 cm3", "A 15 cm³"), ("CuSO4", "CuSO₄"), ("V3+", "V³⁺"), ("VO2+", "VO₂⁺"), ("Fe2+", "Fe²⁺"), ("NH4+", "NH₄⁺"), ("B V₃+", "B V³⁺"),
    ("C VO₂+", "C VO₂⁺"), ("A NH4VO3", "A NH₄VO₃"), ("V^{3+}", "V³⁺"), ("VO_2^{+}", "VO₂⁺"), ("VO₂^{{+}}", "VO₂⁺"), ("VO_2^{{+}}", "VO₂⁺"), ("NH_4VO_3", "NH₄VO₃"), ("contains H_2O and V^{3+}", "contains H₂O and V³⁺"),
    ("N2 + 3H22NH3", "N₂ + 3H₂ ⇌ 2NH₃"), ("n₂ + 3 H2 <=> 2 NH3", "N₂ + 3H₂ ⇌ 2NH₃"), ("H2 + Cl22HCl", "H₂ + Cl₂ ⇌ 2HCl"), ("Process. N2 + 3H22NH3 ∆ H = -92.4 kJ/mol", "Process. N₂ + 3H₂ ⇌ 2NH₃ ΔH = -92.4 kJ/mol"),
    ("4 NH3 ( g ) + 5O2(g) 4NO(g)+6H2O(g)", "4NH₃(g) + 5O₂(g) → 4NO(g) + 6H₂O(g)"), ("∆ H = - 92.4 kJ / mol", "ΔH = -92.4 kJ/mol"), ("24 dm 3", "24 dm³"), ("1.00 mol dm-3", "1.00 mol dm⁻³"), ("5 g / mol at 2 atmospheres", "5 g/mol at 2 atm"),
    ("plain  words", "plain words"), ("", ""), (None, None), ("Fe(III) and CuSO4.5H2O", "Fe(III) and CuSO₄.5H₂O"), ("NaCl( AQ ) -> Na+", "NaCl(aq) → Na⁺"), ("H<sub>2</sub>SO<SUB>4</SUB>", "H₂SO₄"),
    (r"\(\mathrm{CO_2}\) gas $x$", "CO₂ gas x"), ("14 g of nitrogen, N2 in 24 dm 3 at 30°C", "14 g of nitrogen, N₂ in 24 dm³ at 30°C"), ("D 12 and B 3", "D 12 and B 3"), ("Total 7 of 9", "Total 7 of 9"),
]


def test_notation(spark):
    rows = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(NOTATION)], "i int, t string")
    got = {r["i"]: r["n"] for r in chemistry.normalized(rows, "t", "n").collect()}
    assert [(raw, got[i]) for i, (raw, _) in enumerate(NOTATION)] == NOTATION
    spelt = spark.createDataFrame([("V^{3+}",), ("VO_2^{+}",), ("VO_2^{{+}}",), ("NH_4VO_3",), ("x",)], "t string").select(chemistry.from_latex(F.col("t")).alias("t"))
    assert [r["t"] for r in spelt.collect()] == ["V³⁺", "VO₂⁺", "VO₂⁺", "NH₄VO₃", "x"]


def test_notation_tokens(spark):
    df = spark.createDataFrame([("Add 24 cm 3 of H2SO4(aq); A 15", {"A": "NaCl", "B": "H2SO4"})], "stem string, options map<string,string>")
    row = chemistry.annotated(df).first()
    assert [(t["kind"], t["normalized"]) for t in row["tokens"]] == [("unit", "cm³"), ("state", "(aq)"), ("formula", "H₂SO₄"), ("formula", "NaCl")]
    assert row["stem_normalized"].startswith("Add 24 cm³ of H₂SO₄(aq)")
    assert row["options_normalized"] == {"A": "NaCl", "B": "H₂SO₄"}
    token = row["tokens"][2]
    assert "Add 24 cm 3 of H2SO4(aq); A 15"[token["start"] : token["end"]] == "H2SO4"


def test_matches_and_their_places(spark):
    """Texts cut at matches against a loop: at the ends, side by side, without any, and with the mark that cutting uses."""
    texts = ["", " ", "x", "H2O", "H2O CO2", "H2OCO2 and", "12+34-", "\x01", "\x01H2O\x01\x01CO2\x01", "a\x01b 7\x01", "\U0001d49c é H2O", "$1 \\0 H2SO4", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for pattern in (chemistry.FORMULA, r"\d", r"[+-]|\d+", r"\x01", r".", r"\$\d"):
        got = df.select("i", tx.located(F.col("t"), pattern).alias("at"), tx.rewritten(F.col("t"), pattern, lambda m: F.concat(F.lit("<"), m, F.lit("$0>"))).alias("new")).collect()
        for i, at, new in got:
            if texts[i] is None:
                assert new is None and not at
                continue
            found = list(re.finditer(pattern, texts[i], re.ASCII))
            assert (at, new) == ([(m[0], *m.span()) for m in found], re.sub(pattern, lambda m: f"<{m[0]}$0>", texts[i], flags=re.ASCII)), (pattern, texts[i])


def test_bands(spark):
    starts = spark.createDataFrame([("p", 3, 3, 60.0), ("p", 4, 3, 377.0), ("p", 5, 4, 60.0)], "paper_id string, number int, page int, y0 double")
    points = spark.createDataFrame([("p", "a", 3, 231.0), ("p", "b", 3, 619.0), ("p", "c", 3, 57.0), ("p", "d", 3, 55.0), ("p", "e", 3, 376.0), ("p", "f", 4, 59.5), ("q", "g", 1, 1.0)], "paper_id string, name string, page int, y double")
    got = {r["name"]: r["owner"] for r in spatial.owners(starts, points).collect()}
    assert got == {"a": 3, "b": 4, "c": 3, "d": None, "e": 4, "f": 5, "g": None}
    both = spatial.in_bands(spatial.bands(starts), points.where("name = 'e'").withColumn("y", F.lit(370.0)))
    assert sorted(r["number"] for r in both.collect()) == [3, 4]


def images(*rows):
    return [(1, float(y0), float(x0), float(y1), float(x1), 0) for x0, y0, x1, y1 in rows]


@pytest.mark.parametrize(
    "stem,texts,visuals,given,promoted,count",
    [
        ("Pick one", [None] * 4, [False] * 4, images((0, 0, 9, 9)), True, 1),
        ("The apparatus shown", [None] * 4, [False] * 4, images((0, 0, 9, 9)), False, 1),
        ("Pick", ["A", "B", "c", "..."], [False] * 4, images((0, 0, 9, 50), (0, 100, 9, 120), (20, 100, 29, 120)), True, 2),
        ("Pick", ["x", "y", "z", None], [False] * 4, images((0, 0, 9, 9)), False, 1),
        ("Pick", [None] * 4, [True] * 4, images((0, 0, 9, 20), (0, 21, 9, 40), (0, 41, 9, 60), (0, 61, 9, 80)), True, 2),
        ("Pick", [None] * 4, [False] * 4, [], False, 0),
    ],
)
def test_promotion(spark, stem, texts, visuals, given, promoted, count):
    df = spark.createDataFrame([(stem, texts, visuals, given)], f"stem string, option_texts array<string>, option_visuals array<boolean>, images array<{figures.IMAGE}>")
    row = figures.promote(df).first()
    assert row["promoted"] is promoted and len(row["images"]) == count
    if promoted:
        assert row["option_texts"] == [None] * 4 and all(row["option_visuals"])


def test_merged_image(spark):
    tiles = images((129, 522, 300, 600), (320, 530, 516, 610), (130, 620, 300, 703), (310, 620, 500, 700))
    row = one(spark, figures.merged_image(F.from_json(F.lit(json.dumps([dict(zip(("page", "y0", "x0", "y1", "x1", "block_index"), t)) for t in tiles])), f"array<{figures.IMAGE}>")))
    assert (row["x0"], row["y0"], row["x1"], row["y1"]) == (129, 522, 516, 703)


def test_content_blocks(spark):
    raw = [("text", t) for t in ("Full stem here", "Which is right?", "which  is right?", "A: iron", "Label X", "iron zinc", "A iron B zinc C tin D lead", "Test 3 warming it with acid")] + [("diagram", None)] * 2 + [("table", None)]
    rows = [(k, t, False, None, None) for k, t in raw]
    opts = [("A", "iron"), ("B", "zinc"), ("C", None), ("D", "lead")]
    schema = f"raw_blocks array<{blocks.BLOCK}>, stem string, options array<struct<label:string,text:string>>, has_diagram boolean, visual_options boolean, stem_paths array<string>, option_path string"
    df = spark.createDataFrame([(rows, "s", opts, True, False, ["1.png", "2.png"], None), (rows, "s", opts, False, True, [], "o.png"), ([], "s", opts, False, False, [], None)], schema)
    got = [[(b["type"], b["text"], b["asset_path"]) for b in r["content"]] for r in blocks.content(df).collect()]
    listed = "A: iron\nB: zinc\nD: lead"
    assert got[0] == [("text", "Which is right?", None), ("diagram", None, "1.png"), ("table", None, None), ("diagram", None, "2.png"), ("options", listed, None)]
    assert [t for t, _, _ in got[1]] == ["text", "text", "text", "text", "table", "options"] and got[1][-1] == ("options", None, "o.png")
    assert got[2] == [("options", listed, None)]


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


def test_syllabus_and_classification(spark):
    found = taxonomy.topics(spark.createDataFrame([("s", SYLLABUS), ("empty", "")], "sid string, text string"), "sid", "text")
    rows = {r["number"]: r for r in found.collect()}
    assert sorted(rows) == [1, 2] and rows[1]["title"] == "Experimental Chemistry and more" and rows[2]["title"] == "Atomic Structure"
    assert rows[1]["section"] == "Matter: particles"
    assert [(s["code"], s["title"], s["outcomes"]) for s in rows[2]["subtopics"]] == [("2.2", "Isotopes", "define isotopes and nucleon number"), ("2.1", "Atoms again", "new outcome")]
    assert rows[1]["subtopics"][0]["outcomes"] == "name apparatus choose filters"
    leaves = taxonomy.leaves(found, "sid")
    questions = spark.createDataFrame([(1, "Chlorine has two isotopes. Which nucleon numbers?"), (2, "the of and"), (3, None), (4, "zzz")], "q int, text string")
    got = {r["q"]: r for r in classify.classify(questions, leaves, "q", "text").join(leaves, "leaf", "left").collect()}
    assert got[1]["code"] == "2.2" and got[1]["confidence"] > 0.12 and got[1]["status"] == "ok"
    assert all(got[q]["leaf"] is None and got[q]["confidence"] == 0 and got[q]["status"] == "needs_review" for q in (2, 3, 4))
    assert one(spark, classify.code(F.lit("6092/01"), F.lit("2.2"))) == "6092:2.2" and one(spark, classify.syllabus_of(F.lit(" /01"))) == "6092"


def test_matching(spark):
    q = spark.createDataFrame([("Q1", False), ("04", False), ("Q4", True), ("Q9", False)], "question_ref string, requires_review boolean")
    a = spark.createDataFrame([(1, "1", "A", ""), (2, "Q04", "B", "old"), (3, "4", "D", "note"), (4, "7", "C", None)], "pos int, question_ref string, answer string, explanation string")
    states = {r["ref"]: (r["state"], r["n_questions"], r["n_answers"]) for r in matching.match_report(q, a).collect()}
    assert states == {"1": ("matched", 1, 1), "4": ("matched", 2, 2), "9": ("unmatched", 1, 0), "7": ("unused", 0, 1)}
    assert tuple(matching.is_complete(matching.match_report(q, a)).first()) == (2, False)
    rows = {r["question_ref"]: tuple(r)[1:] for r in matching.join_records(q, a, F.col("pos")).collect()}
    assert rows["Q1"] == ("A", "", None, "DRAFT", False) and rows["04"] == ("D", "note", "mark_scheme", "DRAFT", False)
    assert rows["Q4"][3:] == ("NEEDS_REVIEW", True) and rows["Q9"] == (None, None, None, "NEEDS_REVIEW", True)
    pages_ = [(1, 1, "A", None), (1, 2, "B", ""), (1, 3, "C", "x"), (2, 1, "A", ""), (2, 2, "B", "x"), (3, 1, "A", None), (3, 2, "B", None)]
    merged = matching.merge_answer_pages(spark.createDataFrame(pages_, "k int, pos int, answer string, explanation string"), ["k"], F.col("pos"))
    assert sorted(map(tuple, merged.collect())) == [(1, "C", "x"), (2, "A", ""), (3, "A", None)]


def canonical(spark, *rows):
    schema = "question_ref string, mode string, labels array<string>, n_columns int, row_widths array<int>, asset string, asset_exists boolean, image_assets array<string>, requires_review boolean"
    return spark.createDataFrame(list(rows), schema)


def test_ingest(spark):
    q = canonical(
        spark,
        ("Q1", "text", list("ABCD"), None, None, None, None, [], False),
        ("2", "text", list("ABC"), None, None, None, None, [], False),
        ("3", "table", list("ABCD"), 2, [2, 3, 0, 2], None, None, [], False),
        ("4", "composite_visual", list("ABCD"), None, None, None, None, [" "], False),
        ("5", "composite_visual", list("AABC"), None, None, "o.png", False, [], False),
        ("", "text", [], None, None, None, None, [], False),
    )
    a = spark.createDataFrame([(1, 1, "1", "B", "why"), (2, 1, "Q02", "D", None), (3, 1, "3", "A", None), (4, 1, "4", "A", None), (5, 1, "5", "A", None), (6, 1, "77", "A", None)], "pos int, page int, question_ref string, answer string, explanation string")
    out = paper.ingest(q, a, "run", expected=7)
    status = {r["question_ref"]: r["status"] for r in out["records"].collect()}
    assert status == {"Q1": "DRAFT", "2": "NEEDS_REVIEW", "3": "NEEDS_REVIEW", "4": "NEEDS_REVIEW", "5": "NEEDS_REVIEW", "": "NEEDS_REVIEW"}
    codes = sorted({(r["question_ref"], r["code"]) for r in out["issues"].collect()}, key=str)
    want = {
        ("2", "INCOMPLETE_OPTIONS"), ("2", "ANSWER_NOT_IN_OPTIONS"), ("3", "TABLE_OPTION_COLUMN_MISMATCH"), ("3", "TABLE_OPTION_EMPTY_ROW"), ("4", "MISSING_COMPOSITE_ASSET"), ("4", "EMPTY_IMAGE_BLOCK"),
        ("5", "DUPLICATE_OPTION_LABELS"), ("5", "INCOMPLETE_OPTIONS"), ("5", "MISSING_ASSET_FILE"), ("", "MISSING_REF"), ("", "MISSING_OPTIONS"), ("", "MISSING_ANSWER"), ("Q0", "UNMATCHED_QUESTION"), ("Q77", "UNUSED_ANSWER"), (None, "QUESTION_COUNT_MISMATCH"),
    }
    assert set(codes) == want
    assert {r["stage"]: r["status"] for r in out["stages"].collect()} == {"match": "failed", "validate": "failed"}


def test_evaluation(spark):
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
    status = {(r["paper_id"], r["section"]): r["status"] for r in evaluation.sections(checks).collect()}
    assert status == {
        ("p", "segmentation"): "failed", ("p", "option_fidelity"): "failed", ("p", "notation"): "needs_review", ("p", "visuals"): "failed", ("p", "answer_alignment"): "needs_review", ("p", "syllabus"): "not_evaluated", ("p", "regression"): "failed",
        **{("q", s): "passed" for s in evaluation.AXES},
    }
    axes = {(r["paper_id"], r["axis"]): r["status"] for r in evaluation.axes(checks).collect()}
    assert axes["p", "schema_validity"] == "failed" and axes["q", "source_fidelity"] == "passed" and axes["p", "answer_alignment"] == "needs_review"


def test_key_pages(spark):
    text = "CHEMISTRY 6092/01 Answers\n" + "\n".join(" ".join(f"{n} {'BACD'[n % 4]}" for n in range(a, a + 10)) for a in (1, 11, 21, 31))
    df = spark.createDataFrame([("k", 1, text), ("k", 2, "3 D 99 A"), ("k", 3, "topics"), ("k", 4, "1 D"), ("none", 1, "")], "paper_id string, page int, text string")
    got = {r["number"]: r["answer"] for r in options.key_entries(df, 40).collect()}
    assert got == {n: "BACD"[n % 4] for n in range(1, 41)}


def test_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    page = {"page": 1, "width": 595.3, "height": 841.9, "lines": [{"text": "1 Which?", "x0": 77.0, "y0": 80.0, "x1": 200.0, "y1": 92.0, "block_index": 0, "line_no": 0}], "images": [], "tables": [{"x0": 0.0, "y0": 0.0, "x1": 1.0, "y1": 1.0, "headers": ["a"], "rows": [["x", "y"], ["z", ""]]}, {"x0": 0.0, "y0": 0.0, "x1": 1.0, "y1": 1.0, "headers": [], "rows": [["x", "y"]]}]}
    (tmp_path / "in/a.json").write_text(json.dumps({"pages": [page]}))
    (tmp_path / "in/broken.json").write_text("{")
    (tmp_path / "in/plain.txt").write_text("one\n\n two \ftwo")
    calls = []

    def flaky(content):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("not yet")
        return pages.json_reader(content)

    assert pages.with_attempts(flaky)(b"[1]") == [1] and len(calls) == 3
    found = pages.read_files(spark, str(tmp_path / "in"), pages.with_attempts(pages.json_reader), "*.json")
    rows = {r["paper_id"]: r for r in found.collect()}
    assert rows["a.json"]["error"] is None and rows["broken.json"]["error"].startswith("JSONDecodeError")
    assert [r["text"] for r in pages.lines(found).collect()] == ["1 Which?"] and pages.tables(found).count() == 1 and pages.page_sizes(found).count() == 1
    plain = pages.read_files(spark, str(tmp_path / "in"), pages.text_reader, "*.txt")
    assert sorted((r["page"], r["text"]) for r in pages.lines(plain).collect()) == [(1, "one"), (1, "two"), (2, "two")]
    (tmp_path / "key.json").write_text('{"answers": {"Q1": "B", "Q2": "a"}}')
    (tmp_path / "list.json").write_text('{"answers": [{"question_ref": "Q1", "answer": "D"}]}')
    assert [(r["question_ref"], r["answer"]) for r in pages.answers_from_json(spark, str(tmp_path / "key.json")).collect()] == [("Q1", "B"), ("Q2", "A")]
    assert pages.answers_from_json(spark, str(tmp_path / "list.json")).first()["answer"] == "D"
    (tmp_path / "bad.json").write_text('{"answers": {"Q1": "E"}}')
    with pytest.raises(Exception, match="no option label"):
        pages.answers_from_json(spark, str(tmp_path / "bad.json")).collect()


def test_sinks_and_report(spark, tmp_path):
    rows = spark.createDataFrame([("1", ["iron", "zinc", "", None], "B")], "question_ref string, texts array<string>, answer string")
    got = sinks.option_rows(rows, F.lit("bank")).orderBy("sort_order").collect()
    assert [(r["label"], r["option_text"], r["is_correct"]) for r in got] == [("A", "iron", False), ("B", "zinc", True), ("C", "[visual option]", False), ("D", "[visual option]", False)]
    path = str(tmp_path / "bank")
    for bank, n in (("a", 3), ("b", 2), ("a", 1)):
        sinks.replace_bank(spark.range(n), path, bank)
    assert {r["bank"]: r["count"] for r in spark.read.parquet(path).groupBy("bank").count().collect()} == {"a": 1, "b": 2}
    media = spark.createDataFrame([("1", ["s.png"], "o.png"), ("2", [], None)], "question_ref string, stem_assets array<string>, options_asset string")
    assert [(r["image_index"], r["path"], r["role"]) for r in sinks.media_rows(media, F.lit("b")).collect()] == [(0, "s.png", "stem"), (1, "o.png", "options")]
    sinks.write_run({"stages": rows}, str(tmp_path / "run"))
    assert spark.read.json(str(tmp_path / "run/stages")).count() == 1
    questions = spark.createDataFrame([("p", 1, "Which?", ["a", None, "c", "d"], "pass")], "paper_id string, number int, stem string, option_texts array<string>, status string")
    totals = spark.createDataFrame([("p", 1, [2], [])], "paper_id string, detected long, missing array<int>, duplicate array<int>")
    assert report.paper_report(questions, totals).first()["report"] == "Paper p\nDetected: 1\nMissing: 2\nDuplicate: none\nQ1 [pass] Which?\n    A: a | B: [visual] | C: c | D: d"


def test_paper_totals(spark):
    papers = spark.createDataFrame([("a",), ("b",), ("c",)], "p string")
    rows = spark.createDataFrame([("a", n) for n in (1, 2, 3)] + [("b", 2), ("b", 2), ("b", 9), ("b", None)], "p string, n int")
    got = {r["p"]: (r["detected"], r["missing"], r["duplicate"], r["status"]) for r in validation.paper_totals(papers, rows, "p", "n", 3).collect()}
    assert got == {"a": (3, [], [], "pass"), "b": (4, [1, 3], [2], "review"), "c": (0, [1, 2, 3], [], "review")}
    statuses = [[], ["not_evaluated"], ["passed", "not_evaluated"], ["passed", "needs_review"], ["failed", "needs_review"]]
    df = spark.createDataFrame([(i, s) for i, listed in enumerate(statuses) for s in listed or [None]], "i int, s string")
    assert [r["x"] for r in df.groupBy("i").agg(validation.rolled_up(F.col("s")).alias("x")).orderBy("i").collect()] == ["not_evaluated", "not_evaluated", "passed", "needs_review", "failed"]


def test_regions_and_strips(spark):
    schema = "paper_id string, page int, x0 double, y0 double, x1 double, y1 double"
    region = spark.createDataFrame([("p", 1, 50.0, 100.0, 500.0, 300.0)], schema)
    boxes_ = [("p", 1, 60.0, 110.0, 200.0, 200.0), ("p", 1, 60.0, 290.0, 200.0, 400.0), ("p", 1, 60.0, 110.0, 70.0, 120.0), ("p", 2, 60.0, 110.0, 200.0, 200.0), ("p", 1, 0.0, 0.0, 590.0, 390.0)]
    items = spark.createDataFrame(boxes_, schema)
    sizes = spark.createDataFrame([("p", 1, 595.3, 600.0), ("p", 2, 595.3, 841.9)], "paper_id string, page int, width double, height double")
    tops = lambda df: sorted(r["r_y0"] for r in df.collect())
    assert tops(spatial.tables_in_regions(region, items, ["paper_id", "page"])) == [0.0, 110.0, 110.0]
    assert tops(spatial.images_in_regions(region, items, sizes, ["paper_id", "page"])) == [110.0]
    strip = spatial.page_strips(items.where("page = 2").withColumn("q", F.lit(1)), sizes, ["paper_id", "q"]).first()
    assert (strip["x0"], strip["y0"], strip["x1"], strip["y1"]) == (36.0, 104.0, 559.3, 216.0)


def test_blocks_of_text(spark):
    text = "D red brown 40 A section of a polymer is shown.\nsecond line"
    df = spark.createDataFrame([("p", 1, 3, text, 100.0, 100.0, 400.0, 160.0), ("p", 1, 4, "  ", 1.0, 1.0, 2.0, 2.0)], "paper_id string, page int, pos int, text string, x0 double, y0 double, x1 double, y1 double")
    got = [(r["text"], r["x0"], r["y0"], r["y1"]) for r in layout.block_lines(df).orderBy("pos").collect()]
    assert got == [("D red brown", 100.0, 100.0, 120.0), ("40 A section of a polymer is shown.", 77.2, 120.0, 140.0), ("second line", 100.0, 140.0, 160.0)]
    told = one(spark, layout.table_text(F.array(F.lit("a"), F.lit("b")), F.array_repeat(F.array(F.lit(" x "), F.lit("")), 22), F.lit(1)))
    assert told == "Table 1:\nHeaders: a | b\n" + "Row: x\n" * 20 + "... (2 more rows)"


def test_option_tables(spark):
    def matrix(headers, rows):
        row = spark.createDataFrame([(headers, rows)], "h array<string>, r array<array<string>>").select(options.option_matrix(F.col("h"), F.col("r")).alias("m")).first()["m"]
        return row["headers"], row["rows"]

    assert matrix(["section", "description", "Unnamed: 0"], [["P to Q", "The particles  move", "A"], ["Q to R", "They melt", "B"], ["note", "x", "y"]]) == (["", "section", "description"], [["A", "P to Q", "The particles move"], ["B", "Q to R", "They melt"]])
    assert matrix(["x"], [["A iron", "1", "2"], ["B", "3"]]) == (["", "x", ""], [["A", "1", "iron 2"], ["B", "3", ""]])
    assert matrix(["h"], [["A | B | C | D", ""]]) == (["", "h"], [["A | B | C | D", ""]])
    role = lambda rows: spark.createDataFrame([(rows,)], "r array<array<string>>").select(options.table_role(F.col("r"))).first()[0]
    assert role([["A", "1"], ["B", "2"]]) == "options" and role([["A B C D", ""]]) == "options" and role([["gas", "A"], ["x", "y"]]) == "stem"


def test_structured_rows(spark):
    questions = spark.createDataFrame([("p", 1, "Stem", True), ("p", 2, "", False), ("p", 3, "", False)], "paper_id string, question int, stem string, has_diagram boolean")
    parts = spark.createDataFrame([("p", 1, 5, "a", "First", 2, None), ("p", 1, 6, "i", "Sub", None, 5), ("p", 3, 9, "a", "", None, None)], "paper_id string, question int, part int, label string, prompt string, marks int, parent int")
    keys = ["paper_id", "question"]
    got = {r["question"]: ([i["code"] for i in r["issues"]], r["status"]) for r in validation.validate_structured(questions, parts, keys).collect()}
    assert got == {1: ([], "pass"), 2: (["EMPTY_QUESTION"], "review"), 3: (["EMPTY_PART"], "review")}
    content = {r["question"]: [(b["type"], b["text"]) for b in r["content"]] for r in blocks.structured_content(questions, parts, keys).collect()}
    assert content == {1: [("text", "Stem"), ("diagram", None), ("text", "(a) First"), ("text", "(a)(i) Sub")], 2: [], 3: []}
    text = report.structured_report(validation.validate_structured(questions, parts, keys), parts).first()["report"]
    assert text == "Q1 [pass] Stem\n  (a) [2] First\n    (i) Sub\nQ2 [review] (empty)\nQ3 [review] (empty)\n  (a) "
    assert one(spark, tx.question_number(F.lit("Q12b"))) == 12
    with pytest.raises(Exception, match="no question number"):
        one(spark, tx.question_number(F.lit("none")))
