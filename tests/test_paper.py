"""Whole papers from small layouts."""

import pytest
from examloom.operators import layout as lay
from examloom.operators import segment
from examloom.plans import paper
from pyspark.sql import functions as F

from layouts import Page


def parsed(found, expected=10):
    rows = paper.parse_mcq(found, expected).collect()
    return {(r["paper_id"], r["number"]): r for r in rows}


def choices(row):
    return {k: v["text"] for k, v in sorted((row["options"] or {}).items())}


def vertical(page, texts, y=120, x=129.0):
    for i, (label, text) in enumerate(zip("ABCD", texts)):
        page.line(label, y=y + 20 * i)
        page.line(text, x=x, y=y + 20 * i)
    return page


def test_questions_of_several_papers(spark):
    a = vertical(Page(spark, "a").number(1, "Which metal is extracted by electrolysis of its ore?"), ["iron and calcium", "zinc and copper", "sodium only", "gold only"])
    b = Page(spark, "b").number(1).line("The first line of a stem", y=80).line("and the second", y=95).line("and a third?", y=110)
    vertical(b, ["one", "two", "three", "four"], y=140)
    b.line("goes on", x=129.0, y=147)
    got = parsed(a.layout(b))
    assert choices(got["a", 1]) == {"A": "iron and calcium", "B": "zinc and copper", "C": "sodium only", "D": "gold only"}
    assert got["a", 1]["stem"] == "Which metal is extracted by electrolysis of its ore?" and not got["a", 1]["visual_required"]
    assert got["b", 1]["stem"] == "The first line of a stem and the second and a third?"
    assert choices(got["b", 1]) == {"A": "one goes on", "B": "two", "C": "three", "D": "four"}


def test_two_questions_and_traps(spark):
    page = vertical(Page(spark).number(1, "Which is one?"), ["red", "blue", "green", "10 cm3"], y=100)
    vertical(page.number(2, "What is two?", y=220).line("25", x=174.0, y=230), ["a b", "c d", "e f", "g h"], y=250)
    page.number(40, "August", y=400).line("Turn over", y=500).line("page foot", y=830)
    got = parsed(page.layout())
    assert sorted(n for _, n in got) == [1, 2]
    assert choices(got["p", 1])["D"] == "10 cm3" and got["p", 2]["stem"] == "What is two? 25"


def test_inline_options_article_and_columns(spark):
    page = Page(spark).number(1, "Which statements are correct?").line("A 1, 2 and 3 B 1 and 2 only C 2 and 3 only D 3 only", y=120)
    page.number(2, "Which substance is a base?", y=200).line("A ammonium chloride", y=220).line("B sodium oxide", y=240).line("C water", y=260).line("D wax", y=280)
    page.number(3, "How many protons are there?", y=320).line("A student is given a table of them", y=340)
    for i, (label, cells) in enumerate(zip("ABCD", [(16, 18, 14), (16, 18, 18), (18, 16, 14), (18, 18, 16)])):
        page.line(label, y=360 + 20 * i)
        for k, cell in enumerate(cells):
            page.line(str(cell), x=150.0 + 60 * k, y=360 + 20 * i)
    got = parsed(page.layout())
    assert choices(got["p", 1]) == {"A": "1, 2 and 3", "B": "1 and 2 only", "C": "2 and 3 only", "D": "3 only"}
    assert choices(got["p", 2])["A"] == "ammonium chloride" and got["p", 2]["stem"] == "Which substance is a base?"
    assert choices(got["p", 3]) == {"A": "16 18 14", "B": "16 18 18", "C": "18 16 14", "D": "18 18 16"}
    assert got["p", 3]["stem"].endswith("A student is given a table of them")


def test_page_transition_and_missing_option(spark):
    page = Page(spark).number(1, "The values are shown in the two tables here?", y=700).line("first value", y=720)
    vertical(page.line("second value", y=80, page=2), [], y=100)
    for label, text, y in (("A", "x one", 100), ("B", "x two", 120), ("C", "x three", 140)):
        page.line(label, y=y, page=2).line(text, x=129.0, y=y, page=2)
    found = page.layout()
    got = parsed(found)["p", 1]
    assert (got["page_start"], got["page_end"]) == (1, 2) and "first value" in got["stem"] and "second value" in got["stem"]
    assert choices(got) == {"A": "x one", "B": "x two", "C": "x three"}
    checked = paper.validated(paper.parse_mcq(found, 10)).collect()[0]
    assert checked["status"] == "review" and "MISSING_OPTION" in [i["code"] for i in checked["issues"]]
    totals = paper.paper_totals(paper.parse_mcq(found, 3), found.pages, 3).collect()[0]
    assert (totals["detected"], totals["missing"], totals["duplicate"]) == (1, [2, 3], [])


def test_pictures_as_options(spark):
    page = Page(spark).number(1, "Which structure is shown below?", y=80)
    for label, x, y in (("A", 101.3, 200), ("B", 329.2, 200), ("C", 101.3, 360), ("D", 329.2, 360)):
        page.line(label, x=x, y=y)
        page.image(x + 20, y, x + 120, y + 100)
    got = parsed(page.layout())["p", 1]
    assert all(o["requires_visual"] and o["text"] is None for o in got["options"].values()) and len(got["options"]) == 4
    assert got["visual_required"] and got["n_images"] == 4


def test_tables_and_figure_text(spark):
    page = Page(spark).number(1, "The table gives data about four gases.", y=80).line("gas", x=120.0, y=120).line("density", x=300.0, y=120)
    page.table(100, 100, 540, 200, ["gas", "density"], [["x", "1"], ["y", "2"]])
    vertical(page.line("Which gas is light?", y=210), ["w", "x", "y", "z"], y=230)
    page.number(2, "Which row is correct?", y=400).line("0.5", x=220.0, y=430).image(200, 420, 400, 440)
    page.table(100, 445, 540, 505, ["", "acid", "base"], [["A", "2, 1", "2, 7"], ["B", "1", "7"], ["C 3", "5", ""], ["x", "y", "D"]])
    got = parsed(page.layout())
    assert got["p", 1]["stem"] == "The table gives data about four gases. Which gas is light?"
    assert got["p", 2]["stem"] == "Which row is correct?"
    assert choices(got["p", 2]) == {"A": "2, 1 | 2, 7", "B": "1 | 7", "C": "3 5", "D": "x | y"}


def test_structured_paper(spark):
    page = Page(spark).line("Pure chemistry", y=60)
    page.line("Q1 Ammonia is made from nitrogen.", x=77.0, y=80).line("(a) Name the process.", y=100).line("(i) State the catalyst. [1]", y=120).line(".......", y=130).line("(ii) Give the", y=140).line("temperature. [1]", y=150)
    page.line("(b) Explain the diagram shows. [2]", y=160).line("[Total: 4]", y=180).line("Q2 Second", x=77.0, y=200).line("7", y=210).line("(v) alone", y=220).line("Answers", y=300).line("Q1 Haber", x=77.0, y=320).line("Q3 no", x=77.0, y=340)
    questions, parts = paper.parse_structured(page.layout())
    got = {r["question"]: r for r in questions.collect()}
    assert sorted(got) == [1, 2] and got[1]["stem"] == "Ammonia is made from nitrogen." and got[1]["marks_total"] == 4 and got[2]["marks_total"] is None
    rows = sorted(parts.collect(), key=lambda r: r["part"])
    names = {r["part"]: r["label"] for r in rows}
    assert [(r["label"], r["prompt"], r["marks"], names.get(r["parent"])) for r in rows] == [
        ("a", "Name the process.", None, None), ("i", "State the catalyst.", 1, "a"), ("ii", "Give the temperature.", 1, "a"), ("b", "Explain the diagram shows.", 2, None), ("v", "alone", None, None),
    ]


def test_reading_order_and_labels(spark):
    page = Page(spark).line("low", y=300).line("high", y=100).line("left", x=50.0, y=100)
    ordered = lambda df: [r["text"] for r in sorted(lay.reading_order(df).collect(), key=lambda r: r["line_index"])]
    lines = page.layout().lines
    assert ordered(lines) == ["left", "high", "low"]
    given = lines.withColumn("reading_order", F.when(F.col("text") == "low", 0).when(F.col("text") == "high", 5))
    assert ordered(given) == ["low", "high", "left"]
    labels = Page(spark).line("Q2", x=77.0, y=200).line("Q3", x=77.0, y=250).layout().lines
    have = Page(spark).line("2 Some stem", x=77.0, y=200).line("body", y=260).layout().lines
    assert ordered(lay.missing_labels(have, labels)) == ["2 Some stem", "Q3", "body"]


@pytest.mark.parametrize("numbers,expected,want", [([25, 1, 2, 5, 3, 3, 9, 6, 7, 40, 8], 10, [1, 2, 5, 6, 7, 8]), ([2, 3], 10, []), ([], 5, []), ([1, 2, 3], 2, [1, 2])])
def test_greedy_scan(spark, numbers, expected, want):
    rows = spark.createDataFrame([("p", i, n) for i, n in enumerate(numbers)], "paper_id string, line_index int, number int")
    got = segment.greedy_starts(rows, "paper_id", ["line_index"], expected).orderBy("line_index").collect()
    assert [r["number"] for r in got] == want
