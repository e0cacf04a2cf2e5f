"""Multiple-choice options: labels on lines, the best run of labels, the text of each option, option tables and answer keys."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examloom.functions import text as tx
from examloom.functions.boxes import Box

LABEL_X, SAME_ROW, GRID_GAP = 120.0, 16.0, 80.0
VERTICAL_SLACK, PROBE_WIDTH, PROBE_HEIGHT, PROBE_PAD = 12.0, 220.0, 140.0, 8.0
ANNOTATION_WORDS, ANNOTATION_PAD = 4, 12.0
FAR = 10_000.0

#: How labels stand on a line, and sentences that begin with the article A.
LEADING = r"^([A-D])(?:[.)]\s*|\s+)(\S.*)$"
INLINE = re.compile(r"(?:^|(?<=\s))([B-D])(?:[.)]\s*|\s+)(?=\S)")
TRAILING = re.compile(r"(?:^|(?<=\s))([A-D])\s*$")
ARTICLE = re.compile(
    r"^A\s+[a-z][a-z\-]*\s+"
    r"(?:is|are|was|were|has|have|had|can|could|will|would|must|should|"
    r"consists|contains|burns|reacts|forms|does|did|of|with|from|to)\b",
    re.I,
)
STACKED = r"A\s*\|?\s*B\s*\|?\s*C\s*\|?\s*D"
#: A pair of an answer key, and pages that end it.
KEY_PAIR = r"(?i)(?:^|[^\d])(\d{1,2})\s*[.):\-]?\s*([ABCD])\b"

MARKERS = "array<struct<label:string,text_after:string,x0:double>>"
_LEADING = re.compile(LEADING)


def labels_of_line(text: str, x0: float, x1: float) -> list[tuple[str, str, float]]:
    """(label, text after it, x) of the option labels on one line, left to right."""
    text = text.strip()
    if text in ("A", "B", "C", "D"):
        return [(text, "", x0)]
    lead, body = None, text
    if m := _LEADING.match(text):
        article = m[1] == "A" and (x0 > LABEL_X or ARTICLE.match(text[0] + " " + m[2]))
        if not article:
            lead, body = m[1], m[2]
    within = list(INLINE.finditer(body))
    at = lambda m: x0 + m.start(1) / max(len(body), 1) * max(x1 - x0, 1)
    found: list[tuple[str, str, float]] = []
    if lead and within:
        # A label at the head of the line: every label ends the text of the one before it.
        ends = [m.start() for m in within[1:]] + [len(body)]
        found.append((lead, body[: within[0].start()].strip(), x0))
        found += [(m[1], body[m.end() : end].strip(), at(m)) for m, end in zip(within, ends)]
        return found
    for label, after, x in [(lead, body, x0)] if lead else [(m[1], body[m.end() :].strip(), at(m)) for m in within]:
        tail = TRAILING.search(after)
        if tail and tail.start() > 0:
            found += [(label, after[: tail.start()].strip(), x), (tail[1], "", x1)]
        else:
            found.append((label, after.strip(), x))
    return found


def markers(lines: DataFrame) -> DataFrame:
    """One row per option label on ``lines`` (text, x0, x1, ...): label, text_after and marker_x; ``on_line`` counts them within a line."""

    @F.pandas_udf(MARKERS)
    def of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, x0, x1 in batches:
            rows = [[dict(zip(("label", "text_after", "x0"), m)) for m in labels_of_line(t or "", a, b)] for t, a, b in zip(text, x0, x1)]
            yield pd.Series(rows, dtype=object)

    exploded = lines.select("*", F.posexplode(of("text", "x0", "x1")).alias("on_line", "__m"))
    return exploded.select(*lines.columns, "on_line", "__m.label", "__m.text_after", F.col("__m.x0").alias("marker_x"))


def best_runs(found: DataFrame, keys: list[str], position: str = "pos", height: str = "y0") -> DataFrame:
    """The best run of consecutive labels that begins with A and has two or more, per key: the longest; of equals the lowest, then the last.

    ``labels``: the run's labels; ``run_start``: the position of its A.
    """
    by = Window.partitionBy(*keys).orderBy(position)
    follows = F.ascii("label") == F.lag(F.ascii("label")).over(by) + 1
    cut = found.withColumn("__cut", (~F.coalesce(follows, F.lit(False))).cast("int"))
    island = cut.withColumn("__island", F.sum("__cut").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # An island has at most four labels.
    runs = island.groupBy(*keys, "__island").agg(
        F.min_by("label", position).alias("first"), F.min(position).alias("run_start"), F.min_by(height, position).alias("y"), F.count("*").alias("run_length"), F.array_sort(F.collect_list("label")).alias("labels")
    )
    good = runs.where((F.col("first") == "A") & (F.col("run_length") >= 2))
    best = good.groupBy(*keys).agg(F.max_by(F.struct("run_start", "run_length", "labels"), F.struct("run_length", "y", "run_start")).alias("best"))
    return best.select(*keys, "best.*")


def run_markers(found: DataFrame, keys: list[str], position: str = "pos", height: str = "y0") -> DataFrame:
    """The markers of the best runs, with the question's layout: grid, horizontal or vertical."""
    runs = best_runs(found, keys, position, height)
    by = Window.partitionBy(*keys).orderBy(position)
    numbered = found.withColumn("__n", F.row_number().over(by))
    begin = numbered.select(*keys, F.col(position).alias("run_start"), F.col("__n").alias("__from"))
    joined = numbered.join(runs.join(begin, [*keys, "run_start"]), keys).where(F.col("__n").between(F.col("__from"), F.col("__from") + F.col("run_length") - 1))
    everything = Window.partitionBy(*keys)
    x = {n: F.max(F.when(F.col("label") == n, F.col("marker_x"))).over(everything) for n in "AB"}
    y = {n: F.max(F.when(F.col("label") == n, F.col(height))).over(everything) for n in "ABCD"}
    whole = y["A"].isNotNull() & y["B"].isNotNull() & y["C"].isNotNull() & y["D"].isNotNull()
    rows = (F.abs(y["A"] - y["B"]) <= SAME_ROW) & (F.abs(y["C"] - y["D"]) <= SAME_ROW)
    grid = whole & rows & (x["B"] - x["A"] >= GRID_GAP) & (F.abs(y["A"] - y["C"]) > SAME_ROW)
    level = whole & (F.max(height).over(everything) - F.min(height).over(everything) <= SAME_ROW)
    return joined.withColumn("layout", F.when(grid, "grid").when(level, "horizontal").otherwise("vertical")).drop("__n", "__from")


def option_texts(found: DataFrame, lines: DataFrame, images: DataFrame, keys: list[str], page: str = "page") -> DataFrame:
    """Text and requires_visual of every option of ``run_markers``.

    Lines and markers meet on the question, then by place: below a label and
    above the next, beside it, or in its cell of a grid. Labels standing alone
    and short lines at a picture belong to no option. A grid is pictures
    whatever its texts; an option without text is a picture if one lies near.
    """
    by = Window.partitionBy(*keys).orderBy("pos", "on_line")
    everything = Window.partitionBy(*keys)
    following = lambda c: F.lead(c).over(by)
    left, right = F.min("marker_x").over(everything), F.max("marker_x").over(everything)
    top, bottom = F.min("y0").over(everything), F.max("y0").over(everything)
    lower = F.coalesce(F.max(F.when(F.col("label") == "C", F.col("y0"))).over(everything), F.max(F.when(F.col("label") == "D", F.col("y0"))).over(everything))
    m = found.select(
        *keys, F.col(page).alias("m_page"), F.col("pos").alias("m_pos"), F.col("y0").alias("m_y"), F.col("marker_x").alias("m_x"), "label", "text_after", "layout",
        following(page).alias("n_page"), following("y0").alias("n_y"), following("marker_x").alias("n_x"),
        ((left + right) / 2).alias("mid_x"), ((top + bottom) / 2).alias("mid_y"), left.alias("left"), lower.alias("lower"),
    )
    pictures = images.select(*keys, page, "x0", "y0", "x1", "y1")
    candidates = off_annotations(lines.where(~tx.strip(F.col("text")).isin("A", "B", "C", "D")), pictures, [*keys, page])
    at = F.struct(F.col(page).cast("double"), F.col("y0"), F.col("x0"))
    begin = F.struct(F.col("m_page").cast("double"), F.col("m_y") - VERTICAL_SLACK, F.lit(0.0))
    end = F.when(F.col("n_y").isNotNull(), F.struct(F.col("n_page").cast("double"), F.col("n_y") - VERTICAL_SLACK, F.lit(FAR))).otherwise(F.struct(F.lit(FAR), F.lit(FAR), F.lit(FAR)))
    vertical = (at >= begin) & (at < end)
    x_end = F.when(F.abs(F.col("n_y") - F.col("m_y")) <= SAME_ROW, F.col("n_x") - 4).otherwise(F.lit(FAR))
    horizontal = (F.abs(F.col("y0") - F.col("m_y")) <= SAME_ROW) & (F.col("x0") >= F.col("m_x") - 1) & (F.col("x0") < F.coalesce(x_end, F.lit(FAR)))
    first_column, first_row = F.col("m_x") <= F.col("mid_x"), F.col("m_y") <= F.col("mid_y")
    wide = F.when(first_column, F.col("x0").between(F.col("left") - 10, F.col("mid_x") + 20)).otherwise(F.col("x0").between(F.col("mid_x"), F.lit(FAR)))
    y_end = F.when(first_row & F.col("lower").isNotNull(), F.col("lower") - 8).otherwise(F.col("m_y") + 140)
    cell = (F.col(page) == F.col("m_page")) & wide & F.col("y0").between(F.col("m_y") - 6, y_end)
    own = F.col("pos") == F.col("m_pos")
    inside = F.when(F.col("layout") == "grid", cell).when(F.col("layout") == "horizontal", horizontal & ~own).otherwise(vertical & ~own)
    taken = m.join(candidates.select(*keys, page, "pos", "x0", "y0", F.col("text").alias("line")), keys).where(inside)
    pieces = taken.groupBy(*keys, "label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda s: s["line"]).alias("pieces"))
    joined = m.join(pieces, [*keys, "label"], "left")
    head = F.when((F.col("layout") != "grid") & (F.col("text_after") != ""), F.array("text_after")).otherwise(F.array().cast("array<string>"))
    text = F.nullif(joined_pieces(F.concat(head, F.coalesce("pieces", F.array().cast("array<string>")))), F.lit(""))
    probe = Box(F.col("m_x"), F.col("m_y"), F.col("m_x") + PROBE_WIDTH, F.col("m_y") + PROBE_HEIGHT)
    p = pictures.select(*[F.col(k).alias(f"i_{k}") for k in (*keys, page)], *[F.col(c).alias(f"i_{c}") for c in ("x0", "y0", "x1", "y1")])
    same = F.col(f"i_{page}") == F.col("m_page")
    for k in keys:
        same &= F.col(k) == F.col(f"i_{k}")
    near = m.join(p, same & Box.named("i_").overlaps(probe, PROBE_PAD), "left_semi").select(*keys, "label", F.lit(True).alias("__near"))
    rows = joined.withColumn("text", text).join(near, [*keys, "label"], "left")
    visual = (F.col("layout") == "grid") | (F.col("text").isNull() & F.coalesce("__near", F.lit(False)))
    return rows.select(*keys, "label", F.when(~visual, F.col("text")).alias("text"), visual.alias("requires_visual"))


def off_annotations(lines: DataFrame, images: DataFrame, keys: list[str]) -> DataFrame:
    """Lines that aren't a few words at a picture."""
    p = images.select(*[F.col(k).alias(f"i_{k}") for k in keys], *[F.col(c).alias(f"i_{c}") for c in ("x0", "y0", "x1", "y1")])
    same = F.size(F.split(tx.collapse(F.col("text")), " ")) <= ANNOTATION_WORDS
    for k in keys:
        same &= F.col(k) == F.col(f"i_{k}")
    return lines.join(p, same & Box.named("i_").overlaps(Box.named(""), ANNOTATION_PAD), "left_anti")


def joined_pieces(pieces: Column) -> Column:
    """Pieces of an option joined by spaces; what a reader repeated, with or without a label between, once."""
    clean = F.filter(F.transform(pieces, lambda p: tx.strip(F.regexp_replace(p, r"[ \t]+", " "))), lambda p: p != "")
    joined = tx.collapse_repeat(F.array_join(clean, " "))
    return F.regexp_replace(joined, r"(?is)^(.+?)\s+[A-D]\s+\1$", "$1")


def clean_cell(c: Column) -> Column:
    return tx.collapse(F.coalesce(c, F.lit("")))


def row_option(row: Column) -> Column:
    """Label and text of a table row: a cell that is a label, first of all the first one, else one that begins with a label.

    Other cells that aren't empty are joined by `` | ``, or by spaces behind a
    cell that begins with its label. A row without a label gives null.
    """
    cells = F.transform(row, clean_cell)
    places = F.transform(cells, lambda c, i: F.struct(i.alias("i"), c.isin("A", "B", "C", "D").alias("alone"), c.rlike(LEADING).alias("leads")))
    first = F.get(F.filter(places, lambda p: p["alone"] | p["leads"]), 0)
    place = F.when(F.get(places, 0)["alone"], F.get(places, 0)).otherwise(first)
    cell = F.get(cells, place["i"])
    rest = F.filter(cells, lambda c, i: (i != place["i"]) & (c != ""))
    alone = F.struct(cell.alias("label"), F.array_join(rest, " | ").alias("text"))
    leads = F.struct(F.regexp_extract(cell, LEADING, 1).alias("label"), F.array_join(F.concat(F.array(F.regexp_extract(cell, LEADING, 2)), rest), " ").alias("text"))
    return F.when(F.size(row) > 0, F.when(place["alone"], alone).when(place["leads"], leads))


def table_role(rows: Column) -> Column:
    """options if two or more labels head rows, or a first cell stacks them; else stem."""
    labels = F.array_distinct(F.filter(F.transform(rows, lambda r: row_option(r)["label"]), lambda x: x.isNotNull()))
    stacked = F.exists(rows, lambda r: clean_cell(F.get(r, F.lit(0))).rlike(STACKED))
    return F.when((F.size(labels) >= 2) | stacked, "options").otherwise("stem")


def option_matrix(headers: Column, rows: Column) -> Column:
    """An option table as struct<headers, rows>: labels first, cells padded to one width, headers that say something behind an empty one.

    A cell that begins with its label gives what follows to the second of the
    other cells (the first if it is alone). Rows without a label, and rows that
    stack all labels, are left out; if none is left the table stays as it is,
    with a place for labels in its headers.
    """
    clean = F.transform(rows, lambda r: F.transform(r, clean_cell))
    aligned = F.filter(F.transform(clean, _aligned_row), lambda r: r.isNotNull())
    width = F.array_max(F.transform(aligned, F.size))
    padded = F.transform(aligned, lambda r: F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))))
    names = F.transform(headers, clean_cell)
    telling = F.filter(names, lambda h: (h != "") & ~F.lower(h).isin("unnamed: 0", "unnamed:0") & ~h.isin("A", "B", "C", "D"))
    filled = F.slice(F.concat(telling, F.array_repeat(F.lit(""), F.greatest(width, F.lit(1)))), 1, F.greatest(width - 1, F.lit(0)))
    plain = F.when(F.coalesce(F.get(names, 0), F.lit("x")) == "", names).otherwise(F.concat(F.array(F.lit("")), names))
    result = lambda h, r: F.struct(h.alias("headers"), r.alias("rows"))
    return F.when(F.size(aligned) > 0, result(F.concat(F.array(F.lit("")), filled), padded)).otherwise(result(plain, clean))


def _aligned_row(row: Column) -> Column:
    joined = F.array_join(row, " ")
    found = row_option(row)
    places = F.transform(row, lambda c, i: F.struct(i.alias("i"), (c == found["label"]).alias("alone"), (F.regexp_extract(c, LEADING, 1) == found["label"]).alias("leads")))
    place = F.get(F.filter(places, lambda p: p["alone"] | p["leads"]), 0)
    others = F.filter(row, lambda c, i: i != place["i"])
    tail = tx.strip(F.regexp_extract(F.get(row, place["i"]), LEADING, 2))
    at = F.when(F.size(others) >= 2, 1).otherwise(0)
    merged = F.when(F.size(others) == 0, F.array(tail)).otherwise(F.transform(others, lambda c, i: F.when(i == at, F.trim(F.concat_ws(" ", tail, c))).otherwise(c)))
    cells = F.when(place["alone"] | (tail == ""), others).otherwise(merged)
    stacked = F.regexp_replace(joined, r"\|", " ").rlike(STACKED) | joined.contains("A | B | C | D")
    return F.when(found["label"].isNotNull() & ~stacked, F.concat(F.array(found["label"]), cells))


def table_options(tables: DataFrame, keys: list[str], order: str = "pos") -> DataFrame:
    """Options (map of label to text) from the option table of each question that has most; the first of equals. The last row of a label counts."""
    found = F.filter(F.transform("rows", row_option), lambda o: o["label"].isNotNull() & (o["text"] != ""))
    listed = tables.where(table_role(F.col("rows")) == "options").select(*keys, order, found.alias("__found"))
    last = F.filter("__found", lambda o, i: ~F.exists(F.slice("__found", i + 2, F.greatest(F.size("__found"), F.lit(1))), lambda later: later["label"] == o["label"]))
    maps = listed.withColumn("__map", F.map_from_entries(last)).where(F.size("__map") > 0)
    return maps.groupBy(*keys).agg(F.max_by("__map", F.struct(F.size("__map"), -F.col(order))).alias("table_options"))


def looks_doubled(text: Column) -> Column:
    words = F.split(tx.collapse(text), " ")
    half = F.floor(F.size(words) / 2).cast("int")
    return (F.size(words) >= 4) & (F.slice(words, 1, F.greatest(half, F.lit(1))) == F.slice(words, half + 1, F.greatest(half, F.lit(1))))


def with_table_options(found: DataFrame, from_tables: DataFrame, keys: list[str]) -> DataFrame:
    """Options (label, text, requires_visual) with the table's text where theirs is empty, a picture or said twice."""
    exploded = from_tables.select(*keys, F.explode("table_options").alias("label", "__text"))
    joined = found.join(exploded, [*keys, "label"], "full_outer")
    weak = F.coalesce(F.trim("text"), F.lit("")).eqNullSafe("") | F.coalesce("requires_visual", F.lit(False)) | F.coalesce(looks_doubled(F.col("text")), F.lit(False))
    use = F.col("__text").isNotNull() & weak
    return joined.select(*keys, "label", F.when(use, F.col("__text")).otherwise(F.col("text")).alias("text"), F.when(use, False).otherwise(F.coalesce("requires_visual", F.lit(False))).alias("requires_visual"))


def key_entries(pages: DataFrame, expected: int, paper: str = "paper_id") -> DataFrame:
    """Answers by number from pages (paper, page, text) of an answer key: of repeated numbers the first.

    The key ends at the first page without a pair of 1..expected; later pages
    are ignored.
    """
    numbers = F.regexp_extract_all("text", F.lit(KEY_PAIR), F.lit(1))
    letters = F.regexp_extract_all("text", F.lit(KEY_PAIR), F.lit(2))
    pairs = F.transform(numbers, lambda n, i: F.struct(i.alias("i"), n.cast("int").alias("number"), F.upper(F.element_at(letters, i + 1)).alias("answer")))
    found = pages.withColumn("__pairs", F.filter(pairs, lambda p: p["number"].between(1, expected)))
    ended = F.max((F.size("__pairs") == 0).cast("int")).over(Window.partitionBy(paper).orderBy("page").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = found.withColumn("__ended", ended).where(F.col("__ended") == 0).select(paper, "page", F.explode("__pairs").alias("p"))
    first = rows.groupBy(paper, F.col("p.number").alias("number")).agg(F.min_by(F.struct("p.answer", "page"), F.struct("page", "p.i")).alias("one"))
    return first.select(paper, "number", "one.answer", "one.page")


def number_boxes(entries: DataFrame, words: DataFrame) -> DataFrame:
    """``entries`` (paper_id, number, page) with the box of the first word of their page that is the number, a dot or bracket behind it or not; null if none is."""
    printed = F.regexp_replace(F.trim("text"), r"[.)]+$", "")
    at = words.select("paper_id", "page", F.when(printed.rlike("^[0-9]{1,9}$"), printed.cast("int")).alias("number"), F.struct("pos", "x0", "y0", "x1", "y1").alias("word"))
    first = at.where(F.col("number").isNotNull()).groupBy("paper_id", "page", "number").agg(F.min_by("word", "word.pos").alias("word"))
    joined = entries.join(first, ["paper_id", "page", "number"], "left")
    return joined.withColumn("box", F.when(F.col("word").isNotNull(), F.struct("word.x0", "word.y0", "word.x1", "word.y1"))).drop("word")
