"""Lines of a page: reading order, plain text with made-up geometry, page furniture, labels from a second source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examloom.functions import text as tx
from examloom.functions.boxes import Box

LAST = 10_000_000
A4_WIDTH, A4_HEIGHT = 595.3, 841.9
NUMBER_X, LEAST_SPAN, LEAST_WIDTH = 77.2, 10.0, 40.0
TABLE_ROWS = 20
#: A question that begins inside a block of text, or at its head.
EMBEDDED_QUESTION = r"\s+(?=(?:[1-9]|[1-3]\d|40)\s+(?:[A-Z][a-z]+|[A-Z]\s+[a-z]))"
QUESTION_HEAD = r"(?i)^(?:Q\s*)?([1-9]|[1-3]\d|40)(?:[.)]\s*|\s+)(\S.*)$"
LINE_BREAKS = r"\r\n|[\n\r\u000B\u000C\u001C\u001D\u001E\u0085  ]"


def reading_order(lines: DataFrame, paper: str = "paper_id") -> DataFrame:
    """``lines`` with line_index, from 0 within a paper.

    If any line of the paper has a reading_order, lines go by page, reading
    order (those without come last), y0 and x0; else by page, y0, x0 and
    block_index. ``pos`` breaks ties. Whether one has is found by an aggregate,
    so no line waits for the others twice.
    """
    ordered = F.bool_or(F.col("reading_order").isNotNull()).over(Window.partitionBy(paper))
    rank = F.when(F.col("__ordered"), F.coalesce("reading_order", F.lit(LAST))).otherwise(0)
    tail = F.when(F.col("__ordered"), 0).otherwise(F.col("block_index"))
    by = Window.partitionBy(paper).orderBy("page", rank, "y0", "x0", tail, "pos")
    return lines.withColumn("__ordered", ordered).withColumn("line_index", F.row_number().over(by) - 1).drop("__ordered")


def text_lines(text: Column) -> Column:
    """The lines of a text that aren't blank, stripped."""
    return F.filter(F.transform(F.split(text, LINE_BREAKS), tx.strip), lambda line: line != "")


def text_context(text: Column, limit: int = tx.CONTEXT_CHARS) -> Column:
    """``page_context`` of a page whose text is one value: nothing leaves its row."""
    return tx.let(F.array_join(text_lines(text), "\n"), lambda joined: tx.shortened(joined, limit))


def plain_text_lines(docs: DataFrame, id_col: str, text_col: str, width: float = A4_WIDTH, height: float = A4_HEIGHT) -> DataFrame:
    """Lines of a text that aren't blank, spread evenly over a page: text, block_index and box. A text without any gives no row."""
    lines = text_lines(F.col(text_col))
    row = F.lit(float(height)) / (F.size("__lines") + 2)
    exploded = docs.select(id_col, lines.alias("__lines")).where(F.size("__lines") > 0).select(id_col, row.alias("__row"), F.posexplode("__lines").alias("block_index", "text"))
    y0 = F.lit(40.0) + F.col("block_index") * F.col("__row")
    return exploded.select(
        id_col, "block_index", "text", F.lit(72.0).alias("x0"), y0.alias("y0"), F.lit(float(width) - 40).alias("x1"), (y0 + F.col("__row")).alias("y1")
    )


def without_furniture(lines: DataFrame, page_height: Column) -> DataFrame:
    return lines.where(~tx.is_furniture(F.col("text"), F.col("y0"), page_height))


def page_context(lines: DataFrame, keys: list[str], order: list[str], limit: int = tx.CONTEXT_CHARS) -> DataFrame:
    """The stripped lines of a page, one below the other, cut to a limit with three dots. Blank lines are left out."""
    stripped = lines.withColumn("__text", tx.strip(F.col("text"))).where(F.col("__text") != "")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "__text"))), lambda s: s["__text"]), "\n")
    return stripped.groupBy(*keys).agg(tx.shortened(joined, limit).alias("context"))


def missing_labels(lines: DataFrame, labels: DataFrame, paper: str = "paper_id") -> DataFrame:
    """``lines`` with the question labels of a second source that they lack.

    Both have text, page, box and pos; a label is there already if a line of
    its page starts with the same number. Labels take their place by y0 and x0
    (they get no reading order of their own: a page-local number would sort
    them before the body of later pages).
    """
    number = F.regexp_extract(tx.strip(F.col("text")), r"(?i)^(?:Q\s*)?([0-9]{1,2})(?![0-9])", 1)
    have = lines.select(paper, "page", number.alias("__number")).where(F.col("__number") != "").distinct()
    lacking = labels.withColumn("__number", number).join(have, [paper, "page", "__number"], "left_anti").drop("__number")
    return lines.unionByName(lacking, allowMissingColumns=True)


def without_table_text(lines: DataFrame, tables: DataFrame, keys: list[str]) -> DataFrame:
    """Lines whose middle lies in no table of their page."""
    t = tables.select(*[F.col(k).alias(f"t_{k}") for k in keys], *[F.col(n).alias(f"t_{n}") for n in ("x0", "y0", "x1", "y1")])
    same = F.lit(True)
    for k in keys:
        same &= F.col(k) == F.col(f"t_{k}")
    return lines.join(t, same & Box.named("t_").holds(*Box.named("").middle()), "left_anti")


def block_lines(blocks: DataFrame) -> DataFrame:
    """Lines of text blocks (paper_id, page, pos, text, x0 to y1), cut at line breaks and before embedded questions.

    The lines share the block's height, at least 10 points each; one that
    begins like a question starts no further right than question numbers do.
    ``pos`` becomes the order of the lines in the paper's blocks.
    """
    cut = F.flatten(F.transform(F.split("text", LINE_BREAKS), lambda line: F.split(line, EMBEDDED_QUESTION)))
    pieces = F.filter(F.transform(cut, tx.strip), lambda p: p != "")
    rows = blocks.withColumn("__pieces", pieces).where(F.size("__pieces") > 0)
    span = F.greatest((F.col("y1") - F.col("y0")) / F.size("__pieces"), F.lit(LEAST_SPAN))
    rows = rows.withColumn("__span", span).select("*", F.posexplode("__pieces").alias("line_no", "__piece"))
    x0 = F.when(F.col("__piece").rlike(QUESTION_HEAD), F.least("x0", F.lit(NUMBER_X))).otherwise(F.col("x0"))
    y0 = F.col("y0") + F.col("line_no") * F.col("__span")
    return rows.select(
        "paper_id", "page", (F.col("pos") * 1000 + F.col("line_no")).alias("pos"), F.col("__piece").alias("text"), x0.alias("x0"), y0.alias("y0"),
        F.greatest("x1", x0 + LEAST_WIDTH).alias("x1"), F.least("y1", y0 + F.col("__span")).alias("y1"), F.col("pos").alias("block_index"), "line_no",
    )


def table_text(headers: Column, rows: Column, number: Column) -> Column:
    """A table as context for an extractor: headers and the first 20 rows, and how many more there are."""
    cells = lambda r: F.array_join(F.filter(F.transform(r, lambda c: F.trim(F.coalesce(c, F.lit("")))), lambda c: c != ""), " | ")
    head = F.when(F.size(headers) > 0, F.concat(F.lit("Headers: "), F.array_join(headers, " | ")))
    body = F.transform(F.slice(rows, 1, TABLE_ROWS), lambda r: F.concat(F.lit("Row: "), cells(r)))
    more = F.when(F.size(rows) > TABLE_ROWS, F.concat(F.lit("... ("), (F.size(rows) - TABLE_ROWS).cast("string"), F.lit(" more rows)")))
    parts = F.concat(F.array(F.concat(F.lit("Table "), number.cast("string"), F.lit(":")), head), body, F.array(more))
    return F.array_join(F.filter(parts, lambda p: p.isNotNull()), "\n")
