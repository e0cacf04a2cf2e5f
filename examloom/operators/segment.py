"""Questions and parts in an ordered stream of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examloom.functions import text as tx

MARGIN, STRUCTURED_MARGIN = 90.0, 120.0
GAP, LONG_STEM = 2, 60
TITLE_LINES, TITLE_PIECES = 12, 3
MOST_CANDIDATES = 1_000_000

#: What may and may not follow a question number.
NUMBER_THEN_STEM = r"(?i)^(?:Q\s*)?(\d{1,2})(?:[.)]\s*|\s+)(\S.*)$"
FALSE_STEM = (
    r"(?i)^(?:"
    r"hour\b|express\b|multiple choice\b|"
    r"january|february|march|april|may|june|july|august|september|october|november|december|"
    r"iron\b|steel\b|diamond\b|graphite\b|"
    r"fractional distillation\b|evaporation\b|filtration\b|use of a separating funnel\b|"
    r"and \d+ only\b|only\b"
    r")"
)
QUESTIONISH_STEM = (
    r"(?i)^(?:"
    r"the |which |what |how |when |where |why |a |an |in |refer |"
    r"some |element |solutions? |oxalic |propyl |metals? |hydrazine |"
    r"a student|a mixture|a sample|a molecule|a section|an element|an aqueous|"
    r"solutions p|the elements|the element|the diagram|the graph|the apparatus|"
    r"the following|the structures|the reactions|the isotopes"
    r")"
)
ISOTOPE_LIKE = r"^\d{2,3}\s+[A-Za-z]"
STRUCTURED_START = r"(?i)^(?:Q\s*)?([1-9]\d?)(?:[.)]\s*|\s*$|\s+)(.*)$"
ANSWERS_START = r"(?i)^(?:answers?\b|mark\s*scheme\b|suggested\s+answers?\b)"
PART = r"(?i)^\(\s*([a-z]|[ivx]+)\s*\)(?:\s+(.*))?$"
ROMAN = ("i", "ii", "iii", "iv", "v")
MARKS = r"\[\s*(\d+)\s*\]"
TOTAL = r"(?i)\[\s*total\s*:\s*(\d+)\s*\]"
PAGE_ONLY = r"^\d{1,3}$"
TITLE_NOISE = r"(?i)^(?:o\s*level|pure\s+chemistry|ammonia\s+test|structured\b)"
ANSWER_DOTS = r"^\.{3,}$|^_{3,}$|^[.\s]{6,}$"


def plausible_stem(stem: Column) -> Column:
    """Whether a text after a number reads like the beginning of a question."""
    s = tx.collapse(stem)
    ends_asking, opening, long = s.endswith("?"), s.rlike(QUESTIONISH_STEM), F.length(s) >= LONG_STEM
    return (s == "") | (~s.rlike(FALSE_STEM) & ~s.rlike(ISOTOPE_LIKE) & (ends_asking | opening | long))


def candidates(lines: DataFrame, page_height: Column) -> DataFrame:
    """Lines that may start a question: number and stem_prefix added."""
    text = tx.strip(F.col("text"))
    alone = text.rlike(r"^[0-9]{1,2}$")
    number = F.when(alone, text).otherwise(F.regexp_extract(text, NUMBER_THEN_STEM, 1))
    stem = F.when(alone, F.lit("")).otherwise(tx.strip(F.regexp_extract(text, NUMBER_THEN_STEM, 2)))
    found = lines.where(~tx.is_furniture(F.col("text"), F.col("y0"), page_height) & (F.col("x0") <= MARGIN))
    found = found.withColumns({"number": F.nullif(number, F.lit("")).cast("int"), "stem_prefix": stem})
    return found.where(F.col("number").between(1, 99) & (alone | plausible_stem(F.col("stem_prefix"))))


def accepted(numbers: Column, expected: int) -> Column:
    """Of an ordered array of numbers, those a scan accepts, as an array of their places (from 0).

    The scan takes the number it expects next; once it has taken one it also
    takes numbers up to two further on; what it takes may not exceed
    ``expected``. Each choice depends on the ones before, so this is a fold.
    """

    def step(s: Column, x: Column) -> Column:
        n = x["n"]
        fits = (n <= expected) & ((n == s["next"]) | ((n > s["next"]) & (n <= s["next"] + GAP) & (F.size(s["taken"]) > 0)))
        return F.struct(
            F.when(fits, n + 1).otherwise(s["next"]).cast("int").alias("next"),
            F.when(fits, F.array_append(s["taken"], x["i"])).otherwise(s["taken"]).alias("taken"),
        )

    begin = F.struct(F.lit(1).cast("int").alias("next"), F.array().cast("array<int>").alias("taken"))
    indexed = F.transform(numbers, lambda n, i: F.struct(n.cast("int").alias("n"), i.cast("int").alias("i")))
    return F.aggregate(indexed, begin, step, lambda s: s["taken"])


def greedy_starts(found: DataFrame, paper: str, order: list[str], expected: int, number: str = "number") -> DataFrame:
    """The candidates of each paper that the scan accepts.

    A paper's candidates are gathered: a scan has no parallel form, and a paper
    is a document. Only numbers that the scan can accept are, and of a run of
    one number only the first: after it the scan waits for a greater one. What
    is gathered is thus no longer than the paper is, and a paper of more than
    ``MOST_CANDIDATES`` is an error rather than an endless fold.
    """
    by = Window.partitionBy(paper).orderBy(*order)
    found = found.where(F.col(number).between(1, expected)).withColumn("__before", F.lag(number).over(by))
    found = found.where(~F.col("__before").eqNullSafe(F.col(number))).drop("__before")
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(number).alias("__number"), *[c for c in found.columns if c not in (paper, *order)])))
    listed = found.groupBy(paper).agg(rows.alias("__rows"))
    too_many = F.raise_error(F.lit(f"a paper has more than {MOST_CANDIDATES} candidates for question starts"))
    listed = listed.withColumn("__rows", F.when(F.size("__rows") > MOST_CANDIDATES, too_many.cast(listed.schema["__rows"].dataType)).otherwise(F.col("__rows")))
    taken = listed.withColumn("__taken", accepted(F.transform("__rows", lambda r: r["__number"]), expected))
    picked = taken.select(paper, F.explode(F.transform("__taken", lambda i: F.element_at("__rows", i + 1))).alias("__row"))
    return picked.select(paper, "__row.*").drop("__number").select(*found.columns)


def increasing_starts(found: DataFrame, paper: str, order: list[str], number: str = "number") -> DataFrame:
    """Candidates whose number exceeds all before it: every larger number is accepted, so a running maximum decides."""
    before = Window.partitionBy(paper).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    most = F.max(number).over(before)
    return found.withColumn("__most", most).where(F.coalesce(F.col(number) > F.col("__most"), F.lit(True))).drop("__most")


def structured_candidates(lines: DataFrame, paper: str = "paper_id") -> DataFrame:
    """Lines that may start a structured question, up to the first line of the answers, which needs no second look at the paper."""
    text = tx.strip(F.col("text"))
    so_far = Window.partitionBy(paper).orderBy("line_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = lines.withColumn("__answers", F.max(text.rlike(ANSWERS_START).cast("int")).over(so_far)).where(F.col("__answers") == 0).drop("__answers")
    inside = inside.where(~text.rlike(PAGE_ONLY) & ~text.rlike(TITLE_NOISE))
    found = inside.withColumn("number", F.nullif(F.regexp_extract(text, STRUCTURED_START, 1), F.lit("")).cast("int"))
    found = found.withColumn("stem_prefix", tx.strip(F.regexp_extract(text, STRUCTURED_START, 2)))
    return found.where(F.col("number").isNotNull() & ((F.col("x0") <= STRUCTURED_MARGIN) | text.rlike("(?i)^Q")))


def slices(lines: DataFrame, starts: DataFrame, page_height: Column, paper: str = "paper_id") -> DataFrame:
    """Lines with the number of the question they belong to: from its start to the next, page furniture left out."""
    marked = lines.join(starts.select(paper, "line_index", F.col("number").alias("__number")), [paper, "line_index"], "left")
    so_far = Window.partitionBy(paper).orderBy("line_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = marked.withColumn("question", F.last("__number", ignorenulls=True).over(so_far)).drop("__number")
    return owned.where(F.col("question").isNotNull() & ~tx.is_furniture(F.col("text"), F.col("y0"), page_height))


def parts(lines: DataFrame, keys: list[str], order: str = "line_index") -> DataFrame:
    """Parts of structured questions: label, prompt and marks, from the lines up to the next part.

    Page numbers, dotted answer lines and totals are left out, as are lines
    before the first part; marks are the first in brackets.
    """
    text = tx.strip(F.col("text"))
    label = F.lower(F.nullif(F.regexp_extract(text, PART, 1), F.lit("")))
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = lines.where(~text.rlike(PAGE_ONLY) & ~text.rlike(ANSWER_DOTS))
    begun = kept.withColumns({"__label": label, "__text": F.when(label.isNotNull(), F.regexp_extract(text, PART, 2)).otherwise(text)})
    begun = begun.withColumn("part", F.last(F.when(F.col("__label").isNotNull(), F.col(order)), ignorenulls=True).over(so_far))
    begun = begun.where(F.col("part").isNotNull() & (F.col("__label").isNotNull() | ~text.rlike(TOTAL)))
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col("__text").alias("text"))))
    joined = begun.groupBy(*keys, "part").agg(F.max("__label").alias("label"), F.array_join(F.transform(rows, lambda r: r["text"]), " ").alias("__joined"))
    marks = F.nullif(F.regexp_extract(F.regexp_replace(F.col("__joined"), TOTAL, ""), MARKS, 1), F.lit("")).cast("int")
    return joined.select(*keys, "part", "label", without_marks(F.col("__joined")).alias("prompt"), marks.alias("marks"))


def marks_total(lines: DataFrame, keys: list[str], order: str = "line_index") -> DataFrame:
    """The last total of each question."""
    total = F.nullif(F.regexp_extract("text", TOTAL, 1), F.lit("")).cast("int")
    return lines.withColumn("__total", total).where(F.col("__total").isNotNull()).groupBy(*keys).agg(F.max_by("__total", order).alias("marks_total"))


def without_marks(text: Column) -> Column:
    """A text without totals and marks in brackets."""
    return tx.collapse(F.regexp_replace(F.regexp_replace(text, TOTAL, ""), MARKS, ""))


def nest(rows: DataFrame, keys: list[str], order: str, is_root: Column) -> DataFrame:
    """``rows`` with ``parent``: the order of the last root before a row that is none; null for roots and for rows before any root."""
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(is_root, F.col(order)), ignorenulls=True).over(so_far)
    return rows.withColumn("parent", F.when(~is_root, last))


def nest_parts(found: DataFrame, keys: list[str]) -> DataFrame:
    """Parts under the part before them that isn't labelled i to v; such a label with no part before it stays a root."""
    return nest(found, keys, "part", ~F.col("label").isin(*ROMAN))
