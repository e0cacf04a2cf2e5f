"""Text rules as Column expressions. Whitespace means Unicode whitespace throughout, as in exam files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lines that belong to the page, not to a question.
FURNITURE = (
    r"(?i)^(?:kcpss\b|\[turn over|turn over\]?|section a\b|end of (?:section|paper)"
    r"|-\s*end of section\s*-?"
    r"|this document consists|chemistry\s+6092|paper 1 multiple choice"
    r"|preliminary examination|multiple choice answer sheet|additional materials"
    r"|kuo chuan|secondary school)"
)

#: Wordings that announce a figure.
VISUAL_CUES = (
    r"diagram below",
    r"diagram shows",
    r"\bthe diagram\b",
    r"graph below",
    r"graph shows",
    r"\bthe graph\b",
    r"into a graph",
    r"which graph",
    r"heating curve",
    r"apparatus shown",
    r"set-?up shown",
    r"set-?up below",
    r"shown below",
    r"\bare shown\b",
    r"\bis shown\b",
    r"structures?\b.{0,40}\bshown",
    r"refer to the following set-?up",
    r"refer to the following",
    r"energy profile diagram",
    r"simple cell",
)

HEADER_Y, FOOTER_INSET, PAGE_HEIGHT = 50.0, 50.0, 842.0
PREVIEW_CHARS, CONTEXT_CHARS = 100, 3000
#: A control character that stands around matches while a text is cut.
MARK = "\x01"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of whitespace to one space, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def shortened(c: Column, limit: int) -> Column:
    """A text cut to a limit; three dots stand for what is gone."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 3), F.lit("..."))).otherwise(c)


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it occurs there."""
    return F.element_at(F.transform(F.array(c), use), 1)


def _pieces(text: Column, pattern: str) -> Column:
    """A text cut before and after every match of a pattern: gaps at even places, matches at odd ones.

    Matches are put between marks in one search, and a split at a mark compiles
    no pattern; a split at the pattern compiles it for every row, so that is left
    to texts that hold the mark themselves.
    """
    marked = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    apart = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, match: F.array(gap, match))
    return F.when(F.contains(text, F.lit(MARK)), F.array_compact(F.flatten(apart))).otherwise(marked)


def rewritten(c: Column, pattern: str, form: Callable[[Column], Column]) -> Column:
    """A text with every match of a pattern replaced by an expression of the match."""

    def of(pieces: Column) -> Column:
        drawn = F.transform(pieces, lambda piece, i: F.when(i % 2 == 1, F.coalesce(form(piece), F.lit(""))).otherwise(piece))
        return F.when(F.size(pieces) > 1, F.array_join(drawn, "")).otherwise(F.get(pieces, F.lit(0)))

    return let(c, lambda text: let(_pieces(text, pattern), of))


def located(c: Column, pattern: str) -> Column:
    """Matches of a pattern with their places: array of (raw, start, end), in code points, ends exclusive."""
    kind = "array<struct<raw:string,start:int,end:int>>"

    def add(at: Column, piece: Column) -> Column:
        end = at["at"] + F.length(piece)
        place = F.struct(piece.alias("raw"), at["at"].alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), (~at["odd"]).alias("odd"), F.when(at["odd"], F.array_append(at["found"], place)).otherwise(at["found"]).alias("found"))

    begin = F.struct(F.lit(0).alias("at"), F.lit(False).alias("odd"), F.array().cast(kind).alias("found"))
    found = lambda pieces: F.when(F.size(pieces) > 1, F.aggregate(pieces, begin, add, lambda at: at["found"])).otherwise(F.array().cast(kind))
    return let(c, lambda text: let(_pieces(text, pattern), found))


def preview(c: Column, limit: int = PREVIEW_CHARS) -> Column:
    return shortened(collapse(c), limit)


def norm_ref(c: Column) -> Column:
    """A question reference without case, leading Q and leading zeros; empty becomes ``0``."""
    x = F.regexp_replace(F.upper(strip(c)), r"(?U)^Q\s*", "")
    x = F.regexp_replace(F.coalesce(F.nullif(F.regexp_replace(x, r"^0+", ""), F.lit("")), F.lit("0")), r"(?U)^\s+", "")
    return F.coalesce(F.nullif(F.regexp_replace(x, r"^0+", ""), F.lit("")), F.lit("0"))


def printed_ref(ref: Column) -> Column:
    """A normalized reference with one leading Q."""
    return F.when(ref.startswith("Q"), ref).otherwise(F.concat(F.lit("Q"), ref))


def ref_order(ref: Column) -> list[Column]:
    """Sort keys: digit references first and by number, then text."""
    digits = ref.rlike("^[0-9]+$")
    return [(~digits).cast("int"), F.when(digits, ref.cast("decimal(38,0)")), ref]


def slug(c: Column) -> Column:
    """Lower case, everything but letters and digits to single dashes."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def is_furniture(text: Column, y0: Column, page_height: Column) -> Column:
    """Lines in the header or footer, or worded like page furniture."""
    height = F.coalesce(page_height, F.lit(PAGE_HEIGHT))
    return (y0 < HEADER_Y) | (y0 > height - FOOTER_INSET) | strip(text).rlike(FURNITURE)


def needs_visual(c: Column) -> Column:
    return c.rlike("(?i)" + "|".join(f"(?:{p})" for p in VISUAL_CUES))


def collapse_repeat(c: Column) -> Column:
    """A text of six words or more that begins with a block twice, word for word, becomes that block: the longest of three words or more."""
    words = F.split(collapse(c), " ")
    half = F.floor(F.size(words) / 2).cast("int")
    sizes = F.when(half >= 3, F.sequence(half, F.lit(3))).otherwise(F.array().cast("array<int>"))
    fitting = F.filter(sizes, lambda k: F.slice(words, 1, k) == F.slice(words, k + 1, k))
    return F.when(F.size(fitting) > 0, F.array_join(F.slice(words, 1, F.get(fitting, 0)), " ")).otherwise(c)


def question_number(c: Column) -> Column:
    """The first run of digits; a text without any is an error."""
    digits = F.regexp_extract(c, "([0-9]+)", 1)
    return F.when(digits != "", digits.cast("int")).otherwise(F.raise_error(F.concat(F.lit("no question number: "), F.coalesce(c, F.lit("null")))).cast("int"))
