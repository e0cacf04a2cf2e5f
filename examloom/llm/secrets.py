"""Secret scans (operator 4), in Spark SQL functions only.

Base spans come from three patterns. The method adds spans: in runs of a
character class (candidate strings) a window of fixed width slides over the
characters; the counts of the symbols in it are kept up to date as one enters
and one leaves, and with them the window's Shannon entropy. Overlapping windows
whose entropy reaches the class's threshold make up one span; windows that hold
something of the allow-list count for none. Entropy is kept in whole numbers, so it
does not drift.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of 20 or 24 characters is the first of its kind inside its maximal run, so the length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
ASSIGN_LEAST = 6

WINDOW = 20
ONE = 1 << 20
#: c * log2(c), scaled, for every count a window can hold.
TERMS = tuple(round(ONE * c * math.log2(c)) if c else 0 for c in range(WINDOW + 2))

#: Windows with one of these look random but are known not to be secret; so are whole runs of the second kind.
ALLOWED = (r"(?i)example|sample|placeholder|changeme|redacted|xxxx", r"(?i)0123456789|abcdefgh|qwerty")
ALLOWED_RUNS = (r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",)


@dataclass(frozen=True)
class CharClass:
    """An alphabet, what a candidate must hold besides, and the entropy in bits that makes a window suspect."""

    kind: str
    pattern: str
    alphabet: str
    must: tuple[str, ...]
    bits: float

    @property
    def most(self) -> int:
        """The largest sum of c * log2(c) that still reaches the threshold."""
        return math.floor(ONE * WINDOW * (math.log2(WINDOW) - self.bits))


UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
CLASSES = (
    CharClass("hexentropy", r"[0-9A-Fa-f]{20,}+", DIGITS + "abcdef" + "ABCDEF", ("[0-9]", "[A-Fa-f]"), 2.9),
    CharClass("b36entropy", r"[A-Za-z0-9]{20,}+", UPPER + LOWER + DIGITS, ("[0-9]", "[G-Zg-z]", "^(?:[A-Z0-9]+|[a-z0-9]+)$"), 3.6),
    CharClass("b64entropy", r"[A-Za-z0-9+/_=-]{20,}+", UPPER + LOWER + DIGITS + "+/_=-", ("[0-9]", "[A-Z]", "[a-z]"), 3.7),
)
SPAN = "array<struct<start:int,end:int>>"


def _none() -> Column:
    return F.array().cast(SPAN)


def _span(start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))


def _placed(matches: Column, gaps: Column) -> Column:
    """Spans of all matches of a pattern, from the matches and the stretches between them."""

    def add(at: Column, i: Column) -> Column:
        start = at["at"] + F.length(F.element_at(gaps, i))
        end = start + F.length(F.element_at(matches, i))
        return F.struct(end.cast("int").alias("at"), F.array_append(at["spans"], _span(start, end)).alias("spans"))

    begin = F.struct(F.lit(0).cast("int").alias("at"), _none().alias("spans"))
    return F.when(F.size(matches) > 0, F.aggregate(F.sequence(F.lit(1), F.size(matches)), begin, add, lambda at: at["spans"])).otherwise(_none())


def _hot_windows(candidate: Column, cls: CharClass, allowed: Sequence[str]) -> Column:
    """Merged spans, within a candidate, of the windows that reach the threshold and hold nothing of the allow-list."""
    terms = F.from_json(F.lit(str(list(TERMS))), "array<int>")
    term = lambda c: F.element_at(terms, c + 1).cast("long")
    symbol = lambda i: F.instr(F.lit(cls.alphabet), F.substring(candidate, i, F.lit(1)))

    def slide(s: Column, i: Column) -> Column:
        """Position i (from 1) enters, i - WINDOW leaves."""
        enters, full = symbol(i), i > WINDOW
        leaves = F.when(full, symbol(i - WINDOW)).otherwise(F.lit(0))
        n_in = F.element_at(s["counts"], enters)
        n_out = F.when(full, F.element_at(s["counts"], F.greatest(leaves, F.lit(1)))).otherwise(F.lit(0))
        total = F.when(enters == leaves, s["total"]).otherwise(
            s["total"] + term(n_in + 1) - term(n_in) + F.when(full, term(n_out - 1) - term(n_out)).otherwise(F.lit(0).cast("long"))
        )
        counts = F.transform(s["counts"], lambda c, j: c + (j + 1 == enters).cast("int") - (j + 1 == leaves).cast("int"))
        hot = (i >= WINDOW) & (total <= cls.most)
        for pattern in allowed:
            hot &= ~F.substring(candidate, i - WINDOW + 1, F.lit(WINDOW)).rlike(pattern)
        touches = hot & (s["end"] > i - WINDOW)
        closed = F.when(hot & ~touches & (s["end"] > 0), F.array_append(s["spans"], _span(s["start"], s["end"]))).otherwise(s["spans"])
        return F.struct(
            counts.alias("counts"),
            total.cast("long").alias("total"),
            F.when(hot & ~touches, i - WINDOW).otherwise(s["start"]).cast("int").alias("start"),
            F.when(hot, i).otherwise(s["end"]).cast("int").alias("end"),
            closed.alias("spans"),
        )

    begin = F.struct(
        F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"),
        F.lit(0).cast("long").alias("total"),
        F.lit(0).cast("int").alias("start"),
        F.lit(0).cast("int").alias("end"),
        _none().alias("spans"),
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.length(candidate)),
        begin,
        slide,
        lambda s: F.when(s["end"] > 0, F.array_append(s["spans"], _span(s["start"], s["end"]))).otherwise(s["spans"]),
    )


def _entropy_spans(text: Column, candidates: Column, placed: Column, cls: CharClass, allowed: Sequence[str]) -> Column:
    def of(place: Column) -> Column:
        candidate = F.substring(text, place["start"] + 1, place["end"] - place["start"])
        suspect = F.lit(True)
        for must in cls.must:
            suspect &= candidate.rlike(must)
        for pattern in ALLOWED_RUNS:
            suspect &= ~candidate.rlike(pattern)
        return F.when(suspect, F.transform(_hot_windows(candidate, cls, allowed), lambda w: _span(place["start"] + w["start"], place["start"] + w["end"]))).otherwise(_none())

    return F.when(F.size(candidates) > 0, F.flatten(F.transform(placed, of))).otherwise(_none())


KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))


def scan(df: DataFrame, text_col: str = "text", out_col: str = "secrets", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """``df`` with the secrets of a text as ``out_col``: array of (start, kind, end), by start, then kind.

    Positions count code points, ends are exclusive. ``kind`` is an index into
    ``KINDS``: assign, access and hex are the base patterns (never suppressed),
    the others come from entropy windows and may overlap base spans. A null or
    empty text has none; repeated rows are scanned each; an existing column
    named ``out_col`` is replaced, all others pass through.
    """
    names = {k: common.fresh(df, f"__{k}") for k in ("text", *(f"{p}{i}" for p in ("m", "g", "p") for i in range(len(KINDS))), "values")}
    n = lambda k: F.col(names[k])
    patterns = (ASSIGN, ACCESS, HEX, *(c.pattern for c in CLASSES))
    found = df.withColumn(names["text"], F.coalesce(common.col(text_col), F.lit("")))
    found = found.withColumns({names[f"m{i}"]: F.regexp_extract_all(n("text"), F.lit(p), F.lit(0)) for i, p in enumerate(patterns)})
    split = {names[f"g{i}"]: F.when(F.size(n(f"m{i}")) > 0, F.split(n("text"), p, -1)) for i, p in enumerate(patterns)}
    found = found.withColumns(split | {names["values"]: F.when(F.size(n("m0")) > 0, F.regexp_extract_all(n("text"), F.lit(ASSIGN), F.lit(2)))})
    found = found.withColumns({names[f"p{i}"]: _placed(n(f"m{i}"), n(f"g{i}")) for i in range(len(patterns))})
    of_kind = [
        F.when(F.size(n("m0")) > 0, F.filter(n("p0"), lambda s, i: F.length(F.element_at(n("values"), i + 1)) >= ASSIGN_LEAST)).otherwise(_none()),
        n("p1"),
        n("p2"),
        *[_entropy_spans(n("text"), n(f"m{i}"), n(f"p{i}"), cls, allowed) for i, cls in enumerate(CLASSES, 3)],
    ]
    tagged = [F.transform(spans, _tagger(k)) for k, spans in enumerate(of_kind)]
    result = F.array_sort(F.concat(*tagged))
    return found.withColumn(out_col, result).drop(*[v for v in names.values()])


def _tagger(kind: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))


def written(secrets: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def base(secrets: Column) -> Column:
    return F.filter(secrets, lambda s: s["kind"] < 3)


def redact(df: DataFrame, text_col: str = "text", mask: str = "<SECRET>", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """``df`` with every secret of a text replaced by ``mask``; overlapping spans get one. Texts without secrets, null too, stay as they are."""
    spans = common.fresh(df, "__spans")
    found = scan(df, text_col, spans, allowed)
    text = common.col(text_col)

    def add(s: Column, x: Column) -> Column:
        apart = x["start"] >= s["end"]
        return F.struct(
            F.when(apart, F.concat(s["text"], F.substring(text, s["end"] + 1, x["start"] - s["end"]), F.lit(mask))).otherwise(s["text"]).alias("text"),
            F.greatest(s["end"], x["end"]).alias("end"),
        )

    begin = F.struct(F.lit("").alias("text"), F.lit(0).cast("int").alias("end"))
    clean = F.aggregate(F.col(spans), begin, add, lambda s: F.concat(s["text"], F.substring(text, s["end"] + 1, F.length(text))))
    return found.withColumn(text_col, F.when(F.size(spans) > 0, clean).otherwise(text)).drop(spans)
