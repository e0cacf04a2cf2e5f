"""Content blocks of a question: cleaning, and pictures put where they belong. Both are folds over a question's own blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions import text as tx

BLOCK = "struct<type:string,text:string,requires_visual:boolean,asset_path:string,table_index:int>"
#: Texts an extractor leaves where it found none, dumps of all options, and openings of real sentences.
PLACEHOLDER = (
    r"(?i)^(intro text before any diagram|question sentence after diagram|"
    r"full stem.*|option [a-d] text.*|real stem text.*|real question sentence.*|"
    r"<[^>]+>)$"
)
OPTION_DUMP = r"(?i)^A\s+.+\s+B\s+.+\s+C\s+.+\s+D\s+.+$"
OPTION_PREFIX = r"(?i)^[A-D](?:[.):]|\s+)\s*(.+)$"
SENTENCE = r"(?i)^(the|which|what|how|when|where|why|refer|a |an |in |from |to )"
TEST_ROW = r"(?i)^test\s*\d+\b"
LABEL_CHARS, LABEL_WORDS = 36, 5


def option_forms(options: Column) -> Column:
    """Option texts in lower case, bare and behind their labels (``a text`` and ``a: text``). ``options``: array of struct<label, text>."""
    filled = F.filter(F.transform(options, lambda o: F.struct(F.lower(o["label"]).alias("l"), F.lower(tx.collapse(o["text"])).alias("t"))), lambda o: F.coalesce(o["t"], F.lit("")) != "")
    return F.flatten(F.transform(filled, lambda o: F.array(o["t"], F.concat_ws(" ", o["l"], o["t"]), F.concat(o["l"], F.lit(": "), o["t"]))))


def leaks_option(text: Column, forms: Column) -> Column:
    """A text that is an option, all options in a row, or a label with an option's text or its end."""
    key = F.lower(tx.collapse(text))
    body = F.lower(tx.collapse(F.nullif(F.regexp_extract(text, OPTION_PREFIX, 1), F.lit(""))))
    ends = F.exists(forms, lambda f: (f == body) | ((f.contains(" ") | f.contains(",")) & f.endswith(body)))
    return F.array_contains(forms, key) | key.rlike(OPTION_DUMP) | F.coalesce(body.isNotNull() & ends, F.lit(False))


def figure_label(text: Column) -> Column:
    """Short, no question, not the opening of a sentence."""
    return ~text.endswith("?") & (F.length(text) <= LABEL_CHARS) & (F.size(F.split(text, " ")) <= LABEL_WORDS) & ~text.rlike(SENTENCE)


def cleaned(blocks: Column, stem: Column, options: Column, has_diagram: Column) -> Column:
    """Blocks without placeholders, repeats, leaked options, the stem told again, labels of figures, and diagrams after the first."""
    forms = option_forms(options)
    stem_key = F.lower(tx.collapse(F.coalesce(stem, F.lit(""))))

    def step(s: Column, b: Column) -> Column:
        text = tx.collapse(F.coalesce(b["text"], F.lit("")))
        key = F.lower(text)
        retold = (stem_key != "") & (key == stem_key) & F.exists(s["kept"], lambda k: k["type"] == "text")
        noise = has_diagram & (figure_label(text) | text.rlike(TEST_ROW))
        drop_text = (text == "") | text.rlike(PLACEHOLDER) | F.array_contains(s["seen"], key) | leaks_option(text, forms) | retold | noise
        is_text, is_diagram = b["type"] == "text", b["type"] == "diagram"
        drop = (is_diagram & s["diagram"]) | (is_text & drop_text)
        block = F.struct(b["type"].alias("type"), F.when(is_text, text).otherwise(b["text"]).alias("text"), b["requires_visual"].alias("requires_visual"), b["asset_path"].alias("asset_path"), b["table_index"].alias("table_index")).cast(BLOCK)
        return F.struct(
            F.when(drop, s["kept"]).otherwise(F.array_append(s["kept"], block)).alias("kept"),
            F.when(drop | ~is_text, s["seen"]).otherwise(F.array_append(s["seen"], key)).alias("seen"),
            (s["diagram"] | is_diagram).alias("diagram"),
        )

    begin = F.struct(F.array().cast(f"array<{BLOCK}>").alias("kept"), F.array().cast("array<string>").alias("seen"), F.lit(False).alias("diagram"))
    return F.aggregate(blocks, begin, step, lambda s: s["kept"])


def block(kind: str, text: Column | None = None, path: Column | None = None, visual: Column | bool = False) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(kind).alias("type"),
        (none if text is None else text).alias("text"),
        (F.lit(visual) if isinstance(visual, bool) else visual).alias("requires_visual"),
        (none if path is None else path).alias("asset_path"),
        F.lit(None).cast("int").alias("table_index"),
    ).cast(BLOCK)


def with_options_block(blocks: Column, options: Column, visual: Column) -> Column:
    """Blocks that end with the options if they hold no options block yet."""
    lines = F.array_join(F.transform(F.filter(options, lambda o: F.coalesce(o["text"], F.lit("")) != ""), lambda o: F.concat(o["label"], F.lit(": "), o["text"])), "\n")
    added = block("options", F.when(~visual, lines), visual=visual)
    return F.when(F.exists(blocks, lambda b: b["type"] == "options"), blocks).otherwise(F.array_append(blocks, added))


def with_assets(blocks: Column, stem_paths: Column, option_path: Column) -> Column:
    """Pictures put into blocks: the k-th diagram takes the k-th of the stem, diagrams beyond that go.

    Further stem pictures come before the options. The options' picture goes to
    the options block; without one, a last diagram becomes it if the stem has
    pictures, else a block is added.
    """

    def step(s: Column, b: Column) -> Column:
        diagram, got = b["type"] == "diagram", s["n"] < F.size(stem_paths)
        filled = block("diagram", b["text"], F.get(stem_paths, s["n"]), True)
        return F.struct(
            F.when(diagram & got, F.array_append(s["out"], filled)).when(diagram, s["out"]).otherwise(F.array_append(s["out"], b)).alias("out"),
            (s["n"] + (diagram & got).cast("int")).alias("n"),
        )

    begin = F.struct(F.array().cast(f"array<{BLOCK}>").alias("out"), F.lit(0).alias("n"))
    placed = F.aggregate(blocks, begin, step)
    extra = F.transform(F.slice(stem_paths, placed["n"] + 1, F.size(stem_paths)), lambda p: block("diagram", path=p, visual=True))
    is_options = lambda b: b["type"] == "options"
    has_options = F.exists(placed["out"], is_options)
    at = F.coalesce(F.nullif(F.array_position(F.transform(placed["out"], lambda b: b["type"]), "options"), F.lit(0)), F.size(placed["out"]) + 1).cast("int")
    merged = F.concat(F.slice(placed["out"], 1, at - 1), extra, F.slice(placed["out"], at, F.size(placed["out"]) + 1))
    picture = block("options", path=option_path, visual=True)
    filled = F.transform(merged, lambda b: F.when(is_options(b), block("options", b["text"], option_path, True)).otherwise(b))
    mislabelled = (F.size(merged) > 0) & (F.try_element_at(merged, F.lit(-1))["type"] == "diagram") & (F.size(stem_paths) > 0)
    appended = F.when(mislabelled, F.array_append(F.slice(merged, 1, F.size(merged) - 1), picture)).otherwise(F.array_append(merged, picture))
    return F.when(option_path.isNull(), merged).when(has_options, filled).otherwise(appended)


def content(questions: DataFrame) -> DataFrame:
    """``content`` of questions from their raw_blocks: cleaned, with options, with pictures.

    Expects raw_blocks (array of ``BLOCK``), stem, options (array of
    struct<label, text>), has_diagram, visual_options, stem_paths, option_path.
    """
    first = questions.withColumn("content", cleaned(F.col("raw_blocks"), F.col("stem"), F.col("options"), F.col("has_diagram")))
    whole = first.withColumn("content", with_options_block(F.col("content"), F.col("options"), F.col("visual_options")))
    return whole.withColumn("content", with_assets(F.col("content"), F.col("stem_paths"), F.col("option_path")))


def structured_content(questions: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    """Questions with ``content``: the stem, a diagram if they have one, and their parts behind ``(a)`` or ``(a)(i)``. Parts come with label, prompt, part and parent."""
    roots = parts.select(*keys, F.col("part").alias("parent"), F.col("label").alias("__root"))
    named = parts.join(roots, [*keys, "parent"], "left")
    head = F.concat(F.coalesce(F.concat(F.lit("("), "__root", F.lit(")")), F.lit("")), F.lit("("), "label", F.lit(") "))
    told = named.where(F.coalesce(F.trim("prompt"), F.lit("")) != "").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", F.concat(head, "prompt").alias("text")))).alias("__parts"))
    rows = questions.join(told, keys, "left")
    stem = F.when(F.coalesce(F.trim("stem"), F.lit("")) != "", block("text", F.col("stem")))
    diagram = F.when(F.col("has_diagram"), block("diagram", visual=True))
    listed = F.transform(F.coalesce("__parts", F.array().cast("array<struct<part:int,text:string>>")), lambda p: block("text", p["text"]))
    return rows.withColumn("content", F.filter(F.concat(F.array(stem, diagram), listed), lambda b: b.isNotNull())).drop("__parts")
