"""Registered queries that apply operators on boxes, references, rows and issues to columns of the shared tables with the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from examloom.functions import boxes
from examloom.functions import text as tx
from examloom.operators import classify, crops, layout, options, sinks, spatial, validation
from examloom.plans import paper
from examloom.plans.registration import query, table
from examloom.sources import pages

# A box for each line of an order, from its numbers; its page is its number within the order.

BOX_SQL = """
WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, l_quantity AS x0, l_linenumber * 10.0::DOUBLE AS y0,
  l_quantity + l_discount * 200 AS x1, l_linenumber * 10.0::DOUBLE + l_tax * 300 AS y1 FROM lineitem)"""
AREA = "greatest(0.0, {0}.x1 - {0}.x0) * greatest(0.0, {0}.y1 - {0}.y0)"
SHARED = "greatest(0.0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0.0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    y0 = F.col("l_linenumber") * F.lit(10.0)
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", F.col("l_quantity").alias("x0"), y0.alias("y0"), (F.col("l_quantity") + F.col("l_discount") * 200).alias("x1"), (y0 + F.col("l_tax") * 300).alias("y1"))


@query(
    BOX_SQL
    + """, o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, x0, y0, x1, y1) AS r FROM b)
, k AS (SELECT o.* FROM o)
, w AS (WITH RECURSIVE f AS (
    SELECT l_orderkey, 1::BIGINT AS r, true AS taken, [{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}] AS kept FROM k WHERE r = 1
    UNION ALL SELECT s.l_orderkey, s.r, s.ok, CASE WHEN s.ok THEN list_append(s.kept, s.me) ELSE s.kept END FROM (
      SELECT k.l_orderkey, k.r, f.kept, {'x0': k.x0, 'y0': k.y0, 'x1': k.x1, 'y1': k.y1} AS me,
        len(list_filter(f.kept, lambda c: abs(c.x0 - k.x0) <= 6 AND abs(c.y0 - k.y0) <= 6 AND abs(c.x1 - k.x1) <= 6 AND abs(c.y1 - k.y1) <= 6)) = 0 AS ok
      FROM f JOIN k ON k.l_orderkey = f.l_orderkey AND k.r = f.r + 1) s) SELECT * FROM f)
SELECT k.l_orderkey, k.l_linenumber, k.l_partkey, k.x0, k.y0, k.x1, k.y1 FROM k JOIN w ON k.l_orderkey = w.l_orderkey AND k.r = w.r WHERE taken"""
)
def near_dup_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of a page without near repeats, first one kept: lines of an order as figures."""
    b = _boxes(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "x0", "y0", "x1", "y1")
    return spatial.distinct_boxes(b, ["l_orderkey"], ["l_linenumber", "l_partkey"])


@query("""
WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey, [l_tax * 5000, l_discount * 4000, l_tax * 5000 + l_quantity * 9.5 - 20, l_discount * 4000 + l_quantity * 12.5 - 60] AS v FROM lineitem),
p AS (SELECT l_orderkey, l_linenumber, l_partkey, greatest(0.0, least(842.0, trunc(v[1]) / 1000 * 842.0)) AS y0, greatest(0.0, least(595.0, trunc(v[2]) / 1000 * 595.0)) AS x0,
  greatest(0.0, least(842.0, trunc(v[3]) / 1000 * 842.0)) AS y1, greatest(0.0, least(595.0, trunc(v[4]) / 1000 * 595.0)) AS x1 FROM n)
SELECT l_orderkey, l_linenumber, l_partkey, x0, y0, x1, y1, 842.0::DOUBLE - y1 AS flipped_y0, 842.0::DOUBLE - y0 AS flipped_y1 FROM p WHERE x1 - x0 >= 4 AND y1 - y0 >= 4""")
def layout_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of 0 to 1000 in points of a page, those too small left out, and the same turned over: boxes from numbers of lines."""
    ymin, xmin = F.col("l_tax") * 5000, F.col("l_discount") * 4000
    found = boxes.norm_to_layout(F.array(ymin, xmin, ymin + F.col("l_quantity") * 9.5 - 20, xmin + F.col("l_quantity") * 12.5 - 60), F.lit(595.0), F.lit(842.0))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", found.alias("b")).where(F.col("b").isNotNull())
    turned = boxes.from_bottom_left(F.col("b.x0"), F.col("b.y0"), F.col("b.x1"), F.col("b.y1"), F.lit(842.0))
    return rows.withColumn("t", turned).select("l_orderkey", "l_linenumber", "l_partkey", "b.*", F.col("t.y0").alias("flipped_y0"), F.col("t.y1").alias("flipped_y1"))


@query("""
WITH s AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS y0 FROM events WHERE event_type = 'purchase'), w AS (SELECT *, lead(y0) OVER (PARTITION BY user_id ORDER BY y0, event_id) AS nxt FROM s)
SELECT user_id, event_id AS number, y0, coalesce(nxt, 10000.0) AS y_end, 1 AS page_end FROM w""")
def slice_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the band of each question ends: a user's purchases as starts, seconds as points."""
    starts = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase").select("user_id", F.col("event_id").alias("number"), F.lit(1).alias("page"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("y0"))
    return spatial.bands(starts, "user_id").select("user_id", "number", "y0", "y_end", "page_end")


@query(
    BOX_SQL
    + f""", r AS (SELECT * FROM b WHERE l_returnflag = 'R'), t AS (SELECT * FROM b WHERE l_returnflag <> 'R')
SELECT a.l_orderkey, a.l_partkey AS region, b.l_partkey AS item, a.l_linenumber AS region_line, b.l_linenumber AS item_line FROM r a JOIN t b ON a.l_orderkey = b.l_orderkey
WHERE NOT (a.x1 + 12 < b.x0 OR b.x1 + 12 < a.x0 OR a.y1 + 12 < b.y0 OR b.y1 + 12 < a.y0) AND {SHARED} / greatest({AREA.format("b")}, 1.0) >= 0.35"""
)
def region_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that lie in a question's region: returned lines of an order as regions, the others as tables."""
    b = _boxes(spark, sf_dir)
    returned = F.col("l_returnflag") == "R"
    found = spatial.tables_in_regions(b.where(returned), b.where(~returned), ["l_orderkey"])
    return found.select("l_orderkey", F.col("l_partkey").alias("region"), F.col("r_l_partkey").alias("item"), F.col("l_linenumber").alias("region_line"), F.col("r_l_linenumber").alias("item_line"))


@query(
    BOX_SQL.replace("l_discount * 200", "l_discount * 2000").replace("l_tax * 300", "l_tax * 6000")
    + f""", r AS (SELECT * FROM b WHERE l_returnflag = 'R'), t AS (SELECT b.* FROM b JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R' AND {AREA.format("b")} >= 2500 AND {AREA.format("b")} <= greatest(500.0 * (o_custkey % 5 + 1) * 60, 1.0) * 0.45)
SELECT a.l_orderkey, a.l_partkey AS region, b.l_partkey AS item, a.l_linenumber AS region_line, b.l_linenumber AS item_line FROM r a JOIN t b ON a.l_orderkey = b.l_orderkey
WHERE (b.x0 + b.x1) / 2 BETWEEN a.x0 - 12 AND a.x1 + 12 AND (b.y0 + b.y1) / 2 BETWEEN a.y0 - 12 AND a.y1 + 12"""
)
def region_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures whose middle lies in a question's region, neither tiny nor most of the page: lines of an order as boxes, orders as pages."""
    lines = table(spark, sf_dir, "lineitem")
    y0 = F.col("l_linenumber") * F.lit(10.0)
    b = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.col("l_quantity").alias("x0"), y0.alias("y0"), (F.col("l_quantity") + F.col("l_discount") * 2000).alias("x1"), (y0 + F.col("l_tax") * 6000).alias("y1"))
    sizes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.lit(500.0) * (F.col("o_custkey") % 5 + 1)).alias("width"), F.lit(60.0).alias("height"))
    returned = F.col("l_returnflag") == "R"
    found = spatial.images_in_regions(b.where(returned), b.where(~returned), sizes, ["l_orderkey"])
    return found.select("l_orderkey", F.col("l_partkey").alias("region"), F.col("r_l_partkey").alias("item"), F.col("l_linenumber").alias("region_line"), F.col("r_l_linenumber").alias("item_line"))


@query(
    BOX_SQL
    + """, u AS (SELECT l_orderkey AS paper_id, l_returnflag AS question, l_linenumber AS page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM b GROUP BY 1, 2, 3),
s AS (SELECT paper_id, question, page, greatest(0.0, least(36.0, x0 - 8)) AS x0, greatest(0.0, y0 - 6) AS y0, least(100.0, greatest(64.0, x1 + 8)) AS x1, least(90.0, y1 + 16) AS y1 FROM u)
SELECT paper_id, question, CAST(page AS INT) AS page, x0, y0, x1, y1 FROM s WHERE x1 - x0 >= 8 AND y1 - y0 >= 8"""
)
def page_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strips around a question's lines on each page: orders as papers, return flags as questions, line numbers as pages."""
    lines = _boxes(spark, sf_dir).select(F.col("l_orderkey").alias("paper_id"), F.col("l_returnflag").alias("question"), F.col("l_linenumber").alias("page"), "x0", "y0", "x1", "y1")
    sizes = lines.select("paper_id", "page").distinct().withColumns({"width": F.lit(100.0), "height": F.lit(90.0)})
    return spatial.page_strips(lines, sizes, ["paper_id", "question"])


@query(
    BOX_SQL
    + f""" SELECT l_orderkey, l_linenumber, l_partkey FROM b a WHERE l_linestatus = 'F' AND NOT EXISTS (SELECT 1 FROM b WHERE b.l_orderkey = a.l_orderkey AND b.l_linestatus = 'O' AND {AREA.format("a")} > 0 AND {SHARED} / ({AREA.format("a")}) >= 0.5)
  AND NOT EXISTS (SELECT 1 FROM b WHERE b.l_orderkey = a.l_orderkey AND b.l_returnflag = 'R' AND (a.x0 + a.x1) / 2 BETWEEN b.x0 AND b.x1 AND (a.y0 + a.y1) / 2 BETWEEN b.y0 AND b.y1)"""
)
def stem_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that lie in no figure and no table: lines of an order by status and return flag as lines, figures and tables."""
    b = _boxes(spark, sf_dir)
    kept = spatial.lines_off_figures(b.where(F.col("l_linestatus") == "F"), b.where(F.col("l_linestatus") == "O"), ["l_orderkey"])
    return layout.without_table_text(kept, b.where(F.col("l_returnflag") == "R"), ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query(BOX_SQL + f" SELECT l_orderkey, l_linenumber, l_partkey FROM b JOIN orders ON l_orderkey = o_orderkey WHERE NOT {AREA.format('b')} > (o_custkey % 20 + 1) * 30.0 * 0.55")
def page_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures that aren't scans of their whole page: lines of an order as pictures, orders as pages."""
    sizes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 20 + 1).alias("width"), F.lit(30.0).alias("height"))
    return spatial.not_scans(_boxes(spark, sf_dir), sizes, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query(BOX_SQL + " SELECT l_orderkey, l_linenumber, l_partkey, x0, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, y0, x0, l_partkey) - 1 AS INT) AS line_index FROM b")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in reading order: lines of an order by page, height and place."""
    lines = _boxes(spark, sf_dir).withColumns({"paper_id": F.col("l_orderkey"), "page": F.col("l_linenumber"), "reading_order": F.lit(None).cast("int"), "block_index": F.lit(0), "pos": F.col("l_partkey")})
    return layout.reading_order(lines).select("l_orderkey", "l_linenumber", "l_partkey", "x0", "line_index")


# References and texts


@query("""
WITH r AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'a' || o_orderkey ELSE '00' || o_orderkey END AS ref FROM orders),
n AS (SELECT o_custkey, o_orderkey, upper(ref) AS raw, CASE WHEN o_orderkey % 5 = 0 THEN 'A' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS ref FROM r)
SELECT o_custkey, 'Q' || ref AS ref, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 5 = 0, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END, ref) AS INT) AS place,
  CASE WHEN o_orderkey % 5 = 0 THEN 'qa' || o_orderkey ELSE 'q' || CASE WHEN o_orderkey < 10 THEN '0' ELSE '' END || o_orderkey END || '-stem-1.png' AS file FROM n""")
def reference_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References normalized, in the order of a paper, and the names of their picture files: a customer's orders as questions, every fifth with a letter."""
    orders = table(spark, sf_dir, "orders")
    lettered = F.col("o_orderkey") % 5 == 0
    ref = tx.norm_ref(F.when(lettered, F.concat(F.lit("qa"), "o_orderkey")).otherwise(F.concat(F.lit(" Q 00"), "o_orderkey")))
    rows = orders.select("o_custkey", ref.alias("ref"))
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy(*tx.ref_order(F.col("ref"))))
    return rows.select("o_custkey", tx.printed_ref(F.col("ref")).alias("ref"), place.alias("place"), crops.asset_name(F.col("ref"), F.lit("stem"), F.lit(1)).alias("file"))


CUES = "|".join(f"(?:{p})" for p in tx.VISUAL_CUES)
CUE_SAMPLES = ("The Graph shows a fall.", "into a graph", "a set up shown here", "The structures of two acids are shown.", "energy profile diagram", "no cue at all", "graphs", "diagrams below")


@query(f"""
WITH t AS (SELECT p_partkey, CAST(p_size AS VARCHAR) || ' ' || p_name || ' ' || ([{", ".join(f"'{c}'" for c in CUE_SAMPLES)}])[p_partkey % {len(CUE_SAMPLES)} + 1] AS t FROM part)
SELECT p_partkey, regexp_matches(t, '(?i){CUES}') AS visual, CAST(regexp_extract(t, '([0-9]+)', 1) AS INT) AS number, trim(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM t""")
def stem_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a stem announces a figure, its number, and its slug: names of parts with and without cues."""
    cue = F.element_at(F.array(*[F.lit(c) for c in CUE_SAMPLES]), (F.col("p_partkey") % len(CUE_SAMPLES) + 1).cast("int"))
    text = F.concat_ws(" ", F.col("p_size").cast("string"), "p_name", cue)
    return table(spark, sf_dir, "part").select("p_partkey", tx.needs_visual(text).alias("visual"), tx.question_number(text).alias("number"), tx.slug(text).alias("slug"))


@query("""
WITH r AS (SELECT p_partkey, p_size, p_brand, p_type, CASE WHEN p_size % 2 = 0 THEN ['size', p_brand] ELSE [] END AS h FROM part),
t AS (SELECT p_partkey, ['Table ' || (p_size % 7) || ':'] || (CASE WHEN len(h) > 0 THEN ['Headers: ' || array_to_string(h, ' | ')] ELSE [] END)
  || [CASE WHEN i % 3 = 0 THEN 'Row: ' || i ELSE 'Row: ' || i || ' | ' || p_type END FOR i IN range(1, CAST(least(p_size, 20) AS INT) + 1)]
  || (CASE WHEN p_size > 20 THEN ['... (' || (p_size - 20) || ' more rows)'] ELSE [] END) AS parts FROM r)
SELECT p_partkey, array_to_string(parts, chr(10)) AS context FROM t""")
def table_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables as context for an extractor: a part as a table of as many rows as its size."""
    cells = lambda i: F.when(i % 3 == 0, F.array(i.cast("string"), F.lit(" "))).otherwise(F.array(i.cast("string"), F.col("p_type")))
    headers = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("size"), F.col("p_brand"))).otherwise(F.array().cast("array<string>"))
    rows = F.transform(F.sequence(F.lit(1), F.col("p_size")), cells)
    return table(spark, sf_dir, "part").select("p_partkey", layout.table_text(headers, rows, F.col("p_size") % 7).alias("context"))


# Sources


@query(r"""
WITH f AS (SELECT p_partkey, unnest([1, 2]) AS page FROM part WHERE p_partkey % 4 > 0),
l AS (SELECT p.p_partkey, page, unnest(CASE WHEN page = 1 THEN [p_name, p_brand] ELSE [p_type] END) AS text, unnest(CASE WHEN page = 1 THEN [0, 1] ELSE [0] END) AS pos, CASE WHEN page = 1 THEN 841.9 / 4 ELSE 841.9 / 3 END AS h FROM f JOIN part p USING (p_partkey))
SELECT CAST(p_partkey AS VARCHAR) AS paper_id, page, CAST(pos AS INT) AS pos, text, 40.0::DOUBLE + pos * h AS y0, 40.0::DOUBLE + (pos + 1) * h AS y1, CAST(NULL AS VARCHAR) AS error FROM l
UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL, 'JSONDecodeError' FROM part WHERE p_partkey % 4 = 0""")
def text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of plain text read into pages and lines, and files that can't be read as rows with their error: parts as files, every fourth for the JSON reader."""
    part = table(spark, sf_dir, "part")
    text = F.concat(F.lit("\n "), "p_name", F.lit(" \n\n"), "p_brand", F.lit("\f"), "p_type")
    files = part.select(F.col("p_partkey").cast("string").alias("paper_id"), (F.col("p_partkey") % 4 == 0).alias("json"), text.cast("binary").alias("content"))
    read = pages.extract(files.where(~F.col("json")), pages.text_reader)
    broken = pages.extract(files.where("json"), pages.with_attempts(pages.json_reader)).select("paper_id", F.lit(None).cast("int").alias("page"), F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("double").alias("y0"), F.lit(None).cast("double").alias("y1"), F.regexp_extract("error", "^([A-Za-z]+)", 1).alias("error"))
    return pages.lines(read).select("paper_id", "page", "pos", "text", "y0", "y1", F.lit(None).cast("string").alias("error")).unionByName(broken)


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS paper_id, 1 AS page, array_to_string(['h', p_brand], ',') AS headers, CAST(p_size % 4 AS INT) AS n_rows, 595.0::DOUBLE AS width, 1 AS page_count
FROM part WHERE p_size % 4 >= 2""")
def json_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that come as JSON: tables worth the name, page sizes, and the files' descriptors. Parts as files, with as many rows as their size modulo 4."""
    part = table(spark, sf_dir, "part")
    rows = F.slice(F.array_repeat(F.array(F.lit("x"), F.lit("y")), 4), F.lit(1), F.col("p_size") % 4)
    box = [F.lit(0.0).alias(n) for n in ("x0", "y0", "x1", "y1")]
    one = F.struct(*box, F.array(F.lit("h"), F.col("p_brand")).alias("headers"), rows.alias("rows"))
    page = F.struct(F.lit(1).alias("page"), F.lit(595.0).alias("width"), F.lit(842.0).alias("height"), F.array(one).alias("tables"))
    content = F.to_json(F.struct(F.array(page).alias("pages"))).cast("binary")
    read = pages.extract(part.select(F.col("p_partkey").cast("string").alias("paper_id"), content.alias("content")), pages.json_reader)
    sizes, files = pages.page_sizes(read), paper.documents(read, "question_paper").select(F.col("path").alias("paper_id"), "page_count")
    found = pages.tables(read).join(sizes, ["paper_id", "page"]).join(files, "paper_id")
    return found.select("paper_id", "page", F.array_join("headers", ",").alias("headers"), F.size("rows").alias("n_rows"), "width", "page_count")


# Issues and rows of a bank


@query("""
WITH q AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN ' ' ELSE CAST(p_partkey AS VARCHAR) END AS ref, (['text', 'math', 'table', 'mixed', 'composite_visual'])[p_size % 5 + 1] AS mode,
  CASE p_partkey % 4 WHEN 0 THEN ['A', 'B', 'C', 'D'] WHEN 1 THEN ['A', 'B', 'C'] WHEN 2 THEN ['A', 'A', 'B', 'C', 'D'] ELSE [] END AS labels,
  CASE p_partkey % 3 WHEN 0 THEN [2, 2] WHEN 1 THEN [2, 3] ELSE [0, 2] END AS widths, CASE WHEN p_partkey % 3 = 0 THEN 'o.png' WHEN p_partkey % 3 = 1 THEN '' END AS asset, p_partkey % 6 = 0 AS there, p_partkey % 7 = 0 AS blank FROM part),
i AS (SELECT p_partkey, list_filter([
  CASE WHEN trim(ref) = '' THEN 'MISSING_REF' END, CASE WHEN len(labels) = 0 THEN 'MISSING_OPTIONS' END, CASE WHEN len(list_distinct(labels)) < len(labels) THEN 'DUPLICATE_OPTION_LABELS' END,
  CASE WHEN len(labels) > 0 AND len(list_distinct(labels)) < 4 THEN 'INCOMPLETE_OPTIONS' END, CASE WHEN mode = 'table' AND list_contains(widths, 3) THEN 'TABLE_OPTION_COLUMN_MISMATCH' END,
  CASE WHEN mode = 'table' AND list_contains(widths, 0) THEN 'TABLE_OPTION_EMPTY_ROW' END, CASE WHEN mode = 'composite_visual' AND coalesce(asset, '') = '' THEN 'MISSING_COMPOSITE_ASSET' END,
  CASE WHEN coalesce(asset, '') <> '' AND NOT there THEN 'MISSING_ASSET_FILE' END, CASE WHEN blank THEN 'EMPTY_IMAGE_BLOCK' END], lambda x: x IS NOT NULL) AS codes FROM q)
SELECT p_partkey, array_to_string(codes, ',') AS codes, len(codes) = 0 AS ok FROM i""")
def canonical_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical questions checked: parts as questions whose faults follow from their numbers."""
    key = F.col("p_partkey")
    texts = lambda *xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(key % 11 == 0, " ").otherwise(key.cast("string")).alias("question_ref"),
        F.element_at(texts("text", "math", "table", "mixed", "composite_visual"), F.col("p_size") % 5 + 1).alias("mode"),
        F.when(key % 4 == 0, texts(*"ABCD")).when(key % 4 == 1, texts(*"ABC")).when(key % 4 == 2, texts(*"AABCD")).otherwise(texts()).alias("labels"),
        F.lit(2).alias("n_columns"),
        F.when(key % 3 == 0, F.array(F.lit(2), F.lit(2))).when(key % 3 == 1, F.array(F.lit(2), F.lit(3))).otherwise(F.array(F.lit(0), F.lit(2))).alias("row_widths"),
        F.when(key % 3 == 0, "o.png").when(key % 3 == 1, "").alias("asset"),
        (key % 6 == 0).alias("asset_exists"),
        F.when(key % 7 == 0, texts(" ")).otherwise(texts("x.png")).alias("image_assets"),
    )
    return validation.validate_canonical(rows).select("p_partkey", F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"), "ok")


BANK_SQL = """
WITH r AS (SELECT p_partkey, p_size, p_name, p_type, p_brand, CAST(p_partkey AS VARCHAR) AS ref, (['text', 'math', 'table', 'mixed', 'composite_visual'])[p_size % 5 + 1] AS mode, (['A', 'B', 'C', 'D'])[p_size % 4 + 1] AS answer FROM part)"""
PARTS = "abcd"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete records from parts: options of every mode, a stem of three blocks or a picture alone."""
    text, none = F.lit(None).cast("string"), F.array().cast("array<string>")
    block = lambda kind, value=text, latex=text, asset=text: F.struct(F.lit(kind).alias("type"), value.alias("value"), latex.alias("latex"), asset.alias("asset"))
    blocks_ = F.when(F.col("p_size") % 6 == 0, F.array(block("image", asset=F.lit("s.png")))).otherwise(F.array(block("text", F.col("p_name")), block("image", asset=F.lit("s.png")), block("math", latex=F.col("p_brand"))))
    item = lambda x: F.struct(F.lit(x).alias("label"), F.concat("p_type", F.lit(f" {x}")).alias("content"), F.when(F.lit(x != "D"), F.concat("p_brand", F.lit(f" {x}"))).alias("latex"))
    row = lambda x: F.struct(F.lit(x).alias("label"), F.array(F.col("p_brand"), F.lit(x)).alias("cells"))
    mode = F.element_at(F.array(*[F.lit(m) for m in ("text", "math", "table", "mixed", "composite_visual")]), F.col("p_size") % 5 + 1)
    options_ = F.struct(
        mode.alias("mode"), F.array(*[item(x) for x in "ABCD"]).alias("items"), none.alias("columns"), F.array(*[row(x) for x in "ABCD"]).alias("rows"), F.array(*[F.lit(x) for x in "ABCD"]).alias("labels"),
        F.when(F.col("p_size") % 10 == 4, F.lit("o.png")).alias("asset"),
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("Q0"), F.col("p_partkey").cast("string")).alias("question_ref"), blocks_.alias("content"), options_.alias("options"), F.col("p_size").alias("page"), F.array().cast("array<int>").alias("source_regions"),
        F.element_at(F.array(*[F.lit(x) for x in "ABCD"]), F.col("p_size") % 4 + 1).alias("answer"), F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).alias("explanation"), F.when(F.col("p_size") % 3 == 0, F.lit("mark_scheme")).alias("explanation_source"),
        F.when(F.col("p_size") % 8 == 0, "ODD").otherwise("DRAFT").alias("status"), (F.col("p_size") % 7 == 0).alias("requires_review"),
    )


@query(
    BANK_SQL
    + """ SELECT sha256('bank|' || ref) AS id, sha256('bank') AS bank_id, 'Q0' || ref AS number, CASE WHEN p_size % 6 = 0 THEN 'Question Q0' || ref ELSE p_name || ' ' || p_brand END AS stem, 1 AS marks, answer AS correct_answer,
  'mcq' AS question_type, 'unspecified' AS difficulty, 'Chemistry' AS subject, '5070' AS syllabus_code, CASE WHEN p_size % 7 = 0 THEN 'NEEDS_REVIEW' ELSE 'DRAFT' END AS status,
  '{"value":"' || answer || '"' || CASE WHEN p_size % 3 = 0 THEN ',"explanation":"' || p_brand || '","explanation_source":"mark_scheme"' ELSE '' END || '}' AS answer_source, 26 AS n_columns FROM r"""
)
def bank_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the bank's question table with all columns: parts as records."""
    rows = sinks.full_question_rows(_records(spark, sf_dir), F.lit("bank"), F.struct(F.lit(" 5070 /01").alias("paper_code")))
    return rows.select("id", "bank_id", "number", "stem", "marks", "correct_answer", "question_type", "difficulty", "subject", "syllabus_code", "status", "answer_source", F.lit(len(rows.columns)).alias("n_columns"))


@query(
    BANK_SQL
    + """, o AS (SELECT *, unnest(['A', 'B', 'C', 'D']) AS label, unnest([0, 1, 2, 3]) AS sort_order FROM r)
SELECT sha256('bank|' || ref || '|' || label) AS id, sha256('bank|' || ref) AS question_id, label, CASE mode WHEN 'text' THEN p_type || ' ' || label WHEN 'math' THEN CASE WHEN label = 'D' THEN '' ELSE p_brand || ' ' || label END
  WHEN 'table' THEN p_brand || ' | ' || label WHEN 'mixed' THEN p_type || ' ' || label ELSE '[composite visual]' END AS text, label = answer AS is_correct, sort_order FROM o"""
)
def bank_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the bank's option table for options of every mode: parts as records."""
    return sinks.full_option_rows(_records(spark, sf_dir), F.lit("bank")).drop("media")


@query(
    BANK_SQL
    + """, a AS (SELECT ref, p_size, 0 AS image_index, 's.png' AS name, 'stem' AS role FROM r UNION ALL SELECT ref, p_size, 1, 'o.png', 'options' FROM r WHERE p_size % 10 = 4 AND mode IN ('composite_visual', 'mixed'))
SELECT sha256('bank|' || ref || '|' || image_index) AS id, sha256('bank|' || ref) AS question_id, 'exam_questions/2023_6092_Q0' || ref || '/' || name AS storage_path, 'https://store.test/exam_questions/2023_6092_Q0' || ref || '/' || name AS public_url,
  p_size AS page_number, image_index, CASE WHEN name = 's.png' THEN 10 ELSE 20 END AS width, CASE WHEN name = 's.png' THEN 11 ELSE 21 END AS height, role FROM a"""
)
def bank_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the bank's media table: pictures of parts as records, where they were cut out."""
    pictures = spark.createDataFrame([("s.png", 10, 11), ("o.png", 20, 21), ("never.png", 1, 1)], "name string, width int, height int")
    key = F.concat(F.lit("2023|6092|"), "question_ref")
    rows = sinks.full_media_rows(_records(spark, sf_dir), F.lit("bank"), key, pictures, "https://store.test/")
    return rows.drop("bbox", "caption", "description", "option_label")


@query("""
SELECT p_partkey, coalesce(nullif(trim(split_part(CASE WHEN p_size % 4 = 0 THEN '/1' ELSE p_size || ' /01' END, '/', 1)), ''), '6092') || ':' || p_brand AS code,
  regexp_replace(CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_size || '/01-2023' END, '[^A-Za-z0-9_-]', '-', 'g') || '-20240229T010203Z' AS run FROM part""")
def run_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of topics and names of runs: parts as papers, with and without a title."""
    size = F.col("p_size").cast("string")
    paper_code = F.when(F.col("p_size") % 4 == 0, "/1").otherwise(F.concat(size, F.lit(" /01")))
    run = paper.run_name(F.when(F.col("p_size") % 2 == 0, F.col("p_name")), F.concat(size, F.lit("/01")), F.lit(2023), F.lit("2024-02-29 01:02:03").cast("timestamp"))
    return table(spark, sf_dir, "part").select("p_partkey", classify.code(paper_code, F.col("p_brand")).alias("code"), run.alias("run"))


@query("""
WITH k AS (SELECT o_custkey, o_orderkey, o_orderkey % 50 + 1 AS n, (['A', 'B', 'C', 'D'])[o_orderkey % 4 + 1] AS a FROM orders),
p AS (SELECT o_custkey, n, arg_min(a, o_orderkey) AS answer FROM k WHERE n <= 40 GROUP BY 1, 2)
SELECT CAST(o_custkey AS VARCHAR) AS paper_id, CAST(n AS INT) AS number, answer FROM p""")
def customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of number and answer in key pages, first one wins, numbers above 40 dropped: a customer's orders as the text of a key."""
    letter = F.element_at(F.array(*[F.lit(x) for x in "ABCD"]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    pair = F.concat_ws(" ", (F.col("o_orderkey") % 50 + 1).cast("string"), F.lower(letter))
    texts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", pair.alias("p")))), lambda s: s["p"]), "; ").alias("pairs"))
    keys = texts.select(F.col("o_custkey").cast("string").alias("paper_id"), F.lit(1).alias("page"), F.concat(F.lit("Answers\n"), "pairs").alias("text"))
    return options.key_entries(keys, expected=40).select("paper_id", "number", "answer")
