"""Registered queries of the engine proper and their DuckDB counterparts.

The shared tables hold no exam papers, so most queries apply an operator to
columns with the same shape: an order is a paper, its line numbers are question
numbers, a user's events are lines in order. Each docstring says which.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from examloom.functions import boxes
from examloom.functions import text as tx
from examloom.operators import chemistry, classify, layout, matching, options, segment, sinks, spatial, validation
from examloom.plans.registration import ORACLE_SQL, QUERIES, query, table

__all__ = ["ORACLE_SQL", "QUERIES"]

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and texts of documents. A scan of fewer tasks than cores is dealt out first: its one file would keep one core busy."""
    docs, cores = table(spark, sf_dir, "documents").select("doc_id", "text"), spark.sparkContext.defaultParallelism
    return docs if docs.rdd.getNumPartitions() >= cores else docs.repartition(cores)


# Validation and matching


@query("""
WITH c AS (SELECT l_orderkey AS k, l_linenumber AS n, count(*) AS c FROM lineitem GROUP BY 1, 2),
f AS (SELECT k, sum(c) AS d, list(n) AS seen, string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) FILTER (c > 1) AS dup FROM c GROUP BY 1)
SELECT o_orderkey, CAST(coalesce(d, 0) AS BIGINT) AS detected,
  coalesce((SELECT string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FROM range(1, 8) t(i) WHERE NOT list_contains(coalesce(seen, []), i)), '') AS missing,
  coalesce(dup, '') AS duplicate, coalesce(d, 0) <> 7 AS count_mismatch,
  CASE WHEN coalesce(d, 0) <> 7 OR dup IS NOT NULL OR len(coalesce(seen, [])) < 7 THEN 'review' ELSE 'pass' END AS status
FROM orders LEFT JOIN f ON o_orderkey = k""")
def paper_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing, repeated and surplus question numbers per paper: orders as papers, line numbers 1 to 7 as questions."""
    papers = table(spark, sf_dir, "orders").select("o_orderkey")
    found = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    rows = validation.paper_totals(papers, found, "o_orderkey", "l_linenumber", expected=7)
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return rows.withColumns({"missing": joined("missing"), "duplicate": joined("duplicate")})


@query("""
WITH c AS (SELECT l_orderkey AS k, CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_returnflag = 'A' AND l_quantity < 10 THEN 'needs_review'
  WHEN l_linestatus = 'F' THEN 'passed' ELSE 'not_evaluated' END AS s FROM lineitem)
SELECT k AS l_orderkey, count(*) AS n_checks, CASE WHEN bool_or(s = 'failed') THEN 'failed' WHEN bool_or(s = 'needs_review') THEN 'needs_review'
  WHEN bool_and(s = 'not_evaluated') THEN 'not_evaluated' ELSE 'passed' END AS status FROM c GROUP BY 1""")
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of checks rolled up: lines of an order as checks."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    status = (
        F.when(F.col("l_returnflag") == "R", "failed")
        .when((F.col("l_returnflag") == "A") & (F.col("l_quantity") < 10), "needs_review")
        .when(F.col("l_linestatus") == "F", "passed")
        .otherwise("not_evaluated")
    )
    return lines.groupBy("l_orderkey").agg(F.count("*").alias("n_checks"), validation.rolled_up(status).alias("status"))


NORM_SQL = r"""coalesce(nullif(regexp_replace(regexp_replace(coalesce(nullif(regexp_replace(regexp_replace(upper(trim({0})), '^Q\s*', ''), '^0+', ''), ''), '0'), '^\s+', ''), '^0+', ''), ''), '0')"""


@query(f"""
WITH q AS (SELECT {NORM_SQL.format("'Q' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0')")} AS ref, count(*) AS n FROM orders GROUP BY 1),
a AS (SELECT {NORM_SQL.format("' q' || CAST(l_orderkey + l_linenumber - 1 AS VARCHAR) || ' '")} AS ref, count(*) AS n FROM lineitem GROUP BY 1)
SELECT 'Q' || coalesce(q.ref, a.ref) AS ref, CASE WHEN a.ref IS NULL THEN 'unmatched' WHEN q.ref IS NULL THEN 'unused' ELSE 'matched' END AS state,
  coalesce(q.n, 0) AS n_questions, coalesce(a.n, 0) AS n_answers FROM q FULL OUTER JOIN a ON q.ref = a.ref""")
def match_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set match on normalized references: zero-padded order keys against line keys written in another way."""
    q = table(spark, sf_dir, "orders").select(F.concat(F.lit("Q"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("question_ref"))
    key = (F.col("l_orderkey") + F.col("l_linenumber") - 1).cast("string")
    a = table(spark, sf_dir, "lineitem").select(F.concat(F.lit(" q"), key, F.lit(" ")).alias("question_ref"))
    return matching.match_report(q, a).withColumn("ref", tx.printed_ref(F.col("ref")))


@query("""
WITH a AS (SELECT l_orderkey AS k, chr(65 + l_linenumber % 4) AS answer, CASE l_returnflag WHEN 'R' THEN NULL WHEN 'A' THEN '' ELSE l_linestatus || l_linenumber END AS explanation,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC, l_returnflag DESC, l_linestatus DESC) AS r FROM lineitem)
SELECT 'Q' || o_orderkey AS question_ref, answer, explanation, CASE WHEN explanation <> '' THEN 'mark_scheme' END AS explanation_source,
  CASE WHEN o_orderstatus = 'P' OR k IS NULL THEN 'NEEDS_REVIEW' ELSE 'DRAFT' END AS status, o_orderstatus = 'P' OR k IS NULL AS requires_review
FROM orders LEFT JOIN a ON o_orderkey = k AND r = 1""")
def join_complete_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions joined with the last of their answers: orders as questions, lines as answers in order of line number and date."""
    q = table(spark, sf_dir, "orders").select(F.concat(F.lit("Q"), F.col("o_orderkey").cast("string")).alias("question_ref"), (F.col("o_orderstatus") == "P").alias("requires_review"))
    number = F.col("l_linenumber")
    note = F.when(F.col("l_returnflag") == "R", None).when(F.col("l_returnflag") == "A", "").otherwise(F.concat("l_linestatus", number.cast("string")))
    a = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("Q00"), F.col("l_orderkey").cast("string")).alias("question_ref"),
        F.char(F.lit(65) + number % 4).alias("answer"),
        note.alias("explanation"),
        F.struct("l_linenumber", "l_shipdate", "l_partkey", "l_returnflag", "l_linestatus").alias("position"),
    )
    return matching.join_records(q, a, F.col("position"))


@query("""
WITH c AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' AND conv_id % 3 = 0 THEN NULL WHEN role = 'user' THEN '' ELSE text END AS e FROM conversations),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r, row_number() OVER (PARTITION BY conv_id, coalesce(e, '') <> '' ORDER BY turn) AS g FROM c)
SELECT a.conv_id, CASE WHEN a.e IS NOT NULL OR b.conv_id IS NULL THEN a.role ELSE b.role END AS answer,
  CASE WHEN a.e IS NOT NULL OR b.conv_id IS NULL THEN a.e ELSE b.e END AS explanation
FROM f a LEFT JOIN f b ON a.conv_id = b.conv_id AND b.g = 1 AND coalesce(b.e, '') <> '' WHERE a.r = 1""")
def answer_page_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer a reference keeps from several pages: turns as pages; users' turns have no explanation, null or empty by conversation."""
    user = F.col("role") == "user"
    note = F.when(user & (F.col("conv_id") % 3 == 0), None).when(user, "").otherwise(F.col("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("answer"), note.alias("explanation"))
    return matching.merge_answer_pages(rows, ["conv_id"], F.col("turn"))


@query("""
SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS content, bool_or(role = 'system') AS requires_review,
  arg_min(role, turn) AS options, min(turn) AS source_page FROM conversations GROUP BY 1""")
def continuation_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a question on several pages as one: turns of a conversation as parts."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("content"), (F.col("role") == "system").alias("requires_review"), F.col("role").alias("options"))
    merged = matching.merge_continued(rows, ["conv_id"], "turn")
    return merged.select("conv_id", F.array_join("contents", "\n").alias("content"), "requires_review", "options", "source_page")


# Lines and segments


@query("""
WITH c AS (SELECT conv_id, turn, role, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations)
SELECT conv_id, turn, role, CASE WHEN role <> 'user' THEN p END AS parent FROM c""")
def nest_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-parts under the part before them: answers under the user's turn."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return segment.nest(rows, ["conv_id"], "turn", F.col("role") == "user")


LINES_SQL = r"""
WITH s AS (SELECT doc_id, list_filter([regexp_replace(x, '^\s+|\s+$', '', 'g') FOR x IN string_split(text, chr(10))], lambda x: x <> '') AS ls FROM documents),
l AS (SELECT doc_id, 841.9 / (len(ls) + 2) AS row, unnest(ls) AS text, unnest(range(len(ls))) AS i FROM s),
lines AS (SELECT doc_id, CAST(i AS INT) AS block_index, text, 72.0::DOUBLE AS x0, 40.0::DOUBLE + i * row AS y0, 595.3::DOUBLE - 40 AS x1, 40.0::DOUBLE + i * row + row AS y1 FROM l)"""


@query(LINES_SQL + " SELECT * FROM lines")
def plain_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of plain text with made-up geometry: documents as pages."""
    return layout.plain_text_lines(documents(spark, sf_dir), "doc_id", "text")


KEPT_SQL = "y0 >= 50 AND y0 <= 841.9 - 50 AND NOT regexp_matches(text, '" + tx.FURNITURE.replace("'", "''") + "')"


@query(LINES_SQL + f" SELECT doc_id, count(*) AS n_lines, CAST(coalesce(sum(CASE WHEN {KEPT_SQL} THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_kept FROM lines GROUP BY 1")
def furniture_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines outside headers, footers and page furniture, counted per page: documents as pages."""
    lines = layout.plain_text_lines(documents(spark, sf_dir), "doc_id", "text")
    furniture = tx.is_furniture(F.col("text"), F.col("y0"), F.lit(layout.A4_HEIGHT))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(~furniture).alias("n_kept"))


@query(LINES_SQL + """, j AS (SELECT doc_id, string_agg(text, chr(10) ORDER BY block_index) AS t FROM lines GROUP BY 1)
SELECT doc_id, CASE WHEN length(t) > 3000 THEN substr(t, 1, 2997) || '...' ELSE t END AS context FROM j""")
def page_text_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of a page as context for an extractor, cut to 3000 characters: documents as pages."""
    return documents(spark, sf_dir).where(layout.text_lines(F.col("text")) != F.array().cast("array<string>")).select("doc_id", layout.text_context(F.col("text")).alias("context"))


@query(r"""
WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^ | $', '', 'g') AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) > 100 THEN substr(t, 1, 97) || '...' ELSE t END AS preview FROM c""")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts collapsed and cut to 100 characters."""
    return documents(spark, sf_dir).select("doc_id", tx.preview(F.col("text")).alias("preview"))


@query(r"""
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' of ' || p_type || ' ' || p_name || ' of ' || p_type || ' and more' ELSE p_name || ' ' || p_name END AS t FROM part),
w AS (SELECT p_partkey, t, string_split(regexp_replace(regexp_replace(t, '\s+', ' ', 'g'), '^ | $', '', 'g'), ' ') AS ws FROM p),
k AS (SELECT *, list_max([i FOR i IN range(3, CAST(len(ws) // 2 AS INT) + 1) IF ws[1:i] = ws[i + 1:2 * i]]) AS k FROM w)
SELECT p_partkey, CASE WHEN k IS NULL THEN t ELSE array_to_string(ws[1:k], ' ') END AS text FROM k""")
def collapse_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that say the same twice, once: part names repeated by rule."""
    name, kind = F.col("p_name"), F.col("p_type")
    twice = F.concat_ws(" of ", name, kind)
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat(twice, F.lit(" "), twice, F.lit(" and more"))).otherwise(F.concat(name, F.lit(" "), name))
    return table(spark, sf_dir, "part").select("p_partkey", tx.collapse_repeat(text).alias("text"))


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.get_json_object("props", "$.k").cast("int").alias("number"))


@query("""
WITH RECURSIVE e AS (SELECT user_id, event_id, CAST(json_extract_string(props, '$.k') AS INT) AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
f AS (SELECT user_id, 0 AS r, 1 AS nxt, 0 AS taken, NULL::BIGINT AS event_id, false AS ok FROM (SELECT DISTINCT user_id FROM e)
  UNION ALL SELECT user_id, r, CASE WHEN ok THEN n + 1 ELSE nxt END, CASE WHEN ok THEN taken + 1 ELSE taken END, event_id, ok FROM (
    SELECT e.user_id, e.r, e.n, e.event_id, f.nxt, f.taken, coalesce(e.n <= 40 AND (e.n = f.nxt OR (e.n > f.nxt AND e.n <= f.nxt + 2 AND f.taken > 0)), false) AS ok
    FROM f JOIN e ON e.user_id = f.user_id AND e.r = f.r + 1))
SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY r) AS starts FROM f WHERE ok GROUP BY 1""")
def greedy_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question starts that a scan accepts: numbers in a user's events as candidates, 40 expected."""
    taken = segment.greedy_starts(_numbered(spark, sf_dir), "user_id", ["ts", "event_id"], expected=40)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id"))), lambda s: s["event_id"].cast("string"))
    return taken.groupBy("user_id").agg(F.array_join(ordered, ",").alias("starts"))


@query("""
WITH e AS (SELECT user_id, event_id, CAST(json_extract_string(props, '$.k') AS INT) AS n, ts FROM events),
m AS (SELECT *, max(n) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS most FROM e)
SELECT user_id, event_id, n AS number FROM m WHERE most IS NULL OR n > most""")
def strict_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured question starts, each above all before it: numbers in a user's events."""
    return segment.increasing_starts(_numbered(spark, sf_dir), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "number")


OPTION_EVENTS = {"view": "A", "click": "B", "signup": "C", "purchase": "D"}


@query("""
WITH m AS (SELECT user_id, epoch_us(ts) / 1e6 AS y0, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 END AS l,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events WHERE event_type IN ('view', 'click', 'signup', 'purchase')),
b AS (SELECT *, CASE WHEN l = 1 + lag(l) OVER w THEN 0 ELSE 1 END AS begins FROM m WINDOW w AS (PARTITION BY user_id ORDER BY pos)),
i AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY pos) AS island FROM b),
r AS (SELECT user_id, island, count(*) AS n, min(pos) AS pos, arg_min(l, pos) AS first, arg_min(y0, pos) AS y0 FROM i GROUP BY 1, 2),
x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, y0 DESC, pos DESC) AS k FROM r WHERE first = 1 AND n > 1)
SELECT user_id, CAST(pos AS INT) AS pos, n AS run_length FROM x WHERE k = 1""")
def option_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best run of options A, B, C, D: kinds of a user's events as labels, their times as heights."""
    kinds = F.create_map(*[F.lit(x) for pair in OPTION_EVENTS.items() for x in pair])
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin(*OPTION_EVENTS))
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    markers = events.select("user_id", F.element_at(kinds, F.col("event_type")).alias("label"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("y0"), F.row_number().over(by).alias("pos"))
    return options.best_runs(markers, ["user_id"]).select("user_id", F.col("run_start").alias("pos"), "run_length")


@query(r"""
WITH k(page, t) AS (VALUES (1, 'CHEMISTRY 6092/01 Answers' || chr(10) || '1 B 2 A 3 C 4 D 5 D 6 D' || chr(10) || '7 A 8 B'), (2, '9 A 10 C 3 D 41 B 12 b'), (3, 'Checklist'), (4, '11 A')),
p AS (SELECT page, unnest(regexp_extract_all(t, '(?i)(?:^|[^\d])(\d{1,2})\s*[.):\-]?\s*([ABCD])\b', 1)) AS n, unnest(regexp_extract_all(t, '(?i)(?:^|[^\d])(\d{1,2})\s*[.):\-]?\s*([ABCD])\b', 2)) AS a,
  unnest(range(len(regexp_extract_all(t, '(?i)(?:^|[^\d])(\d{1,2})\s*[.):\-]?\s*([ABCD])\b', 1)))) AS i FROM k WHERE page < 3),
f AS (SELECT CAST(n AS INT) AS number, upper(a) AS answer, page, row_number() OVER (PARTITION BY CAST(n AS INT) ORDER BY page, i) AS r FROM p WHERE CAST(n AS INT) BETWEEN 1 AND 40)
SELECT number, answer, page FROM f WHERE r = 1""")
def key_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer-key pairs of consecutive key pages, first one wins: four inline pages, of which the third ends the key."""
    pages = spark.createDataFrame([("k", 1, "CHEMISTRY 6092/01 Answers\n1 B 2 A 3 C 4 D 5 D 6 D\n7 A 8 B"), ("k", 2, "9 A 10 C 3 D 41 B 12 b"), ("k", 3, "Checklist"), ("k", 4, "11 A")], "paper_id string, page int, text string")
    return options.key_entries(pages, expected=40).select("number", "answer", "page")


# Boxes and bands


@query("""
WITH s AS (SELECT user_id, event_id AS number, epoch_us(ts) / 1e6 AS y0, lead(epoch_us(ts) / 1e6) OVER w AS y1, row_number() OVER w AS r
  FROM events WHERE event_type = 'purchase' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS y FROM events WHERE event_type <> 'purchase'),
j AS (SELECT i.user_id, i.event_id, s.number, row_number() OVER (PARTITION BY i.event_id ORDER BY s.r) AS k
  FROM i JOIN s ON i.user_id = s.user_id AND i.y >= s.y0 - 4 AND (s.y1 IS NULL OR i.y < s.y1 - 1))
SELECT i.user_id, i.event_id, j.number AS owner FROM i LEFT JOIN j ON i.event_id = j.event_id AND k = 1""")
def band_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures to the question whose band they lie in: a user's purchases as starts, other events as figures, seconds as points."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("y"), F.lit(1).alias("page"))
    starts = events.where(F.col("event_type") == "purchase").select("user_id", F.col("event_id").alias("number"), "page", F.col("y").alias("y0"))
    figures = events.where(F.col("event_type") != "purchase").select("user_id", "event_id", "page", "y")
    return spatial.owners(starts, figures, "user_id").select("user_id", "event_id", "owner")


BOX_SQL = """
WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity AS x0, l_linenumber * 10.0::DOUBLE AS y0,
  l_quantity + l_discount * 200 AS x1, l_linenumber * 10.0::DOUBLE + l_tax * 300 AS y1 FROM lineitem)"""
SHARED_SQL = "greatest(0.0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0.0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box per line of an order, from its numbers."""
    lines = table(spark, sf_dir, "lineitem")
    y0 = F.col("l_linenumber") * F.lit(10.0)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.col("l_quantity").alias("x0"), y0.alias("y0"), (F.col("l_quantity") + F.col("l_discount") * 200).alias("x1"), (y0 + F.col("l_tax") * 300).alias("y1"))


@query(BOX_SQL + f""" SELECT a.l_orderkey, a.l_partkey AS a, b.l_partkey AS b, {SHARED_SQL} AS shared FROM b a JOIN b b ON a.l_orderkey = b.l_orderkey
  AND a.l_linenumber < b.l_linenumber AND NOT (a.x1 < b.x0 OR b.x1 < a.x0 OR a.y1 < b.y0 OR b.y1 < a.y0)""")
def box_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of a page that overlap, and the area they share: lines of an order as boxes of a page."""
    b = _boxes(spark, sf_dir)
    found = spatial.pairs(b, b, ["l_orderkey"], lambda x, y: (F.col("l_linenumber") < F.col("r_l_linenumber")) & x.overlaps(y))
    return found.select("l_orderkey", F.col("l_partkey").alias("a"), F.col("r_l_partkey").alias("b"), boxes.Box.named("").shared_area(boxes.Box.named("r_")).alias("shared"))


@query(BOX_SQL + f""" SELECT l_orderkey, l_linenumber, l_partkey FROM b a WHERE l_returnflag <> 'R' AND NOT EXISTS (
  SELECT 1 FROM b WHERE b.l_orderkey = a.l_orderkey AND b.l_returnflag = 'R' AND (
    (greatest(0.0, a.x1 - a.x0) * greatest(0.0, a.y1 - a.y0) > 0 AND {SHARED_SQL} / (greatest(0.0, a.x1 - a.x0) * greatest(0.0, a.y1 - a.y0)) >= 0.3)
    OR (greatest(0.0, b.x1 - b.x0) * greatest(0.0, b.y1 - b.y0) > 0 AND {SHARED_SQL} / (greatest(0.0, b.x1 - b.x0) * greatest(0.0, b.y1 - b.y0)) >= 0.3)))""")
def spatial_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that don't lie over figures: returned lines of an order as figures, the others as tables."""
    b = _boxes(spark, sf_dir)
    figure = F.col("l_returnflag") == "R"
    return spatial.tables_off_figures(b.where(~figure), b.where(figure), ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, 1000 AS w, 2000 AS h, l_tax * 5000 AS ymin, l_discount * 4000 AS xmin, l_tax * 5000 + l_quantity * 9.5 AS ymax, l_discount * 4000 + l_quantity * 12.5 AS xmax FROM lineitem),
r AS (SELECT *, greatest(0, least(CAST(round_even(xmin / 1000.0 * w, 0) AS BIGINT) - 2, w - 1)) AS l, greatest(0, least(CAST(round_even(ymin / 1000.0 * h, 0) AS BIGINT) - 2, h - 1)) AS u FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l AS BIGINT) AS "left", CAST(u AS BIGINT) AS upper,
  CAST(greatest(l + 1, least(CAST(round_even(xmax / 1000.0 * w, 0) AS BIGINT) + 2, w)) AS BIGINT) AS "right",
  CAST(greatest(u + 1, least(CAST(round_even(ymax / 1000.0 * h, 0) AS BIGINT) + 2, h)) AS BIGINT) AS lower FROM r""")
def norm_bbox_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of 0 to 1000 in pixels of an image of 1000 by 2000: boxes from numbers of lines."""
    ymin, xmin = F.col("l_tax") * 5000, F.col("l_discount") * 4000
    box = boxes.norm_to_pixels(ymin, xmin, ymin + F.col("l_quantity") * 9.5, xmin + F.col("l_quantity") * 12.5, F.lit(1000), F.lit(2000))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", box.alias("b")).select("l_orderkey", "l_linenumber", "l_partkey", "b.*")


# Topics


LEAVES = [
    (1, "the tion", "section one", "ing and", "the and ofthe ofing thation isotope"),
    (2, "la de que", "section two", "los ción", "ación mente de la que los electrolysis"),
    (3, "der die und", None, None, None),
    (4, "le ment eau", "le ment eau", "que ch", "aux elle ment tion re redox"),
]
WEIGHT_SQL = "(CASE " + " ".join(f"WHEN token = '{k}' THEN {v}::DOUBLE" for k, v in classify.BOOST.items()) + " ELSE 1.0::DOUBLE END)"
STOP_SQL = ", ".join(f"'{w}'" for w in classify.STOP_WORDS)


def _sql_text(x: str | None) -> str:
    return "NULL" if x is None else f"'{x}'"


@query(f"""
WITH leaves(leaf, a, section, b, outcomes) AS (VALUES {", ".join(f"({r[0]}, {', '.join(map(_sql_text, r[1:]))})" for r in LEAVES)}),
blobs AS (SELECT leaf, a, b, unnest([a, section, b, outcomes]) AS blob FROM leaves),
w AS (SELECT leaf, token, sum({WEIGHT_SQL} * t) AS weight FROM (SELECT leaf, CASE WHEN blob = a OR coalesce(blob = b, false) THEN 1.4::DOUBLE ELSE 1.0::DOUBLE END AS t, unnest(regexp_extract_all(lower(blob), '[a-z0-9]+')) AS token FROM blobs WHERE blob IS NOT NULL)
  WHERE length(token) > 1 AND token NOT IN ({STOP_SQL}) GROUP BY 1, 2),
q AS (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM documents) WHERE length(token) > 1 AND token NOT IN ({STOP_SQL}) GROUP BY 1, 2),
n AS (SELECT doc_id, sum(n) AS n FROM q GROUP BY 1),
s AS (SELECT doc_id, leaf, sum(sqrt(n) * weight * {WEIGHT_SQL}) AS score FROM q JOIN w USING (token) GROUP BY 1, 2),
m AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 6) DESC, leaf) AS r FROM s),
c AS (SELECT d.doc_id, m.leaf, coalesce(m.score, 0.0::DOUBLE) AS score, coalesce(n.n, 0) AS n FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id AND r = 1 LEFT JOIN n ON d.doc_id = n.doc_id)
SELECT doc_id, leaf, round(score, 4) AS score, round(least(0.99::DOUBLE, score / (score + greatest(8.0::DOUBLE, sqrt(n) * 3.0))), 4) AS confidence,
  CASE WHEN leaf IS NOT NULL AND least(0.99, score / (score + greatest(8.0::DOUBLE, sqrt(n) * 3.0))) >= 0.12 THEN 'ok' ELSE 'needs_review' END AS status FROM c""")
def classify_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics by keyword overlap: documents as questions, a small inline taxonomy of frequent syllables."""
    leaves = spark.createDataFrame(LEAVES, "leaf int, topic_title string, section string, title string, outcomes string")
    rows = classify.classify(documents(spark, sf_dir), leaves, "doc_id", "text")
    return rows.withColumns({"score": F.round("score", 4), "confidence": F.round("confidence", 4)})


@query("""
WITH s AS (SELECT n_nationkey AS number, n_name AS title, CASE WHEN n_regionkey % 2 = 0 THEN 'region ' || n_regionkey ELSE '' END AS section, NULL::VARCHAR[] AS subtopics FROM nation),
d AS (SELECT s_nationkey * 2 AS number, max(s_name) AS title, 'detail' AS section, list(s_name ORDER BY s_name) FILTER (s_suppkey % 2 = 0) AS subtopics FROM supplier GROUP BY 1)
SELECT coalesce(s.number, d.number) AS number, CASE WHEN coalesce(d.title, '') <> '' AND length(d.title) > coalesce(length(s.title), 0) THEN d.title ELSE coalesce(s.title, d.title) END AS title,
  CASE WHEN coalesce(s.section, '') <> '' THEN s.section ELSE coalesce(d.section, s.section) END AS section, coalesce(array_to_string(d.subtopics, ','), '') AS subtopics
FROM s FULL OUTER JOIN d ON s.number = d.number""")
def syllabus_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two readings of a syllabus merged column by column: nations as one reading, suppliers by nation as the other."""
    section = F.when(F.col("n_regionkey") % 2 == 0, F.concat(F.lit("region "), F.col("n_regionkey").cast("string"))).otherwise("")
    s = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("number"), F.col("n_name").alias("title"), section.alias("section"), F.lit(None).cast("array<string>").alias("subtopics"))
    listed = F.array_sort(F.collect_list(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name"))))
    d = table(spark, sf_dir, "supplier").groupBy((F.col("s_nationkey") * 2).alias("number")).agg(F.max("s_name").alias("title"), F.lit("detail").alias("section"), listed.alias("subtopics"))
    merged = classify.merge_readings(s, d)
    return merged.withColumn("subtopics", F.coalesce(F.array_join("subtopics", ","), F.lit("")))


# Notation and sinks


NOTATION_SQL = """
WITH n AS (SELECT p_partkey, p_size, CAST(p_partkey % 12 + 1 AS VARCHAR) AS a, CAST(p_partkey % 30 + 1 AS VARCHAR) AS b, CAST(p_partkey % 3 + 1 AS VARCHAR) AS c FROM part),
s AS (SELECT *, translate(a, '0123456789', '₀₁₂₃₄₅₆₇₈₉') AS la, translate(b, '0123456789', '₀₁₂₃₄₅₆₇₈₉') AS lb, translate(c, '0123456789', '⁰¹²³⁴⁵⁶⁷⁸⁹') AS hc FROM n)"""


def _notation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with notation in them, from the numbers of parts.

    Numbers are always dealt out: a few bytes become a text with much work, and
    millions of them lie in one row group, which is one task's however many the
    scan has.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    part = part.repartition(max(part.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism))
    a, b, c = ((F.col("p_partkey") % n + 1).cast("string") for n in (12, 30, 3))
    size = F.col("p_size").cast("string")
    plain = F.concat(F.lit("Take "), size, F.lit(" cm 3 of C"), a, F.lit("H"), b, F.lit(" ( G ) with Fe"), c, F.lit("+ at "), size, F.lit(" atmospheres"))
    spaced = F.concat(F.lit("B "), size, F.lit(" of  N "), a, F.lit(" H "), b, F.lit(" -> V_"), c, F.lit("O^{"), c, F.lit("+}; ∆ H = - "), size, F.lit(" kJ / mol"))
    return part.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, plain).otherwise(spaced).alias("text"))


@query(
    NOTATION_SQL
    + """ SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Take ' || p_size || ' cm³ of C' || la || 'H' || lb || ' (g) with Fe' || hc || '⁺ at ' || p_size || ' atm'
  ELSE 'B ' || p_size || ' of N' || la || 'H' || lb || ' → V' || translate(c, '0123456789', '₀₁₂₃₄₅₆₇₈₉') || 'O' || translate(c, '0123456789', '₀₁₂₃₄₅₆₇₈₉') || '⁺; ΔH = -' || p_size || ' kJ/mol' END AS normalized FROM s"""
)
def chem_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chemical notation normalized: formulae, ions, units, states, arrows and enthalpies of changing numbers, one text for every part."""
    return chemistry.normalized(_notation(spark, sf_dir), "text", "normalized").drop("text")


@query(
    NOTATION_SQL
    + """, e AS (SELECT *, length('Take ' || p_size || ' ') AS u, length('Take ' || p_size || ' cm 3 of ') AS f, length('Take ' || p_size || ' cm 3 of C' || a || 'H' || b || ' ') AS g FROM s WHERE p_partkey % 2 = 0),
t AS (SELECT p_partkey, 'unit' AS kind, 'cm 3' AS raw, 'cm³' AS normalized, u AS "start" FROM e
  UNION ALL SELECT p_partkey, 'unit', 'atmospheres', 'atm', g + length('( G ) with Fe' || c || '+ at ' || p_size || ' ') FROM e
  UNION ALL SELECT p_partkey, 'state', '( G )', '(g)', g FROM e
  UNION ALL SELECT p_partkey, 'formula', 'C' || a || 'H' || b, 'C' || la || 'H' || lb, f FROM e
  UNION ALL SELECT p_partkey, 'formula', 'Fe' || c || '+', 'Fe' || hc || '⁺', g + length('( G ) with ') FROM e)
SELECT p_partkey, kind, raw, normalized, CAST("start" AS INT) AS "start", CAST("start" + length(raw) AS INT) AS "end" FROM t"""
)
def chem_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formulae, units and states with their places: in the text of every other part."""
    rows = chemistry.tokens(_notation(spark, sf_dir).where(F.col("p_partkey") % 2 == 0), "text")
    # A plain explode gets a filter on the size of its array, which makes all tokens twice more.
    return rows.select("p_partkey", F.explode_outer("tokens").alias("token")).where(F.col("token").isNotNull()).select("p_partkey", "token.*")


@query("SELECT doc_id, sha256(text) AS sha256, strlen(text) AS n_bytes FROM documents")
def file_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 and size of contents: documents as files."""
    return documents(spark, sf_dir).select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.octet_length("text").cast("long").alias("n_bytes"))


@query("""
WITH o AS (SELECT p_partkey, unnest(['A', 'B', 'C', 'D']) AS label, unnest([p_name, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END, p_type, '']) AS text, unnest([1, 2, 3, 4]) AS sort_order, p_size FROM part)
SELECT sha256('bank|' || p_partkey || '|' || label) AS option_id, sha256('bank|' || p_partkey) AS question_id, label, CASE WHEN coalesce(trim(text), '') = '' THEN '[visual option]' ELSE text END AS option_text,
  sort_order = p_size % 4 + 1 AS is_correct, sort_order FROM o""")
def option_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an option table, four for each question: parts as questions, their columns as options."""
    texts = F.array("p_name", F.when(F.col("p_size") % 5 != 0, F.col("p_brand")), "p_type", F.lit(""))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("question_ref"), texts.alias("texts"), F.element_at(F.array(*[F.lit(x) for x in "ABCD"]), F.col("p_size") % 4 + 1).alias("answer"))
    return sinks.option_rows(rows, F.lit("bank"))


@query("""
SELECT sha256('bank|' || p_partkey) AS question_id, 'Q' || p_partkey AS question_ref, p_name AS stem, CASE WHEN p_size % 7 = 0 THEN 'needs_review' ELSE 'parsed' END AS status,
  '{"brand":"' || p_brand || '","size":' || p_size || '}' AS payload FROM part""")
def question_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a question table with their nested part as JSON: parts as questions."""
    part = table(spark, sf_dir, "part")
    rows = part.select(F.col("p_partkey").cast("string").alias("ref"), F.col("p_name").alias("stem"), (F.col("p_size") % 7 == 0).alias("requires_review"), F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("payload"))
    return sinks.question_rows(rows, F.lit("bank"))


from examloom.plans import cases, shapes  # noqa: E402, F401  (they register further queries)
