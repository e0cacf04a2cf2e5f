"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import os
import re

import duckdb
import pytest
from examloom.plans import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    frame = registry.QUERIES[name](spark, SF_DIR)
    con = duck.cursor()
    con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in con.description]
    assert sorted(frame.columns) == sorted(names)
    order = sorted(names)
    want = sorted(tuple(str(r[names.index(c)]) for c in order) for r in con.fetchall())
    got = sorted(tuple(str(r[c]) for c in order) for r in frame.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert registry.QUERIES[name](spark, SF_DIR).count() >= 0


def near_kept(boxes):
    kept = []
    for b in boxes:
        if not any(all(abs(x - y) <= 6 for x, y in zip(k[2:], b[2:])) for k in kept):
            kept.append(b)
    return kept


def test_near_dup_images_against_a_loop(spark):
    every = registry._boxes(spark, SF_DIR).select("l_orderkey", "l_linenumber", "l_partkey", "x0", "y0", "x1", "y1").collect()
    by = {}
    for r in sorted(map(tuple, every)):
        by.setdefault(r[0], []).append(r[1:])
    want = sorted((k, *b) for k, boxes in by.items() for b in near_kept(boxes))
    assert sorted(map(tuple, registry.QUERIES["near_dup_images"](spark, SF_DIR).collect())) == want


def test_classify_keyword_on_ties_and_capitals(spark, tmp_path):
    """Leaves 2 and 4 are tied, but the sum of two terms ends in another bit than the one term; a dotted capital I parts no word."""
    texts = ["de " * 30 + "ch aux " * 30, "DİE XİNG İNG", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT doc_id, leaf, score, confidence, status FROM ({registry.ORACLE_SQL['classify_keyword']}) ORDER BY 1").fetchall()
    got = registry.QUERIES["classify_keyword"](spark, str(tmp_path)).select("doc_id", "leaf", "score", "confidence", "status").orderBy("doc_id").collect()
    assert [r["leaf"] for r in got] == [2, 1, None, None] and list(map(tuple, got)) == want


@pytest.mark.parametrize("name", ["chem_normalize", "chem_tokens"])
def test_notation_is_dealt_out_and_made_once(spark, name):
    """Parts in one file keep all cores busy, and no filter makes a text's notation again."""
    frame = registry.QUERIES[name](spark, SF_DIR)
    assert frame.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert not re.search(r"Filter .*transform\(", frame._jdf.queryExecution().optimizedPlan().toString())
