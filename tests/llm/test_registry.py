"""The registered corpus queries on the smallest tables: declared columns, and brute force or libraries for every row."""

import hashlib
import heapq
import math
import os
import re
from collections import Counter

import duckdb
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
import xxhash
from examloom.llm import bpe, decontaminate, licenses, order_minhash, registry, secrets

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")

COLUMNS = {
    "op1_license_scan": {"doc_id": "bigint", "n_matches": "bigint", "license": "string", "coverage": "double", "matches": "string"},
    "op2_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op3_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op4_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op5_decontaminate": {"doc_id": "bigint", "item_id": "bigint", "coverage": "double", "tiles": "int", "first_word": "int"},
    "op6_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op8_bpe_round_trip": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op9_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op10_order_minhash": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
}


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall())


def rows(spark, name):
    frame = registry.QUERIES[name](spark, SF_DIR)
    assert dict(frame.dtypes) == COLUMNS[name]
    return frame.collect()


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_one_query_for_each_operator():
    assert [re.match(r"op(\d+)_", n)[1] for n in registry.QUERIES] == [str(n) for n in range(1, 11)]


def test_licenses(spark, texts):
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.THRESHOLD)
    notice = re.compile(r"Released under the MIT License\.|Licensed under the Apache License, Version 2\.0\.|This work is licensed under the GNU General Public License, version 3\.|Licensed under CC BY-NC 4\.0\.")
    got = {r["doc_id"]: r for r in rows(spark, "op1_license_scan")}
    for i, t in texts.items():
        assert got[i]["n_matches"] == len(scanner.scan(t))
        assert (got[i]["license"] is not None) >= bool(notice.search(t))
        assert (got[i]["license"] is None) == (got[i]["coverage"] is None) == (got[i]["matches"] == "")


def test_repeats(spark, texts):
    data = {i: t.encode() for i, t in texts.items()}
    seen = Counter(d[i : i + 400] for d in data.values() for i in range(len(d) - 399))
    got = {r["doc_id"]: tuple(r)[1:] for r in rows(spark, "op2_suffix_dedup")}
    for k, d in data.items():
        gone = bytearray(len(d))
        for i in range(len(d) - 399):
            if seen[d[i : i + 400]] > 1:
                gone[i : i + 400] = b"\x01" * 400
        runs = len(re.findall(b"\x01+", gone))
        assert got[k] == (len(d), sum(gone), runs, sha(bytes(b for b, g in zip(d, gone) if not g)))


def test_components(spark, texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fps = {}
    for i, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower))
        shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op3_simhash")}
    assert got == {i: (f"{fps[i]:016x}", find(i)) for i in fps}


def test_secrets(spark, texts):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for r in rows(spark, "op4_secret_scan"):
        t = texts[r["doc_id"]]
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        kinds = Counter(k for _, k, _ in found)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds[0], kinds[1], kinds[2])
        written = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]
        assert r["base_sha256"] == sha(",".join(written))
        assert set(written) <= set(r["spans"].split(",")) or not written


def test_decontamination(spark, texts):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    got = {(r["doc_id"], r["item_id"]) for r in rows(spark, "op5_decontaminate")}
    joined = {i: " " + " ".join(decontaminate.words(t)) + " " for i, t in texts.items()}
    whole = {(i, k) for i, t in joined.items() for k, b in items if f" {' '.join(decontaminate.words(b))} " in t}
    assert whole <= got
    for i, k in got - whole:
        shared = set(joined[i].split()) & set(decontaminate.words(dict(items)[k]))
        assert len(shared) >= 0.7 * len(set(decontaminate.words(dict(items)[k])))


def test_quality(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet'").fetchall())
    got = rows(spark, "op6_quality")
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.85 * len(held)


def test_tokens(spark, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    for r in rows(spark, "op7_token_counts"):
        t = texts[r["doc_id"]]
        n = len(sp.encode(t))
        assert tuple(r)[1:] == (len(t.encode()), n, n > 4096)


def test_round_trip(spark, texts):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for r in rows(spark, "op8_bpe_round_trip"):
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert tuple(r)[1:] == (len(ids), sha(" ".join(map(str, ids))), sha(texts[r["doc_id"]]))


def test_urls_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_DIR}/pages.parquet'")
    con.execute(registry.ORACLE_SQL["op9_url_filter"])
    names = [d[0] for d in con.description]
    assert sorted(con.fetchall(), key=str) == sorted((tuple(r[n] for n in names) for r in rows(spark, "op9_url_filter")), key=str)


MASK = (1 << 64) - 1


def plain_mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def plain_sketches(text, places):
    """Some sketches of a text with whole numbers and sorting only: number the k-mers, take the two least of an order, hash them in text order."""
    if not text:
        return ["0000"] * len(places)
    k, base = min(8, len(text)), 0x9E3779B97F4A7C15
    kmers, seen, small = [], Counter(), []
    for i in range(len(text) - k + 1):
        h = k
        for c in text[i : i + k]:
            h = (h * base + ord(c)) & MASK
        kmers.append(plain_mix(h))
        n = seen[text[i : i + k]]
        seen[text[i : i + k]] += 1
        small.append((plain_mix((kmers[-1] + n * base) & MASK) if n else kmers[-1]) >> 32)
    out = []
    for p in places:
        odd = int(order_minhash._ODD[p])
        chosen = sorted(heapq.nsmallest(2, range(len(small)), key=lambda i: (small[i] * odd % (1 << 32), i)))
        h = len(chosen)
        for i in chosen:
            h = plain_mix((h * base + kmers[i]) & MASK)
        out.append(f"{h >> 48:04x}")
    return out


def test_next_documents(spark, texts):
    ids = sorted(texts)
    places = range(5, 128, 31)
    equal = lambda x, y: sum(x[4 * j : 4 * j + 4] == y[4 * j : 4 * j + 4] for j in range(128)) / 128
    got = {r["doc_id"]: r for r in rows(spark, "op10_order_minhash")}
    for k, i in enumerate(ids):
        t, following = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = math.floor(len(t) / 2)
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), sha(t[: len(t) - half] + following[:half]))
        same = t == following
        edited = t[: len(t) - half] + following[:half]
        for text, written in ((t, got[i]["fingerprint"]), (edited, got[i]["edited_fingerprint"])):
            assert len(written) == 512 and [written[4 * j : 4 * j + 4] for j in places] == plain_sketches(text, places)
        assert got[i]["near_edited"] == equal(got[i]["fingerprint"], got[i]["edited_fingerprint"])
        assert got[i]["near_next"] == equal(got[i]["fingerprint"], got[ids[(k + 1) % len(ids)]]["fingerprint"])
        assert (got[i]["near_next"] == 1.0) >= same and 0 <= got[i]["near_edited"] <= 1
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) > 0.9 * len(got)
