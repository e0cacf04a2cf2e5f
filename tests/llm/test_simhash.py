"""SimHash components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from examloom.llm import graph, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {n: find(n) for n in nodes}


def test_fingerprints():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "one TWO", "É é a b c", "a\u00a0b c d e"]
    texts += [" ".join(rng.choice(["The", "cat", "sät", "on", "MAT", "x\u2003y"]) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    for t in texts:
        assert simhash.fingerprint(t) % (1 << 64) == brute_fingerprint(t), t


@pytest.mark.parametrize("short,block", [(16, 4096), (2, 4096), (2, 6)])
def test_links_keep_components(spark, monkeypatch, short, block):
    """Few bits differ at random, so lists are long; with a small block they are dealt out."""
    monkeypatch.setattr(simhash, "SHORT", short)
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(short + block)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = set()
    for _ in range(160):
        v = rng.choice(centres)
        for b in rng.sample(range(64), rng.randint(0, 9)):
            v ^= 1 << b
        values.add(v)
    signed = sorted(int(np.uint64(v).view(np.int64)) for v in values)
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3))
    for a, b in edges.collect():
        assert a != b and ((a ^ b) % (1 << 64)).bit_count() <= 4
    roots = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    want = brute_components(signed, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 4)
    assert {n: roots.get(n, n) for n in signed} == want


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 400), (600, 500), (700, 701), (701, 700)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and got[500] == got[600] == 400 and got[701] == 700
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    base = " ".join(f"word{i}" for i in range(300))
    texts = [base, base, base.replace("word150 ", "other "), None, "", "  ", "a b", "A  B", base.upper()]
    rows = [(10 + i, t, "s") for i, t in enumerate(texts)] + [(10, base, "s"), (None, base, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, simhash string")
    got = simhash.with_components(df).collect()
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    assert len(got) == len(rows)
    components = {r["doc_id"]: r["component_id"] for r in got}
    for i, (a, _, _) in enumerate(rows):
        want = min(b for j, (b, _, _) in enumerate(rows) if b is not None and (fps[i] ^ fps[j]).bit_count() <= 4)
        assert components[a] <= want
    assert components[13] == components[14] == components[15] == 13 and components[16] == components[17] == 16
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect())[:1] == [(False, 10)]
    assert sum(r["doc_id"] == 10 for r in kept.collect()) == 1
    assert simhash.with_components(df.limit(0)).count() == 0


def test_similar_texts_are_dropped(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(5000)]
    bases = [[rng.choice(words) for _ in range(250)] for _ in range(12)]
    rows, near, far = [], set(), set()
    for k, base in enumerate(bases):
        rows.append((k, " ".join(base)))
        for copy, edits in enumerate((1, 2, 4, 60)):
            ws = list(base)
            for i in rng.sample(range(250), edits):
                ws[i] = rng.choice(words)
            i = 100 + 10 * k + copy
            rows.append((i, " ".join(ws)))
            (far if edits == 60 else near).add(i)  # up to four edits: similarity above 0.85; sixty: below 0.3
    rows += [(900 + i, "short text here") for i in range(3)] + [(950, "short text there")]
    got = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == set(range(12)) | far | {900, 950}
    assert simhash.most_differing(1.0) == 0


def shingles(text):
    ws = text.lower().split()
    return {" ".join(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))}


def brute_groups(rows, similarity=0.8):
    sets = {i: shingles(t) for i, t in rows}
    return brute_components(sorted(sets), lambda a, b: len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9)


def letters(rng, n, fields=12, size=300):
    """Form letters: the same words but for some fields; different letters differ in all fields."""
    form = [f"f{i}" for i in range(size)]
    at = [size * (2 * k + 1) // (2 * fields) for k in range(fields)]
    out = []
    for _ in range(n):
        ws = list(form)
        for i in at:
            ws[i] = f"v{rng.getrandbits(40)}"
        out.append(ws)
    return out, at


def kept_ids(spark, rows):
    return {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}


@pytest.mark.parametrize("block", [simhash.BLOCK, 64])
def test_copies_inside_long_lists_are_dropped(spark, monkeypatch, block):
    """Many copies share the lists of a common form, and only two of them each are similar."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", 1 << 14, raising=False)
    rng = random.Random(21)
    family, at = letters(rng, 400)
    rows = [(i, " ".join(ws)) for i, ws in enumerate(family)]
    for k in range(40):
        ws = list(family[k])
        for i in rng.sample(at, 3):
            ws[i] = f"u{rng.getrandbits(40)}"
        rows.append((1000 + k, " ".join(ws)))
    root = brute_groups(rows)
    assert sum(root[i] != i for i in root) == 40
    assert kept_ids(spark, rows) == {i for i in root if root[i] == i}


@pytest.mark.parametrize("how", ["appended", "inserted", "replaced"])
def test_changed_passages(spark, how):
    """One contiguous passage differs, by so many words that the similarity lies about 0.8."""
    rng = random.Random(how)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for k in range(60):
        ws, passage = ([rng.choice(words) for _ in range(n)] for n in (250, 10 + k))
        at = {"appended": 250, "inserted": 100, "replaced": 250 - len(passage) // 2}[how]
        end = 250 if how == "replaced" else at
        rows += [(k, " ".join(ws)), (100 + k, " ".join(ws[:at] + passage[: len(passage) if how != "replaced" else 250 - at] + ws[end:]))]
    root = brute_groups(rows)
    dropped = {i for i in root if root[i] != i}
    assert 20 <= len(dropped) < 60
    assert kept_ids(spark, rows) == set(root) - dropped


def test_groups_of_recombined_texts(spark, monkeypatch):
    """Texts of the same passages in other choices: long lists with several groups, compared in blocks."""
    monkeypatch.setattr(simhash, "SHORT_LIST", 3, raising=False)
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", 1 << 11, raising=False)
    rng = random.Random(5)
    pool = [" ".join(f"p{i}x{j}" for j in range(12)) for i in range(30)]
    bases = [sorted(rng.sample(range(30), 20)) for _ in range(4)]
    rows = []
    for i in range(150):
        chosen = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            chosen[rng.randrange(20)] = rng.randrange(30)
        rows.append((i, " ".join(pool[j] for j in chosen)))
    root = brute_groups(rows)
    assert 10 < len(set(root.values())) < 140
    assert kept_ids(spark, rows) == {i for i in root if root[i] == i}


def test_different_letters_stay(spark):
    """Letters of one form at similarities from 0.7 to below 0.8 are no copies of each other, however many they are."""
    rng = random.Random(31)
    family, _ = letters(rng, 400, fields=9)
    rows = [(i, " ".join(ws)) for i, ws in enumerate(family)]
    x, y = shingles(rows[0][1]), shingles(rows[1][1])
    assert 0.7 < len(x & y) / len(x | y) < 0.8
    assert kept_ids(spark, rows) == set(range(400))


def test_rows_of_one_id_and_rows_without_one(spark):
    """Different texts of one id are judged each; repeated rows leave one, rows without an id stay."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, "x"), (1, b, "x"), (2, b, "x"), (2, a + " end", "x"), (3, c, "x"), (3, c, "y"), (None, c, "x"), (None, None, "x"), (4, None, "x"), (5, " ", "x")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, node string")).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([(1, a), (1, b), (3, c), (None, c), (None, None), (4, None)], key=str)
    assert got[0].asDict().keys() == {"doc_id", "text", "node"}


def test_sketches_never_fall_below_what_two_texts_share():
    rng = random.Random(17)
    for n in (1, 3, 40, 300, 3000):
        pool = [rng.getrandbits(64) for _ in range(2 * n)]
        x, y = (simhash.np.array(sorted(rng.sample(pool, k)), "uint64") for k in (n, rng.randint(n, 2 * n)))
        shared = len(set(x.tolist()) & set(y.tolist()))
        assert shared <= simhash.most_shared(simhash._sketch(x), simhash._sketch(y), len(x)) <= len(y)
    many = simhash.np.arange(300, dtype="uint64")
    assert simhash._sketch(many) == b"" and simhash.most_shared(b"", simhash._sketch(x), 7) == 7
