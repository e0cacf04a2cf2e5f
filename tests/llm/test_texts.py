"""Licenses, decontamination, quality, URL filters and order MinHash on small tables."""

import hashlib
import math
import random
import zlib

import pytest
from examloom.llm import decontaminate, licenses, order_minhash, quality, quality_selection, urls
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def longest_increasing(values):
    best = [1] * len(values)
    for i in range(len(values)):
        for j in range(i):
            if values[j] < values[i]:
                best[i] = max(best[i], best[j] + 1)
    return max(best, default=0)


@given(st.lists(st.integers(0, 30), max_size=25))
def test_increasing(values):
    got = [values[i] for i in licenses.increasing(values)]
    assert got == sorted(set(got)) and len(got) == longest_increasing(values)


@given(st.lists(st.integers(0, 8), max_size=20), st.lists(st.integers(0, 8), max_size=20))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = licenses.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert licenses.align(a, a) == [(i, i) for i in range(len(a))]


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT"]
    words = licenses.words(mit)
    changed = " ".join(w for i, w in enumerate(words) if i % 9)
    texts = [None, "", "the of and", mit, "x " * 5000 + mit + " y" * 5000, changed, "Released under the MIT License. Released under the MIT License.", " ".join(sorted(words)), "Licensed under the Apache License, Version 2.0 only"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(3, mit, 1)], "doc_id long, text string, licenses int")
    got = {r["doc_id"]: [m["license"] for m in r["licenses"]] for r in licenses.scan(df).collect()}
    assert got == {0: [], 1: [], 2: [], 3: ["MIT"], 4: ["MIT"], 5: ["MIT"], 6: ["MIT-notice", "MIT-notice"], 7: [], 8: ["Apache-2.0-notice"]}
    assert licenses.scan(df.limit(0)).count() == 0


def test_close_copies_of_a_license_are_all_found():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.THRESHOLD)
    nc, by, mit = (licenses.TEMPLATES[k] for k in ("CC-BY-NC-4.0-notice", "CC-BY-4.0-notice", "MIT"))
    cases = [("CC-BY-NC-4.0-notice", f"{nc} Foo. {nc} {nc}", 3), ("CC-BY-4.0-notice", f"{by} Data: {by} This {by}", 3)]
    cases += [("MIT", f" {' '.join(['the', 'name', 'of', 'any'][:gap])} ".join([mit] * 6), 6) for gap in range(5)]
    for name, text, n in cases:
        found = [m for m in scanner.scan(text) if m[0] == name]
        assert len(found) == n, text[:80]
        assert all(x[4] <= y[3] for x, y in zip(found, found[1:]))


def brute_scan(ws, template, threshold):
    """Every start, in the scanner's order, aligned against the stretch up to the window's end or the next taken word: spans of one template."""
    t = licenses.words(template)
    window, need = max(len(t) + 1, math.ceil(licenses.SLACK * len(t))), math.ceil(threshold * len(t) - 1e-9)
    held = {a: sum(w in t for w in ws[a : a + window]) for a in range(len(ws)) if ws[a] in t}
    used, out = [False] * len(ws), []
    for a in sorted(held, key=lambda a: (-held[a], a)):
        if used[a]:
            continue
        b = next((i for i in range(a, min(a + window, len(ws))) if used[i]), min(a + window, len(ws)))
        pairs = licenses.align(ws[a:b], t)
        if len(pairs) >= need:
            first, last = a + pairs[0][0], a + pairs[-1][0] + 1
            used[first:last] = [True] * (last - first)
            out.append((first, last))
    return sorted(out)


def test_licenses_against_all_windows():
    """No window is passed over: notices cut, glued and mixed at random give what aligning every window gives."""
    rng = random.Random(23)
    names = [n for n, t in licenses.TEMPLATES.items() if len(licenses.words(t)) < 40]
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.THRESHOLD)
    for _ in range(150):
        ws = []
        for _ in range(rng.randint(1, 6)):
            part = licenses.words(licenses.TEMPLATES[rng.choice(names)])
            part = [w for w in part if rng.random() > rng.choice([0, 0.1, 0.25])]
            ws += part + [rng.choice(["foo", "the", "mit", "under", "license"]) for _ in range(rng.randint(0, 3))]
        found = scanner.scan(" ".join(ws))
        for name in names:
            assert sorted((m[3], m[4]) for m in found if m[0] == name) == brute_scan(ws, licenses.TEMPLATES[name], licenses.THRESHOLD), (name, " ".join(ws))


def brute_cover(a, b, least):
    taken_a, taken_b, cover = [v < 0 for v in a], [False] * len(b), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not taken_a[i + n] and not taken_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return cover
        for k in range(n):
            taken_a[i + k] = taken_b[j + k] = True
        cover += n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-1, 3), max_size=24), st.lists(st.integers(0, 3), min_size=1, max_size=16))
def test_tiles_equal_brute_force(a, b):
    assert sum(t[2] for t in decontaminate.tiles(a, b, 3)) == brute_cover(a, b, 3)


def test_decontamination(spark, monkeypatch):
    rng = random.Random(2)
    item = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    items = [item(30), item(40), item(2), "", None]
    w = items[0].split()
    filler = " ".join(f"f{i}" for i in range(20000))
    texts = [
        None, "", filler, filler + " " + items[0].upper() + "! " + filler,
        " ".join(w[15:] + ["x"] + w[:15]), " ".join(w[:20]), " ".join(w[:24]), "  ".join(w[::-1]), items[1] + " " + items[0], items[2], w[0],
    ]
    docs = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)] + [(3, texts[3], "h")], "doc_id long, text string, hits string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {i: [] for i in range(len(texts))} | {3: [0], 4: [0], 6: [0], 8: [0, 1], 9: [2]}
    for block, at_once in ((decontaminate.BLOCK_CHARS, 4), (10, 4), (10, 2)):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
        monkeypatch.setattr(decontaminate, "BLOCKS_AT_ONCE", at_once)
        got = {r["doc_id"]: sorted(h["item_id"] for h in r["hits"]) for r in decontaminate.with_hits(docs, bench).collect()}
        assert got == want
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, bench).collect()) == [i for i in want if not want[i]]
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(texts) + 1
    assert decontaminate.with_hits(docs.limit(0), bench).count() == 0


def test_quality(spark):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat", "and", "slept", "until", "noon"]) for _ in range(120))
    bad = lambda: " ".join(rng.choice(["xq", "zzk", "##$$", "vvw", "qqj", "%%k"]) + rng.choice("&*!?") for _ in range(120))
    labels = [(i, i % 2) for i in range(240)]
    docs = [(i, good() if y else bad(), 0.0) for i, y in labels]
    df = spark.createDataFrame(docs + [(1000, None, 0.0), (1001, "", 0.0), (1002, good() * 200, 0.0)], "doc_id long, text string, score double")
    table = spark.createDataFrame(labels + [(5, 0), (7, None)], "doc_id long, quality int")
    model = quality.learn(df, table)
    got = {r["doc_id"]: r["score"] for r in quality.score(df, model).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(held) > 40 and all((got[i] >= 0.5) == (i % 2 == 1) for i in held)
    assert got[1000] == got[1001] and got[1002] > 0.5 and all(0 <= s <= 1 for s in got.values())
    one = quality.learn(df, table.where("quality = 1"))
    assert {r["score"] for r in quality.score(df, one).select(F.round("score", 9).alias("score")).collect()} == {round(1 / (1 + 2.718281828459045 ** -one.bias), 9)}
    assert quality.score(df, quality.learn(df, table.limit(0))).count() == df.count()
    # Labels of held-out rows change nothing.
    flipped = table.withColumn("quality", F.when(quality.remainder(F.col("doc_id")) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.learn(df, flipped) == model


URLS = [None, "", "no scheme", "http://net/", "https://a.b.NET/x", "http://net", "http://xnet/", "https://www.example.net/en/1?x#y", "https://example.com/de/", "https://example.com/de", "http://é.org/fr/x", "http://org/fr/", "://h?p/q", "a://b://c/d", "http://cheap-pills.org/en/", "http://user@HOST:80/p;x#f?"]


def brute_rule(host, path):
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_urls(spark):
    model = urls.fit(urls.LABELLED)
    rng = random.Random(5)
    listed = URLS + ["http://" + "".join(rng.choice("abnetorg./-?#") for _ in range(rng.randint(0, 25))) for _ in range(100)]
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(listed)], "page_id long, url string, rule string")
    judged = urls.judge(df, model)
    assert judged.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    for r in judged.collect():
        host, path = urls.split_url(r["url"])
        rule = brute_rule(host, path)
        verdict = rule.verdict if rule else "block" if model.total(host, path) > 0 else "allow"
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule and rule.text, verdict), r["url"]
    assert sum((model.total(*urls.split_url(u)) > 0) == bool(y) for u, y in urls.LABELLED) >= 0.97 * len(urls.LABELLED)
    precision, recall, accuracy = urls.measured()  # on rows that the model has not seen
    assert precision >= 0.95 and recall >= 0.8 and accuracy >= 0.88
    assert urls.judge(df.limit(0), model).count() == 0
    assert urls.fit_table(spark.createDataFrame([*urls.LABELLED, ("x", None)], "url string, label int")).bias == urls.fit(sorted(urls.LABELLED)).bias


def brute_sketch(kmers, multiplier):
    """The places of the smallest numbered k-mers under one order, by sorting."""
    small = (order_minhash._numbered(kmers) >> 32).astype("uint32")
    order = sorted(range(len(small)), key=lambda i: (int(small[i]) * int(multiplier) % (1 << 32), i))
    return sorted(order[: order_minhash.TUPLE])


def test_order_minhash():
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefg hij") for _ in range(3000))
    other = "".join(rng.choice("abcdefg hij") for _ in range(3000))
    same = lambda a, b: (order_minhash.sketches(a) == order_minhash.sketches(b)).mean()
    assert same(text, text) == 1 and same(text, other) < 0.1 and same(text, text[:1500] + other[:1500]) > 0.02
    assert same(text, text[:1000] + "X" + text[1000:]) > 0.8
    # Order matters: the same k-mers in another order are less like the text.
    assert same(text, text[1500:] + text[:1500]) < 0.9
    assert order_minhash.fingerprint(None) == order_minhash.fingerprint("") == "0" * order_minhash.SKETCHES * order_minhash.DIGITS
    assert order_minhash.fingerprint("ab") == order_minhash.fingerprint("ab") != order_minhash.fingerprint("ac")
    kmers = order_minhash._kmers("abab" * 30)
    assert len(set(order_minhash._numbered(kmers).tolist())) == len(kmers)
    chosen = brute_sketch(kmers, order_minhash._ODD[0])
    h = order_minhash._mix(order_minhash._mix(order_minhash.np.array([2], "uint64") * order_minhash._BASE + kmers[chosen[:1]]) * order_minhash._BASE + kmers[chosen[1:]])
    assert int(h[0] >> order_minhash.np.uint64(48)) == int(order_minhash.sketches("abab" * 30)[0])


@pytest.mark.parametrize("bucket", [4096, 7])
def test_next_documents(spark, monkeypatch, bucket):
    monkeypatch.setattr(order_minhash, "BUCKET_ROWS", bucket)
    rng = random.Random(bucket)
    rows = [(rng.randrange(10**9), "".join(rng.choice("abé😀 ") for _ in range(rng.randint(0, 50)))) for _ in range(60)]
    rows += [(None, "null id"), (5, None), (5, "b"), (5, "b")]
    got = order_minhash.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    ordered = sorted([(i, t or "") for i, t in rows], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (i, t) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        edited = order_minhash.edited(t, following)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), order_minhash.fingerprint(t), order_minhash.fingerprint(edited)))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(want, key=key)
    alone = order_minhash.with_next(spark.createDataFrame(rows[:1], "doc_id long, text string")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert order_minhash.with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    like = spark.createDataFrame([("0" * 512, "0" * 256 + "1" * 256)], "a string, b string").select(order_minhash.likeness(F.col("a"), F.col("b"))).first()[0]
    assert like == 0.5


def test_settings_are_chosen_without_held_out_rows(spark, tmp_path):
    rng = random.Random(9)
    word = lambda y: rng.choice(["cat", "sat", "mat", "noon"] if y else ["xq#", "zz%", "vv&", "qq!"])
    docs = [(i, f"{i} " + " ".join(word(i % 2) for _ in range(80))) for i in range(120)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    fitted, compared = quality_selection.rows(spark, str(tmp_path))
    remainders = [{zlib.crc32(text.split()[0].encode()) % 3 for text, _ in part} for part in (fitted, compared)]
    assert remainders == [{0}, {2}] and len(fitted) + len(compared) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, _ in docs)
    for settings in (quality.SETTINGS, quality_selection.FIRST):
        wrong, loss = quality_selection.cost(settings, [(fitted, compared)])
        assert wrong == 0 and 0 <= loss < len(compared)
    assert quality.fit(fitted, quality_selection.FIRST).settings == quality_selection.FIRST
