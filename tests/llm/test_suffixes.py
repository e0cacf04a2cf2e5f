"""Repeated byte strings against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from examloom.llm import suffixes


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def corpus(seed, n=60, common=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(8)]
    hot = " ".join(word() for _ in range(18))
    texts = [None, "", "short", "ab" * 300, "ab" * 301, "x" * 500]
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), " ".join(word() for _ in range(rng.randint(0, 12)))]
        if i < common:
            parts.insert(1, hot)
        text = " ".join(parts)
        if texts and rng.random() < 0.3:
            base = list(rng.choice(texts[6:] or [text]) or text)
            for _ in range(rng.randint(0, 3)):
                if base:
                    base[rng.randrange(len(base))] = rng.choice("xyz")
            text = "".join(base)
        texts.append(text)
    return texts + texts[-3:]


def run(spark, texts, length, parts=3):
    df = spark.createDataFrame([(i, t, "u") for i, t in enumerate(texts)], "doc_id long, text string, kept string").repartition(parts)
    rows = suffixes.remove_repeats(df, length=length).collect()
    return [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in sorted(rows, key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("length", [4, 50, 100])
def test_equals_brute_force(spark, length):
    texts = corpus(length)
    assert run(spark, texts, length) == brute(texts, length)


@pytest.mark.parametrize("group,hot", [(5, 16), (1024, 2), (5, 3), (2, 2)])
def test_large_groups_are_refined(spark, monkeypatch, group, hot):
    monkeypatch.setattr(suffixes, "GROUP", group)
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "CHUNK", 3000)
    texts = corpus(7, n=80, common=70)
    assert run(spark, texts, 60) == brute(texts, 60)


def test_anchors_do_not_depend_on_the_step():
    rng = random.Random(9)
    for n in (0, 19, 20, 21, 300, 1000):
        data = np.array([rng.choice(b"abc") for _ in range(n)], np.uint8)
        whole = suffixes.anchors(data, 20, 6)
        for step in (1, 7, 64):
            assert all((a == b).all() for a, b in zip(whole, suffixes.anchors(data, 20, 6, step)))


def test_sort_survives_colliding_hashes():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(200)]
    group = np.sort(np.array([rng.randint(0, 5) for _ in strings]))
    for break_hashes in (False, True):
        s = suffixes.Suffixes(group, strings, 9)
        if break_hashes:
            s.sums[:] = 0
        order, common = s.sort()
        want = sorted(range(200), key=lambda i: (group[i], strings[i]))
        assert [(group[i], strings[i]) for i in order] == [(group[i], strings[i]) for i in want]
        for k in range(1, 200):
            a, b = strings[order[k - 1]], strings[order[k]]
            n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            assert common[k] == (n if group[order[k]] == group[order[k - 1]] else -1)


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "q" * 30)] * 2 + [(None, "q" * 12), (None, None)], "`a.id` long, text string")
    got = suffixes.remove_repeats(df, "a.id", length=10)
    assert got.columns == ["a.id", "n_bytes", "n_removed", "n_spans", "kept"]
    assert sorted((r["n_bytes"], r["n_removed"]) for r in got.collect()) == [(0, 0), (12, 12), (30, 30), (30, 30)]
    assert suffixes.remove_repeats(df.limit(0), "a.id").count() == 0
