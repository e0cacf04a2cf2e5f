"""The corpus pipeline against a plain version of every stage, on a small table."""

import random
import re

import corpus_pipeline
import public_tokenizers as P
import tiktoken
from examloom.llm import bpe, quality, simhash


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def tables(spark, folder):
    rng = random.Random(8)
    good = [f"word{i}" for i in range(400)]
    bad = [f"#{i}$%" for i in range(40)]
    benchmark = [(i, sentence(rng, good, 30)) for i in range(5)]
    docs, labels = [], []
    for i in range(150):
        text = sentence(rng, good if i % 3 else bad, 150)
        if i % 10 == 1:
            text += " " + benchmark[i % 5][1]
        if i % 7 == 2:
            text += ' token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end'
        docs.append((i, text))
        labels.append((i, 1 if i % 3 else 0, 0))
    docs += [(200, docs[4][1]), (201, docs[4][1]), (202, docs[5][1] + " more"), (203, docs[8][1])]
    rows = [(i, t, "en", "src0", len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs, labels, benchmark


def test_stages_and_run(spark, tmp_path):
    folder = str(tmp_path)
    docs, labels, benchmark = tables(spark, folder)
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    kept = dict(docs)

    scorer = quality.Scorer(quality.learn(frame, spark.read.parquet(f"{folder}/labels.parquet")))
    kept = {i: t for i, t in kept.items() if scorer.score(t) >= 0.5}
    assert set(kept) == {i for i, _ in docs if i >= 200 or i % 3}
    expected = [kept]

    fps = {i: simhash.fingerprint(t) % (1 << 64) for i, t in kept.items()}
    root = {i: i for i in kept}
    for i in sorted(kept):  # components here are pairs of close texts, so one pass from the least id is enough
        for j in sorted(kept):
            if j > i and (fps[i] ^ fps[j]).bit_count() <= 4:
                root[j] = min(root[j], root[i])
    kept = {i: t for i, t in kept.items() if root[i] == i}
    assert not {200, 201, 203} & set(kept)
    expected.append(kept)

    kept = {i: t for i, t in kept.items() if not any(b in t for _, b in benchmark)}
    expected.append(kept)

    def masked(text):
        return re.sub(r'token = "[0-9a-f]+', "<SECRET>", text)

    kept = {i: masked(t) for i, t in kept.items()}
    expected.append(kept)

    state = frame
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], expected):
        state = stage(spark, state, folder)
        assert tuple(state.columns) == corpus_pipeline.COLUMNS
        state.write.parquet(f"{folder}/{name}")
        state = spark.read.parquet(f"{folder}/{name}")
        assert {r["doc_id"]: r["text"] for r in state.collect()} == want, name
        assert all(r["n_chars"] == len(r["text"]) for r in state.collect())

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in kept.items()}


def test_stages_take_odd_rows(spark, tmp_path):
    folder = str(tmp_path)
    tables(spark, folder)
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, None, "en", "s", None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            assert out.count() <= docs.count(), name


def test_near_dedup_joins_fingerprints_and_similar_texts(spark):
    """Of a pair within four bits, or with a Jaccard similarity of 0.8, the first stays; of a pair that is neither, both."""
    rng = random.Random(12)
    wanted, rows, kept = {(True, False): 3, (False, True): 3, (False, False): 3}, [], set()
    while any(wanted.values()):
        base = [f"w{rng.getrandbits(40)}" for _ in range(300)]
        edited, step = list(base), 75 if wanted[False, True] else 37
        for i in range(10, 300, step):
            edited[i] = f"w{rng.getrandbits(40)}"
        a, b = " ".join(base), " ".join(edited)
        x, y = (set(simhash.shingle_set(t).tolist()) for t in (a, b))
        kind = (simhash.fingerprint(a) ^ simhash.fingerprint(b)) % (1 << 64)
        kind = (kind.bit_count() <= 4, len(x & y) >= 0.8 * len(x | y))
        if wanted.get(kind):
            wanted[kind] -= 1
            kept |= {len(rows)} if any(kind) else {len(rows), len(rows) + 1}
            rows += [(len(rows) + i, t, "en", "s", len(t)) for i, t in enumerate((a, b))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()} == kept
