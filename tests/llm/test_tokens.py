"""Token counts and byte-level BPE against the libraries whose vocabularies they use."""

import random

import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from examloom.llm import bpe, tokens
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

PIECES, RANKS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "  ", "\n", "▁", "▁▁a ▁", "a  b", " lead", "trail ", "tab\tnew\nline", "<s> </s> <unk> <0x0A> <|endoftext|>", "é😀​中 字", "x" * 3000, " " * 300, "aa" * 700, "it's they'll I'VE 123 4,5!!", "word " * 5000, "\u00a0\u2003mixed\u3000space"]
TEXTS = st.text(alphabet=st.sampled_from(list(" \n\t▁abcdehinorstTHE.,éßñ😀中'1203$#")) | st.characters(exclude_categories=["Cs"]), max_size=60)


@pytest.fixture(scope="module")
def pieces():
    return tokens.PieceModel(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def codec():
    c = bpe.Codec(RANKS, P.PATTERN)
    return c, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=c.transducer.ranks, special_tokens={})


def ids(packed):
    return memoryview(packed).cast("i").tolist() if packed else []


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_counts_equal_sentencepiece(pieces, text):
    own, library = pieces
    assert own.count(text) == len(library.encode(text))


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_equal_tiktoken_and_come_back(codec, text):
    own, library = codec
    got = ids(own.encode(text))
    assert got == library.encode_ordinary(text)
    assert own.decode(got) == text


def test_odd_texts(pieces, codec):
    for text in ODD:
        assert pieces[0].count(text) == len(pieces[1].encode(text)), text[:20]
        assert ids(codec[0].encode(text)) == codec[1].encode_ordinary(text), text[:20]


def test_full_state_table_changes_nothing(codec, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 30)
    monkeypatch.setattr(bpe, "MEMO_PIECES", 10)
    small = bpe.Codec(RANKS, P.PATTERN)
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice("abcdeinorst é中") for _ in range(rng.randint(0, 30)))
        assert ids(small.encode(text)) == codec[1].encode_ordinary(text)


def test_small_memo_changes_nothing(pieces, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PARTS", 3)
    small = tokens.PieceModel(PIECES)
    assert [small.count(t) for t in ODD] == [len(pieces[1].encode(t)) for t in ODD]


@given(st.binary(max_size=40), st.integers(0, 40))
def test_utf8_machine_in_two_feeds(data, cut):
    machine = bpe.Utf8Machine()
    a, held = machine.feed(b"", data[:cut])
    b, held = machine.feed(held, data[cut:])
    assert a + b + ("�" if held else "") == data.decode("utf-8", "replace")


def test_decoding_across_tokens(codec):
    own, _ = codec
    single = {b: own.transducer.ranks[bytes([b])] for b in range(256)}
    assert own.decode([single[b] for b in "中é😀".encode()]) == "中é😀"
    assert own.decode([single[0xE4]]) == "�"
    with pytest.raises(KeyError):
        own.decode([10**9])


def test_operators(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "The cat  sat.\n", "c"), (3, "The cat  sat.\n", "c"), (4, "word " * 20000, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, `ids.x` string").withColumn("ids", F.lit("clash"))
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = tokens.count_tokens(df.withColumn("n_tokens", F.lit("clash")), PIECES).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got)) == sorted((i, len(sp.encode(t)) if t else 0) for i, t, _ in rows)
    both = bpe.round_trip(df, RANKS, P.PATTERN)
    assert both.columns == ["doc_id", "text", "ids.x", "ids", "decoded"]
    for r in both.collect():
        assert r["decoded"] == (r["text"] or "")
    again = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN, out_col="back").select("text", "back").collect()
    assert all(r["back"] == (r["text"] or "") for r in again)
    assert bpe.encode(df.limit(0), RANKS, P.PATTERN).count() == 0
    assert tokens.count_tokens(df.limit(0), PIECES).count() == 0
