"""Secret scans against a plain-Python version."""

import math
import random
import re
import string

import pytest
from examloom.llm import secrets
from pyspark.sql import functions as F

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    for kind, cls in enumerate(secrets.CLASSES, 3):
        for m in re.finditer(cls.pattern.replace("}+", "}"), text):
            s = m[0]
            if not all(re.search(x, s) for x in cls.must) or any(re.search(x, s) for x in secrets.ALLOWED_RUNS):
                continue
            hot = []
            for i in range(len(s) - 19):
                counts = [s[i : i + 20].count(c) for c in set(s[i : i + 20])]
                allowed = any(re.search(x, s[i : i + 20]) for x in secrets.ALLOWED)
                if sum(round(secrets.ONE * c * math.log2(c)) for c in counts) <= cls.most and not allowed:
                    if hot and hot[-1][1] > i:
                        hot[-1][1] = i + 20
                    else:
                        hot.append([i, i + 20])
            spans += [(m.start() + a, kind, m.start() + b) for a, b in hot]
    return sorted(spans)


def texts():
    rng = random.Random(5)
    out = [None, "", "token=token: abcdefgh", "token = 'abc' password:\"hunter2hunter2\"", "AKIA" + "B" * 16 + " AKIAAKIA0000", "ſecret=abcdef PASSWD : qwertyui"]
    out += ["😀é api_key='" + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + "' ñ token=\n x", "id 123e4567-e89b-12d3-a456-426614174000 sample0123456789ABCDEFabcdef01", "é MZXW6YTBOI5HS3DPNRQW4Y3F. k3j9x0q8v7z2m5n1b4c6w"]
    pieces = ["token", "=", ": ", "secret", '"', " ", "api_key", "apikey", "PassWord", "AKIA", "é", "😀", "\n", "-", "example"]
    for _ in range(150):
        s = ""
        for _ in range(rng.randint(0, 14)):
            s += rng.choice([rng.choice(pieces), "".join(rng.choice(rng.choice(["0123456789abcdef", "ABCDEFG0123", string.ascii_letters + string.digits + "+/="])) for _ in range(rng.randint(1, 60)))])
        out.append(s)
    return out


def test_scan_equals_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [(s["start"], s["kind"], s["end"]) for s in r["secrets"]] for r in secrets.scan(df).collect()}
    for i, text in rows:
        assert got[i] == brute(text), (i, text)
    assert {k for spans in got.values() for _, k, _ in spans} == {0, 1, 2, 3, 4, 5}


def test_allowed_words_hide_no_neighbour(spark):
    """A random value glued to a word of the allow-list is found; tokens of one letter case are, too."""
    value = "q7Xz9LmP2vRt5KwB8nYc"
    rows = [(0, f"example_key={value}"), (1, "MZXW6YTBOI5HS3DPNRQW4Y3F"), (2, "k3j9x0q8v7z2m5n1b4c6w"), (3, "example" * 4 + "1A"), (4, "internationalization2020 of things")]
    got = {r["doc_id"]: r["w"] for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", secrets.written(F.col("secrets")).alias("w")).collect()}
    assert "b64entropy" in got[0] and "b36entropy" in got[1] and "b36entropy" in got[2] and not got[3] and not got[4]


def test_redact_and_odd_tables(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a token=abcdef1 b", "x"), (3, "a token=abcdef1 b", "x"), (4, "plain", "x")], "doc_id long, text string, secrets string")
    got = {(r["doc_id"], r["text"]) for r in secrets.redact(df).collect()}
    assert got == {(1, None), (2, ""), (3, "a <SECRET> b"), (4, "plain")}
    assert secrets.redact(df).columns == df.columns
    assert secrets.scan(df.limit(0)).count() == 0
    long = "word " * 30000 + "token=abcdef123456"
    row = secrets.scan(spark.createDataFrame([(1, long)], "doc_id long, text string")).select(secrets.written(F.col("secrets")).alias("w")).first()
    assert row["w"] == "assign:150000:150018"
    assert secrets.scan(spark.createDataFrame([(1, long)], "doc_id long, `a.b` string"), "a.b").select(F.size("secrets")).first()[0] == 1


if __name__ == "__main__":
    pytest.main([__file__])
