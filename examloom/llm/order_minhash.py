"""Document fingerprints by order MinHash (operator 10).

A text's k-mers of code points are numbered by occurrence. For each of SKETCHES
orders the TUPLE smallest numbered k-mers are selected, put back into text
order, and hashed as a tuple. Equal places of two fingerprints are counted:
unlike plain MinHash they also need the k-mers' order, so they follow edit
distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

KMER = 8
TUPLE = 2
SKETCHES = 128
#: Hex digits of one sketch in a fingerprint.
DIGITS = 4
MAX_BUCKETS = 4096
BUCKET_ROWS = 4096

_SEEDS = np.random.Generator(np.random.PCG64(20)).integers(1, 2**32, size=SKETCHES, dtype=np.uint64)
_ODD = ((_SEEDS << np.uint64(1)) & np.uint64(0xFFFFFFFF) | np.uint64(1)).astype(np.uint32)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _kmers(text: str) -> np.ndarray:
    """Hashes of all k-mers in order; a shorter text is one k-mer."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    k = min(KMER, len(points))
    n = len(points) - k + 1
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h = h * _BASE + points[j : j + n]
    return _mix(h)


def _numbered(kmers: np.ndarray) -> np.ndarray:
    """Hashes of k-mers with the number of their occurrence."""
    bits = np.uint64(max(1, int(len(kmers)).bit_length()))
    keys = np.sort(kmers >> bits << bits | np.arange(len(kmers), dtype=np.uint64))
    same = (keys[1:] >> bits) == (keys[:-1] >> bits)
    if not same.any():
        return kmers
    at = np.arange(len(keys))
    first = np.concatenate(([True], ~same))
    number = at - np.maximum.accumulate(np.where(first, at, 0))
    places = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    numbers = np.empty(len(kmers), np.uint64)
    numbers[places] = number
    return np.where(numbers > 0, _mix(kmers + numbers * _BASE), kmers)


def sketches(text: str | None) -> np.ndarray:
    """The sketches of a text, as numbers below 16 ** DIGITS; all zero for an empty text."""
    if not text:
        return np.zeros(SKETCHES, np.uint64)
    kmers = _kmers(text)
    small = (_numbered(kmers) >> np.uint64(32)).astype(np.uint32)
    n, ell = len(small), min(TUPLE, len(small))
    chosen = np.empty((SKETCHES, ell), np.int64)
    step = max(1, min(SKETCHES, (1 << 18) // n))
    for at in range(0, SKETCHES, step):
        values = small[None, :] * _ODD[at : at + step, None]
        rows = np.arange(len(values))
        for t in range(ell):
            least = values.argmin(1)
            chosen[at : at + step, t] = least
            values[rows, least] = 0xFFFFFFFF
    chosen.sort(axis=1)
    h = np.full(SKETCHES, ell, np.uint64)
    for t in range(ell):
        h = _mix(h * _BASE + kmers[chosen[:, t]])
    return h >> np.uint64(64 - 4 * DIGITS)


def fingerprint(text: str | None) -> str:
    return "".join([f"{x:0{DIGITS}x}" for x in sketches(text).tolist()])


def fingerprints(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of a text as ``out_col``; a column of that name is replaced.

    Null counts as empty and has a fingerprint of zeros; a text below
    ``KMER`` code points is one k-mer. Equal texts have equal fingerprints.
    """

    @F.pandas_udf(T.StringType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t) for t in texts], dtype=object)

    return df.withColumn(out_col, of(common.col(text_col)))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal sketches of two fingerprints."""
    equal = F.aggregate(
        F.sequence(F.lit(0), F.lit(SKETCHES - 1)),
        F.lit(0),
        lambda n, i: n + (F.substring(a, i * DIGITS + 1, F.lit(DIGITS)) == F.substring(b, i * DIGITS + 1, F.lit(DIGITS))).cast("int"),
    )
    return equal / SKETCHES


def edited(text: str, following: str) -> str:
    """The last half of a text's code points replaced by the first as many of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below an id, by binary search; null is below all."""
    if not bounds:
        return F.lit(0)
    array = F.from_json(F.lit(str(bounds)), "array<bigint>")

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        at_or_below = F.coalesce(F.element_at(array, F.least(middle + 1, F.lit(len(bounds)))) <= doc_id, F.lit(False))
        open_ = s["low"] < s["high"]
        return F.struct(F.when(open_ & at_or_below, middle + 1).otherwise(s["low"]).alias("low"), F.when(open_ & ~at_or_below, middle).otherwise(s["high"]).alias("high"))

    rounds = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    return F.aggregate(rounds, F.struct(F.lit(0).cast("int").alias("low"), F.lit(len(bounds)).cast("int").alias("high")), halve, lambda s: s["low"])


RESULT = T.StructType(
    [
        T.StructField("n_chars", T.LongType(), False),
        T.StructField("edited_sha256", T.StringType(), False),
        T.StructField("fingerprint", T.StringType(), False),
        T.StructField("edited_fingerprint", T.StringType(), False),
        T.StructField("near_edited", T.DoubleType(), False),
        T.StructField("near_next", T.DoubleType(), False),
    ]
)


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids with the fingerprints of each text, of its edited form and their likeness to each other and to the next text.

    The next text is that of the next id, ascending, nulls first; of equal ids
    the lesser text comes first; after the last comes the first, so a single
    row follows itself. Ids are whole numbers. An empty table gives an empty
    result. All columns but these two are dropped, whatever their names. Texts are dealt out once: into ranges of ids, at most
    ``MAX_BUCKETS``, each with a copy of the first row of the range after it.
    """
    docs = df.select(common.col(id_col).cast("long").alias("id"), F.coalesce(common.col(text_col), F.lit("")).alias("text"))
    n = docs.count()
    schema = T.StructType([T.StructField(id_col, T.LongType(), True), *RESULT.fields])
    if not n:
        return df.sparkSession.createDataFrame([], schema)
    parts = min(MAX_BUCKETS, -(-n // BUCKET_ROWS))
    bounds: list[int] = []
    if parts > 1:
        shares = F.from_json(F.lit(str([i / parts for i in range(1, parts)])), "array<double>")
        found = docs.select(F.percentile_approx("id", shares, 20 * parts).alias("q")).first()["q"]
        bounds = sorted(set(found or []))
    # At most MAX_BUCKETS rows: the least id of each range, null being the least of all.
    dealt = docs.withColumn("bucket", _bucket(F.col("id"), bounds))
    least = {r["bucket"]: None if r["nulls"] else r["id"] for r in dealt.groupBy("bucket").agg(F.min("id").alias("id"), F.count_if(F.col("id").isNull()).alias("nulls")).collect()}
    order = sorted(least)
    before = {least[b]: a for a, b in zip([order[-1], *order], order)}
    goes_to = df.sparkSession.createDataFrame([(i, b) for i, b in before.items()], "first long, to int")
    firsts = (
        docs.join(F.broadcast(goes_to), F.col("id").eqNullSafe(F.col("first")))
        .groupBy("to", "id")
        .agg(F.min("text").alias("text"))
        .select("id", "text", F.col("to").alias("bucket"), F.lit(1).alias("guest"))
    )
    rows = dealt.withColumn("guest", F.lit(0)).unionByName(firsts)
    rows = rows.repartitionById(order[-1] + 1, F.col("bucket")).sortWithinPartitions("bucket", "guest", F.col("id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row seen: bucket, id, text, sketches
        for batch in batches:
            out: list[tuple] = []
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, text, bucket, guest in zip(*[part.column(i).to_pylist() for i in range(4)]):
                    own = sketches(text)
                    if held is not None and held[0] == bucket:
                        out.append(_compared(*held[1:], text, own))
                    held = None if guest else (bucket, doc_id, text, own)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(ARROW)], names=schema.names)

    return rows.select("id", "text", "bucket", "guest").mapInArrow(run, schema)


ARROW = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())


def _compared(doc_id: int | None, text: str, own: np.ndarray, following: str, its: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = sketches(changed)
    written = lambda s: "".join([f"{x:0{DIGITS}x}" for x in s.tolist()])
    return doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), written(own), written(other), float((own == other).mean()), float((own == its).mean())
