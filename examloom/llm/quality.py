"""Quality classifier by compression (operator 6).

Two zstandard dictionaries are built, from texts labelled good and bad; lines
that texts of both labels share are left out of them. A text is compressed with
either, in blocks that share no history, so that the dictionaries count through
the whole text. The difference of the compressed sizes is normalised by the
length of the text, with a few bytes added so that short texts say little, and
turned into a probability by a logistic curve, whose bias may differ for short
texts. The curve is fitted on labelled rows the dictionaries have not seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common


@dataclass(frozen=True)
class Settings:
    """Bytes of a block, bytes of a dictionary, compression level, bytes added to a text's length when its difference is normalised, whether lines of both labels are left out of the dictionaries, and whether shortness is an input of the curve."""

    block: int = 500
    dictionary: int = 65_536
    level: int = 3
    damping: int = 256
    own_lines: bool = True
    short: bool = True


SETTINGS = Settings()
#: Bounds of the sample that is fitted on the driver: rows of each label, and the longest text in it.
SAMPLE_ROWS = 1_500
SAMPLE_TEXT_BYTES = 32_768
#: Blocks of a dictionary's texts that train it, at most; more are thinned evenly.
SAMPLE_BLOCKS = 4_000


@dataclass(frozen=True)
class Model:
    """Dictionaries and the curve score = 1 / (1 + exp(-(bias + slope * difference + short * shortness))). Without dictionaries the score is a constant."""

    good: bytes
    bad: bytes
    bias: float
    slope: float
    short: float
    settings: Settings = SETTINGS


def blocks(data: bytes, size: int) -> list[bytes]:
    return [data[i : i + size] for i in range(0, len(data), size)]


def dictionary(texts: Sequence[bytes], settings: Settings) -> bytes:
    """A trained dictionary; where there is too little text to train one, the text itself."""
    import zstandard

    samples = [b for t in texts for b in blocks(t, settings.block)]
    if not samples:
        return b""
    samples = samples[:: max(1, len(samples) // SAMPLE_BLOCKS)]
    try:
        return zstandard.train_dictionary(settings.dictionary, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-settings.dictionary :]


class Scorer:
    """Compressors of one model."""

    def __init__(self, model: Model):
        import zstandard

        self.model, level = model, model.settings.level
        self.pair = None
        if model.good and model.bad:
            self.pair = []
            for content in (model.good, model.bad):
                d = zstandard.ZstdCompressionDict(content)
                d.precompute_compress(level=level)
                self.pair.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_dict_id=False).compress)

    def features(self, data: bytes) -> tuple[float, float]:
        """The normalised difference (bytes saved by the good dictionary over the bad one) and shortness, 1 for no text and near 0 for long ones."""
        settings = self.model.settings
        n = len(data) + settings.damping
        shortness = settings.damping / n if settings.short and n else 0.0
        if self.pair is None or not data:
            return 0.0, shortness
        good, bad = self.pair
        return sum(len(bad(b)) - len(good(b)) for b in blocks(data, settings.block)) / n, shortness

    def score(self, text: str | None) -> float:
        difference, shortness = self.features((text or "").encode())
        z = self.model.bias + self.model.slope * difference + self.model.short * shortness
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _own_lines(texts: Sequence[bytes], shared: set[bytes]) -> list[bytes]:
    return [b"\n".join(line for line in t.split(b"\n") if line not in shared) for t in texts]


def _curve(points: Sequence[tuple[tuple[float, float], int]], start: float) -> tuple[float, float, float]:
    """Bias and two slopes by Newton's method on scaled features, with a slight pull of the slopes to zero."""
    import numpy as np

    x = np.array([p for p, _ in points])
    y = np.array([y for _, y in points], float)
    mean, scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
    design = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    pull = np.diag([1e-9, 1e-2, 1.0])
    w = np.array([start, 0.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + pull, design.T @ (p - y) + pull @ w)
        w = w - step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[1:] / scale
    return float(w[0] - (slopes * mean).sum()), float(slopes[0]), float(slopes[1])


def fit(rows: Sequence[tuple[str, int]], settings: Settings = SETTINGS) -> Model:
    """A model from (text, label) rows: every other row of a label builds its dictionary, the rest fit the curve."""
    by_label = [[t.encode() for t, y in rows if y == label and t] for label in (0, 1)]
    rate = (len(by_label[1]) + 1) / (len(by_label[0]) + len(by_label[1]) + 2)
    bias = math.log(rate / (1 - rate))
    if not all(by_label):
        return Model(b"", b"", bias, 0.0, 0.0, settings)
    bad_lines, good_lines = ({line for t in texts for line in t.split(b"\n")} for texts in by_label)
    shared = bad_lines & good_lines if settings.own_lines else set()
    bad, good = (dictionary(_own_lines(texts[::2], shared), settings) for texts in by_label)
    scorer = Scorer(Model(good, bad, 0.0, 1.0, 0.0, settings))
    points = [(scorer.features(t), label) for label, texts in enumerate(by_label) for t in (texts[1::2] or texts)]
    return Model(good, bad, *_curve(points, bias), settings)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; 1 marks the rows that no model may learn from."""
    return F.crc32(doc_id.cast("string")) % 3


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model from labelled documents outside the held-out third.

    At most ``SAMPLE_ROWS`` ids of each label, those of the smallest hash, are
    fetched, and of these texts the ones of at most ``SAMPLE_TEXT_BYTES``: the
    sample is bounded whatever the tables' sizes. Ids labelled both ways or
    with null are left out. With no rows of one label every score is a
    constant.
    """
    agreed = (
        labels.select(common.col(id_col).alias("id"), common.col(label_col).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & (remainder(F.col("id")) != 1))
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where(F.col("label") == F.col("most"))
    )
    chosen = {}
    for label in (0, 1):
        for r in agreed.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).collect():
            chosen[r["id"]] = label
    if not chosen:
        return fit([])
    ids = docs.sparkSession.createDataFrame([(i,) for i in chosen], docs.select(common.col(id_col).alias("id")).schema)
    texts = (
        docs.select(common.col(id_col).alias("id"), common.col(text_col).alias("text"))
        .where(F.octet_length("text").between(1, SAMPLE_TEXT_BYTES))
        .join(F.broadcast(ids), "id", "left_semi")  # at most 2 * SAMPLE_ROWS ids
        .groupBy("id")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    return fit([(r["text"], chosen[r["id"]]) for r in sorted(texts, key=lambda r: r["id"])])


def score(df: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``df`` with the probability that a text is good as ``out_col``; a column of that name is replaced.

    Whole texts are compressed. A null or empty text has difference zero and
    gets the curve's value there; repeated rows are scored each alike; an
    empty table stays empty; other columns pass through and are never inputs.
    """

    @F.pandas_udf(T.DoubleType())
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        common.free_tables()
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return df.withColumn(out_col, scores(common.col(text_col)))
