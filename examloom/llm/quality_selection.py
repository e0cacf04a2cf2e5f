"""Chooses the settings of the quality classifier from labelled rows that may be learnt from.

    python -m examloom.llm.quality_selection FOLDER...

Of the learnable rows of each folder's ``documents`` and ``labels`` (``quality.remainder`` 0 or 2),
those of remainder 0 fit a model for every setting and those of remainder 2
compare the settings; rows of remainder 1 are never read. One setting is varied
at a time, the best value kept: wrong rows, then log loss, summed over the folders.
"""

from __future__ import annotations

import math
import sys
import zlib
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import common, quality

VALUES = {
    "short": (False, True),
    "own_lines": (False, True),
    "block": (500, 1000, 2000, 4000),
    "dictionary": (32_768, 65_536, 114_688),
    "level": (1, 3, 6),
    "damping": (16, 64, 256),
}
FIRST = quality.Settings(block=2000, dictionary=65_536, level=3, damping=64, own_lines=False, short=False)


def rows(spark: SparkSession, folder: str) -> tuple[list, list]:
    """(text, label) of remainder 0, at most ``SAMPLE_ROWS`` of each label as in ``learn``, and of remainder 2, at most four times as many."""
    labels = common.table(spark, folder, "labels").select("doc_id", "quality").where(quality.remainder(F.col("doc_id")) != 1)
    found = common.table(spark, folder, "documents").join(labels, "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("y"))
    found = found.where(F.octet_length("text").between(1, quality.SAMPLE_TEXT_BYTES)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(12 * quality.SAMPLE_ROWS)
    parts = {0: [], 2: []}
    for r in found.collect():
        parts[zlib.crc32(str(r["doc_id"]).encode()) % 3].append((r["text"], r["y"]))
    fitted = [x for y in (0, 1) for x in [r for r in parts[0] if r[1] == y][: quality.SAMPLE_ROWS]]
    return fitted, parts[2][: 4 * quality.SAMPLE_ROWS]


def cost(settings: quality.Settings, folders: list[tuple[list, list]]) -> tuple[int, float]:
    wrong, loss = 0, 0.0
    for fitted, compared in folders:
        scorer = quality.Scorer(quality.fit(fitted, settings))
        for text, y in compared:
            p = min(max(scorer.score(text), 1e-9), 1 - 1e-9)
            wrong += (p >= 0.5) != bool(y)
            loss -= math.log(p if y else 1 - p)
    return wrong, loss


def main(paths: list[str]) -> None:
    spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
    folders = [rows(spark, p) for p in paths]
    spark.stop()
    print("rows that compare:", sum(len(c) for _, c in folders))
    best, tried = FIRST, {FIRST: cost(FIRST, folders)}
    for name, values in VALUES.items():
        for v in values:
            s = replace(best, **{name: v})
            if s not in tried:
                tried[s] = cost(s, folders)
            print(len(tried), name, v, tried[s], flush=True)
        best = min(tried, key=tried.get)
    print("settings tried:", len(tried))
    print("chosen:", best, tried[best])


if __name__ == "__main__":
    main(sys.argv[1:])
