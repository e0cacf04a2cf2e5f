"""Pictures cut out of page images: figures, options and whole questions, one file for each."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions import text as tx
from examloom.sources import png

GAP = 8
SCALED = 1000.0
FAILED_CROP = "no picture"


def asset_slug(ref: Column) -> Column:
    """The beginning of a question's file names: q04 for reference 4, other references in lower case with dashes."""
    digits = ref.rlike("^[0-9]+$")
    number = F.regexp_replace(ref, "^0+(?=.)", "")
    return F.when(digits, F.concat(F.lit("q"), F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number))).otherwise(F.concat(F.lit("q"), F.regexp_replace(F.lower(ref), r"[^\p{L}\p{N}]", "-")))


def asset_name(ref: Column, role: Column, number: Column) -> Column:
    """``q04-stem-1.png``, ``q04-options.png`` or ``q04-option-b.png``."""
    return F.concat_ws("", F.concat_ws("-", asset_slug(ref), role, F.when(role != "options", F.lower(number.cast("string")))), F.lit(".png"))


def to_pixels(box: Column, page_width: Column, page_height: Column) -> Column:
    """A box in points as [ymin, xmin, ymax, xmax] of 0 to 1000, which is the same whatever the image's resolution."""
    part = lambda v, size: F.greatest(F.lit(0.0), F.least(F.lit(SCALED), v / size * SCALED))
    return F.array(part(box["y0"], page_height), part(box["x0"], page_width), part(box["y1"], page_height), part(box["x1"], page_width))


def cut_out(regions: DataFrame, images: DataFrame, padding: int = 2) -> DataFrame:
    """One picture for each (paper_id, name): png, width, height and error.

    ``regions``: paper_id, name, strip (their order), page and bbox ([ymin,
    xmin, ymax, xmax] of 0 to 1000); ``images``: paper_id, page, image (PNG).
    Several regions of one name are put below each other. A region without a
    page image, or a broken one, gives no picture but its error. Images travel
    once, to the regions of their page; regions of one name are one question's.
    """
    wanted = regions.join(images.select("paper_id", "page", "image"), ["paper_id", "page"], "left")

    def cuts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple = (None, None)
        for batch in batches:
            rows = []
            for paper, name, strip, page, bbox, image in zip(*[batch[c] for c in ("paper_id", "name", "strip", "page", "bbox", "image")]):
                try:
                    if image is None:
                        raise ValueError(FAILED_CROP)
                    if last[0] != (paper, page):
                        last = (paper, page), png.read(bytes(image))
                    pixels = last[1]
                    (h, w), (y0, x0, y1, x1) = pixels.shape[:2], (float(v) / SCALED for v in bbox)
                    part = png.cut(pixels, round(x0 * w) - padding, round(y0 * h) - padding, round(x1 * w) + padding, round(y1 * h) + padding)
                    rows.append((paper, name, strip, png.write(part), None))
                except Exception as e:  # a broken image is its own region's fault
                    rows.append((paper, name, strip, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["paper_id", "name", "strip", "png", "error"])

    parts = wanted.sortWithinPartitions("paper_id", "page").mapInPandas(cuts, "paper_id string, name string, strip int, png binary, error string")
    listed = parts.groupBy("paper_id", "name").agg(F.array_sort(F.collect_list(F.struct("strip", "png"))).alias("parts"), F.min("error").alias("error"))

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for paper, name, parts_, error in zip(*[batch[c] for c in ("paper_id", "name", "parts", "error")]):
                found = [png.read(bytes(p["png"])) for p in parts_ if p["png"] is not None]
                if error is not None or not found:
                    rows.append((paper, name, None, None, None, error or FAILED_CROP))
                    continue
                whole = found[0] if len(found) == 1 else png.stacked(found, GAP)
                rows.append((paper, name, png.write(whole), whole.shape[1], whole.shape[0], None))
            yield pd.DataFrame(rows, columns=["paper_id", "name", "png", "width", "height", "error"])

    return listed.mapInPandas(joined, "paper_id string, name string, png binary, width int, height int, error string")


def write_files(crops: DataFrame, folder: str) -> DataFrame:
    """Writes the pictures into a folder that all executors share, each as ``folder/paper/name`` with whatever stood there replaced; gives paper_id, name and path.

    The file system is Spark's own, so the folder may be a bucket: rows of
    name and content are saved by the Hadoop classes that the session has.
    """
    spark = crops.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    named = crops.where(F.col("error").isNull()).select("paper_id", "name", "png")
    rows = []
    for r in named.toLocalIterator():  # one picture at a time on the driver
        target = hadoop.Path(f"{folder}/{r['paper_id']}/{r['name']}")
        stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
        stream.write(bytes(r["png"]))
        stream.close()
        rows.append((r["paper_id"], r["name"], f"{folder}/{r['paper_id']}/{r['name']}"))
    return spark.createDataFrame(rows, "paper_id string, name string, path string")


def question_strips(strips: DataFrame, sizes: DataFrame, number: str = "question") -> DataFrame:
    """Regions for ``cut_out`` of the strips that a question's lines take up, one name for each question."""
    sized = strips.join(sizes.select("paper_id", "page", "width", "height"), ["paper_id", "page"])
    box = to_pixels(F.struct("x0", "y0", "x1", "y1"), F.col("width"), F.col("height"))
    return sized.select("paper_id", F.concat(asset_slug(F.col(number).cast("string")), F.lit(".png")).alias("name"), F.col("page").alias("strip"), "page", box.alias("bbox"))


def context_of_slice(pieces: Column) -> Column:
    """The lines of a question as context for an extractor."""
    return tx.shortened(F.array_join(pieces, "\n"), tx.CONTEXT_CHARS)
