"""Figures of a question: which belong to the stem and which to the options, and bands where a figure is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examloom.functions import text as tx

GROUP_GAP, TILE_GAP, LEAST_BAND, SIDE = 8.0, 30.0, 24.0, 36.0
#: Texts that stand for a picture.
PLACEHOLDERS = ("...", "…", "[diagram]", "[structure]", "<visual>", "visual")
IMAGE = "struct<page:int,y0:double,x0:double,y1:double,x1:double,block_index:int>"


def empty_option(text: Column) -> Column:
    """Blank, a placeholder, or nothing but a label."""
    t = tx.strip(F.coalesce(text, F.lit("")))
    return (t == "") | t.isin(*PLACEHOLDERS) | F.upper(t).isin("A", "B", "C", "D")


def split_images(images: Column) -> Column:
    """A question's images in reading order as (stem, options).

    The widest vertical gap divides them, the later one of equals. Two or more
    below a gap of 8 points are the options; three or more with no gap of 30
    are a first figure and tiles; without a gap of 8 all are options. One image
    alone is the stem's.
    """
    n = F.size(images)
    gaps = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct((F.get(images, i)["y0"] - F.get(images, i - 1)["y1"]).alias("gap"), i.alias("at")))
    best = F.array_max(gaps)
    above, below = F.slice(images, 1, best["at"]), F.slice(images, best["at"] + 1, n)
    none = F.slice(images, 1, 0)
    pair = lambda a, b: F.struct(a.alias("stem"), b.alias("options"))
    return (
        F.when(n <= 1, pair(images, none))
        .when((n - best["at"] >= 2) & (best["gap"] >= GROUP_GAP), pair(above, below))
        .when((best["gap"] < TILE_GAP) & (n >= 3), pair(F.slice(images, 1, 1), F.slice(images, 2, n)))
        .when(best["gap"] < GROUP_GAP, pair(none, images))
        .otherwise(pair(above, below))
    )


def merged_image(images: Column) -> Column:
    """One image around all those of the first page; null for none."""
    page = F.array_min(F.transform(images, lambda i: i["page"]))
    same = F.filter(images, lambda i: i["page"] == page)
    edge = lambda pick, name: pick(F.transform(same, lambda i: i[name]))
    box = F.struct(
        page.alias("page"),
        edge(F.array_min, "y0").alias("y0"),
        edge(F.array_min, "x0").alias("x0"),
        edge(F.array_max, "y1").alias("y1"),
        edge(F.array_max, "x1").alias("x1"),
        F.get(same, 0)["block_index"].alias("block_index"),
    ).cast(IMAGE)
    return F.when(F.size(images) > 0, box)


def promote(questions: DataFrame) -> DataFrame:
    """Questions whose options are pictures get them as one region.

    Expects stem, option_texts (A to D), option_visuals (A to D) and images
    (array of ``IMAGE``). With images, and three or more options empty or
    pictures already, all options become pictures: ``promoted`` is true and
    ``images`` holds the stem's images and then one region of the options'. A
    single image stays the stem's if the stem speaks of one and no option was a
    picture before.
    """
    ordered = F.array_sort("images")
    empty = F.size(F.filter("option_texts", empty_option))
    already = F.size(F.filter("option_visuals", lambda v: v))
    parted = split_images(ordered)
    n = F.size("images")
    stays = (n == 1) & tx.needs_visual(F.col("stem")) & (already == 0)
    chosen = (
        F.when(F.size(parted["options"]) > 0, parted)
        .when(n == 1, F.struct(F.slice(ordered, 1, 0).alias("stem"), ordered.alias("options")))
        .otherwise(F.struct(F.slice(ordered, 1, n - 1).alias("stem"), F.slice(ordered, n, 1).alias("options")))
    )
    promoted = (n > 0) & ((empty >= 3) | (already >= 3)) & ~((F.size(parted["options"]) == 0) & stays)
    regions = F.concat(chosen["stem"], F.array(merged_image(chosen["options"])))
    return questions.withColumns(
        {
            "images": F.when(promoted, regions).otherwise(F.col("images")),
            "option_texts": F.when(promoted, F.transform("option_texts", lambda t: F.lit(None).cast("string"))).otherwise(F.col("option_texts")),
            "option_visuals": F.when(promoted, F.transform("option_visuals", lambda v: F.lit(True))).otherwise(F.col("option_visuals")),
            "promoted": promoted,
        }
    )


def question_bands(questions: DataFrame, paper: str = "paper_id") -> DataFrame:
    """Questions (page_start, page_end, y0, ...) with band_page and band_y: where the next one begins; after the last the page after its end."""
    by = Window.partitionBy(paper).orderBy("page_start", "y0", "number")
    after = F.lead("page_start").over(by)
    return questions.withColumns({"band_page": F.coalesce(after, F.col("page_end") + 1), "band_y": F.when(after.isNotNull(), F.lead("y0").over(by)).otherwise(10_000.0)})


def band_figure(visual_options: Column, y0: Column, y1: Column, page: Column, band_page: Column, band_y: Column, width: Column, height: Column) -> Column:
    """A region for a figure that was not found: the question's band, below the stem if the options are pictures; null if it is lower than 24 points."""
    foot = height - 36.0
    end = F.when(band_page == page, band_y).otherwise(foot)
    low, high = y1 + 4.0, F.when(band_page == page, band_y - 2.0).otherwise(foot)
    below = visual_options & (high - low >= 40)
    top = F.greatest(F.lit(0.0), F.when(below, low).otherwise(y0))
    bottom = F.least(F.when(below, high).otherwise(end), height - 8.0)
    return F.when(bottom - top >= LEAST_BAND, F.struct(F.lit(SIDE).alias("x0"), top.alias("y0"), (width - SIDE).alias("x1"), bottom.alias("y1")))
