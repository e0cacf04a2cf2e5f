"""Bands between question starts, and what lies in them; boxes against boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examloom.functions.boxes import NEAR_POINTS, Box

IMAGE_BEFORE, TABLE_BEFORE, END_SLACK = 4.0, 8.0, 1.0
FIGURE_OVERLAP, LINE_IN_FIGURE, TABLE_OWNED, SCAN_SHARE = 0.30, 0.50, 0.35, 0.55
LAST_Y = 10_000.0
REGION_PAD, LEAST_IMAGE, MOST_OF_PAGE = 12.0, 2_500.0, 0.45
MOST_BOXES = 100_000
STRIP_INSET, STRIP_ABOVE, STRIP_BELOW = 36.0, 6.0, 16.0


def bands(starts: DataFrame, paper: str = "paper_id", final_page: Column | None = None) -> DataFrame:
    """``starts`` (number, page, y0) with page_end and y_end: where the next start begins; the last ends on the final page, or the page of its own start."""
    by = Window.partitionBy(paper).orderBy("page", "y0", "number")
    end = F.coalesce(F.lead("page").over(by), F.col("page") if final_page is None else final_page)
    return starts.withColumns({"page_end": end, "y_end": F.coalesce(F.lead("y0").over(by), F.lit(LAST_Y))})


def owners(starts: DataFrame, points: DataFrame, paper: str = "paper_id", before: float = IMAGE_BEFORE) -> DataFrame:
    """``points`` (page, y) with ``owner``, the number of the start whose band they lie in; null before the first.

    A band begins ``before`` points above its start and ends ``END_SLACK``
    above the next; where bands overlap the earlier one wins, so only the first
    start of a paper really reaches up that far. Starts and points are merged
    and the last start carried down: one shuffle on the paper and no range
    join. Bands end on the page of the last point.
    """
    first = F.row_number().over(Window.partitionBy(paper).orderBy("page", "y0", "number")) == 1
    cut = F.col("y0") - F.when(first, F.lit(before)).otherwise(F.lit(END_SLACK))
    names = points.columns
    payload = F.struct(*names)
    begins = starts.select(paper, F.col("page").alias("__page"), cut.alias("__y"), F.col("number").alias("__number"), F.lit(None).cast(points.select(payload.alias("p")).schema["p"].dataType).alias("__point"))
    merged = begins.unionByName(points.select(paper, F.col("page").alias("__page"), F.col("y").alias("__y"), F.lit(None).cast(starts.schema["number"].dataType).alias("__number"), payload.alias("__point")))
    # A start comes before points at its own height; of starts at one height the last one owns what follows.
    by = Window.partitionBy(paper).orderBy("__page", "__y", F.col("__point").isNotNull(), "__number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = merged.withColumn("owner", F.last("__number", ignorenulls=True).over(by)).where(F.col("__point").isNotNull())
    return owned.select("__point.*", "owner")


def in_bands(starts: DataFrame, items: DataFrame, paper: str = "paper_id", before: float = TABLE_BEFORE, end_slack: float = END_SLACK) -> DataFrame:
    """Every pair of a band and an item (page, y) in it: here an item may lie in two bands. ``starts`` has page_end and y_end."""
    s = starts.select(paper, "number", F.col("page").alias("page_start"), F.col("y0").alias("y_start"), "page_end", "y_end")
    page, y = F.col("page"), F.col("y")
    inside = (page > F.col("page_start")) | ((page == F.col("page_start")) & (y >= F.col("y_start") - before))
    inside &= (page < F.col("page_end")) | ((page == F.col("page_end")) & (y < F.col("y_end") - end_slack))
    return items.join(s, paper).where(inside).select(*items.columns, "number")


def pairs(left: DataFrame, right: DataFrame, keys: list[str], condition, how: str = "inner") -> DataFrame:
    """Joins boxes of the same page, say, on a condition of both. Both have x0 to y1; columns of the right get the prefix ``r_``."""
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    same = F.lit(True)
    for k in keys:
        same &= F.col(k) == F.col(f"r_{k}")
    return left.join(r, same & condition(Box.named(""), Box.named("r_")), how)


def tables_off_figures(tables: DataFrame, images: DataFrame, keys: list[str], share: float = FIGURE_OVERLAP) -> DataFrame:
    """Tables that share less than a part with every image of their page, measured on table and on image."""
    over = lambda t, i: (t.shared_ratio(i) >= share) | (i.shared_ratio(t) >= share)
    return pairs(tables, images, keys, over, "left_anti")


def lines_off_figures(lines: DataFrame, images: DataFrame, keys: list[str], share: float = LINE_IN_FIGURE) -> DataFrame:
    """Lines that don't lie in an image with half their area or more."""
    return pairs(lines, images, keys, lambda a, b: (a.area() > 0) & (a.shared_ratio(b) >= share), "left_anti")


def not_scans(images: DataFrame, pages: DataFrame, keys: list[str], share: float = SCAN_SHARE) -> DataFrame:
    """Images that cover no more than a share of their page."""
    p = pages.select(*keys, (F.col("width") * F.col("height")).alias("__page_area"))
    small = ~F.coalesce(Box.named("").area() > F.col("__page_area") * share, F.lit(False))
    return images.join(p, keys, "left").where(small).drop("__page_area")


def distinct_boxes(boxes: DataFrame, keys: list[str], order: list[str], points: float = NEAR_POINTS) -> DataFrame:
    """Boxes that lie near none kept before them, in order, within their keys.

    Being near isn't transitive, so this is a fold over a page's boxes; more
    than ``MOST_BOXES`` under one key are an error rather than an endless fold.
    """
    others = [c for c in boxes.columns if c not in keys]
    rows = F.array_sort(F.collect_list(F.struct(*order, *[c for c in others if c not in order])))

    def step(kept: Column, row: Column) -> Column:
        known = F.exists(kept, lambda k: Box.of(k).near(Box.of(row), points))
        return F.when(known, kept).otherwise(F.array_append(kept, row))

    listed = boxes.groupBy(*keys).agg(rows.alias("__rows"))
    too_many = F.raise_error(F.lit(f"more than {MOST_BOXES} boxes under one key")).cast(listed.schema["__rows"].dataType)
    listed = listed.withColumn("__rows", F.when(F.size("__rows") > MOST_BOXES, too_many).otherwise(F.col("__rows")))
    kept = F.aggregate("__rows", F.slice("__rows", 1, 0), step)
    return listed.select(*keys, F.explode(kept).alias("__row")).select(*keys, "__row.*").select(*boxes.columns)


def union_box(prefix: str = "") -> list[Column]:
    """The box around a group's boxes, as aggregates x0 to y1."""
    b = Box.named(prefix)
    return [F.min(b.x0).alias("x0"), F.min(b.y0).alias("y0"), F.max(b.x1).alias("x1"), F.max(b.y1).alias("y1")]


def tables_in_regions(regions: DataFrame, tables: DataFrame, pages: list[str]) -> DataFrame:
    """Tables that lie in a region of their page with 35 % of their area or more; neighbours' tables stay with them."""
    near = lambda r, t: r.overlaps(t, REGION_PAD) & (t.shared_area(r) / F.greatest(t.area(), F.lit(1.0)) >= TABLE_OWNED)
    return pairs(regions, tables, pages, near)


def images_in_regions(regions: DataFrame, images: DataFrame, sizes: DataFrame, pages: list[str]) -> DataFrame:
    """Images whose middle lies in a region of their page, neither tiny nor most of the page."""
    area = sizes.select(*pages, F.greatest(F.col("width") * F.col("height"), F.lit(1.0)).alias("__page_area"))
    sized = images.join(area, pages).where((Box.named("").area() >= LEAST_IMAGE) & (Box.named("").area() <= F.col("__page_area") * MOST_OF_PAGE)).drop("__page_area")
    return pairs(regions, sized, pages, lambda r, i: r.holds(*i.middle(), REGION_PAD))


def page_strips(lines: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and page the strip around its lines, padded but inside the page; strips below 8 points either way are left out."""
    around = lines.groupBy(*keys, "page").agg(*union_box()).join(sizes.select("paper_id", "page", "width", "height"), ["paper_id", "page"])
    x0 = F.greatest(F.lit(0.0), F.least(F.lit(STRIP_INSET), F.col("x0") - 8))
    x1 = F.least(F.col("width"), F.greatest(F.col("width") - STRIP_INSET, F.col("x1") + 8))
    y0, y1 = F.greatest(F.lit(0.0), F.col("y0") - STRIP_ABOVE), F.least(F.col("height"), F.col("y1") + STRIP_BELOW)
    strips = around.select(*keys, "page", x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))
    return strips.where((F.col("x1") - F.col("x0") >= 8) & (F.col("y1") - F.col("y0") >= 8))
