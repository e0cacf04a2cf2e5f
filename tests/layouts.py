"""Builders of small layouts."""

from __future__ import annotations

from examloom import schemas
from examloom.plans.paper import Layout


class Page:
    """Collects lines, images and tables of one paper; every item gets the next position."""

    def __init__(self, spark, paper="p"):
        self.spark, self.paper, self.rows = spark, paper, {"lines": [], "images": [], "tables": []}

    def line(self, text, x=101.3, y=100.0, page=1, x1=None, block=0):
        end = x + max(12, 6 * len(text)) if x1 is None else x1
        self.rows["lines"].append((self.paper, page, len(self.rows["lines"]), text, float(x), float(y), float(end), float(y + 12), block, 0, 10.0, 0, None))
        return self

    def number(self, n, stem="", y=80.0, page=1):
        text = f"{n} {stem}" if stem else str(n)
        return self.line(text, 77.2, y, page, 400.0 if stem else 87.2, n)

    def image(self, x0, y0, x1, y1, page=1):
        self.rows["images"].append((self.paper, page, len(self.rows["images"]), float(x0), float(y0), float(x1), float(y1), 0))
        return self

    def table(self, x0, y0, x1, y1, headers, rows, page=1):
        self.rows["tables"].append((self.paper, page, len(self.rows["tables"]), float(x0), float(y0), float(x1), float(y1), headers, rows))
        return self

    def layout(self, *others):
        spark, all_ = self.spark, (self, *others)
        frame = lambda name, schema: spark.createDataFrame([r for p in all_ for r in p.rows[name]], schema)
        pages = sorted({(r[0], r[1]) for p in all_ for rows in p.rows.values() for r in rows})
        sizes = [(p, n, 595.3, 841.9, "", False) for p, n in pages]
        return Layout(frame("lines", schemas.LINES), frame("images", schemas.IMAGES), frame("tables", schemas.TABLES), spark.createDataFrame(sizes, schemas.PAGES))
