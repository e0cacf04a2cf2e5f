"""Boxes with corners x0, y0 (top left) and x1, y1, as Column expressions. Edges belong to a box."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_SIDE = 4.0
NEAR_POINTS = 6.0


@dataclass(frozen=True)
class Box:
    x0: Column
    y0: Column
    x1: Column
    y1: Column

    @classmethod
    def of(cls, c: Column) -> Box:
        """The box of a struct column."""
        return cls(c["x0"], c["y0"], c["x1"], c["y1"])

    @classmethod
    def named(cls, prefix: str) -> Box:
        """The box of four columns that begin alike."""
        return cls(*[F.col(f"{prefix}{n}") for n in ("x0", "y0", "x1", "y1")])

    def area(self) -> Column:
        return F.greatest(F.lit(0.0), self.x1 - self.x0) * F.greatest(F.lit(0.0), self.y1 - self.y0)

    def middle(self) -> tuple[Column, Column]:
        return (self.x0 + self.x1) / 2, (self.y0 + self.y1) / 2

    def overlaps(self, other: Box, pad: float = 0.0) -> Column:
        """Boxes that touch overlap; ``pad`` points are allowed between them."""
        return ~((self.x1 + pad < other.x0) | (other.x1 + pad < self.x0) | (self.y1 + pad < other.y0) | (other.y1 + pad < self.y0))

    def shared_area(self, other: Box) -> Column:
        wide = F.least(self.x1, other.x1) - F.greatest(self.x0, other.x0)
        high = F.least(self.y1, other.y1) - F.greatest(self.y0, other.y0)
        return F.greatest(F.lit(0.0), wide) * F.greatest(F.lit(0.0), high)

    def shared_ratio(self, other: Box) -> Column:
        """The shared area as part of this box; 0 if this box has none."""
        return F.when(self.area() > 0, self.shared_area(other) / self.area()).otherwise(F.lit(0.0))

    def holds(self, x: Column, y: Column, pad: float = 0.0) -> Column:
        return x.between(self.x0 - pad, self.x1 + pad) & y.between(self.y0 - pad, self.y1 + pad)

    def near(self, other: Box, points: float = NEAR_POINTS) -> Column:
        """All four edges lie within so many points."""
        pairs = ((self.x0, other.x0), (self.y0, other.y0), (self.x1, other.x1), (self.y1, other.y1))
        close = F.lit(True)
        for a, b in pairs:
            close &= F.abs(a - b) <= points
        return close


def norm_to_pixels(ymin: Column, xmin: Column, ymax: Column, xmax: Column, width: Column, height: Column, padding: int = 2) -> Column:
    """A 0-1000 box to whole pixels (left, upper, right, lower) inside the image, at least one pixel each way. Halves round to even."""
    at = lambda v, size: F.bround(v / 1000.0 * size).cast("long")
    left = F.greatest(F.lit(0), F.least(at(xmin, width) - padding, width - 1))
    upper = F.greatest(F.lit(0), F.least(at(ymin, height) - padding, height - 1))
    right = F.greatest(left + 1, F.least(at(xmax, width) + padding, width))
    lower = F.greatest(upper + 1, F.least(at(ymax, height) + padding, height))
    return F.struct(*[c.cast("long").alias(n) for c, n in ((left, "left"), (upper, "upper"), (right, "right"), (lower, "lower"))])


def norm_to_layout(box: Column, width: Column, height: Column) -> Column:
    """[ymin, xmin, ymax, xmax] of 0-1000 to layout points, whole numbers taken; null unless four values make a box of at least 4 points."""
    part = lambda i, size: F.greatest(F.lit(0.0), F.least(size, F.element_at(box, i).cast("long") / 1000 * size))
    y0, x0, y1, x1 = part(1, height), part(2, width), part(3, height), part(4, width)
    big = (F.size(box) == 4) & (x1 - x0 >= MIN_SIDE) & (y1 - y0 >= MIN_SIDE)
    return F.when(big, F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))


def from_bottom_left(left: Column, top: Column, right: Column, bottom: Column, page_height: Column) -> Column:
    """A box whose y grows upwards, turned over."""
    a, b = page_height - top, page_height - bottom
    return F.struct(F.least(left, right).alias("x0"), F.least(a, b).alias("y0"), F.greatest(left, right).alias("x1"), F.greatest(a, b).alias("y1"))
