"""Boxes as four integer columns x0, y0, x1, y1: column expressions that stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = ("x0", "y0", "x1", "y1")


def box(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}{c}") for c in BOX]


def length(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0), b - a)


def area(b: list[Column]) -> Column:
    return length(b[0], b[2]) * length(b[1], b[3])


def intersection(a: list[Column], b: list[Column]) -> Column:
    return length(F.greatest(a[0], b[0]), F.least(a[2], b[2])) * length(F.greatest(a[1], b[1]), F.least(a[3], b[3]))


def overlap(a: list[Column], b: list[Column]) -> Column:
    """Share of a's area that b covers."""
    return intersection(a, b).cast("double") / F.greatest(F.lit(1), area(a))


def iou(a: list[Column], b: list[Column]) -> Column:
    both = intersection(a, b)
    return both.cast("double") / F.greatest(F.lit(1), area(a) + area(b) - both)


def containment(a: list[Column], b: list[Column]) -> Column:
    """Shared area by the smaller box's."""
    return intersection(a, b).cast("double") / F.greatest(F.lit(1), F.least(area(a), area(b)))


def axis_share(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Shared length by the shorter one's."""
    return length(F.greatest(a0, b0), F.least(a1, b1)).cast("double") / F.greatest(F.lit(1), F.least(a1 - a0, b1 - b0))


def contains(outer: list[Column], inner: list[Column]) -> Column:
    return (outer[0] <= inner[0]) & (outer[1] <= inner[1]) & (outer[2] >= inner[2]) & (outer[3] >= inner[3])


def expand(b: list[Column], x: Column | float, y: Column | float) -> list[Column]:
    return [b[0] - x, b[1] - y, b[2] + x, b[3] + y]


def percent(at: Column, whole: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), at * 100.0 / whole))


def to_pixels(points: Column, px_per_pt: Column, page_height: Column | None = None) -> Column:
    """Page points to pixels, truncated; with page_height the axis is turned round."""
    at = points if page_height is None else page_height - points
    return (at * px_per_pt).cast("int")
