"""Boxes and page geometry; a box is a struct of x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(value: Column, size: Column) -> Column:
    return F.when(size == 0, F.lit(0.0)).otherwise(value / size)


def area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.greatest(x1 - x0, F.lit(0.0)) * F.greatest(y1 - y0, F.lit(0.0))


def intersection(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    return area(F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3]))


def share_inside(line: tuple[Column, ...], region: tuple[Column, ...]) -> Column:
    """The share of a line's area inside a region; 0 for an empty line."""
    own = area(*line)
    return F.when(own <= 0, F.lit(0.0)).otherwise(intersection(line, region) / own)


def horizontal_overlap(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Common width over the smaller width."""
    small = F.least(a[2] - a[0], b[2] - b[0])
    return F.when(small <= 0, F.lit(0.0)).otherwise(F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0)) / small)


def in_band(y_ratio: Column, top: float, bottom: float) -> Column:
    """Not in a margin; the edges themselves are kept."""
    return (y_ratio >= top) & (y_ratio <= 1 - bottom)
