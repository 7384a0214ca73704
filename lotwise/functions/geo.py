"""Points as two numeric columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_box(x: Column, y: Column, corner: tuple[float, float], opposite: tuple[float, float]) -> Column:
    """Inside a box given by any two opposite corners, borders included."""
    (x1, y1), (x2, y2) = corner, opposite
    return x.between(min(x1, x2), max(x1, x2)) & y.between(min(y1, y2), max(y1, y2))


def in_circle(x: Column, y: Column, centre: tuple[float, float], radius: float) -> Column:
    """Within ``radius`` of the centre. The box around the circle comes first: file statistics can use it."""
    cx, cy = centre
    box = in_box(x, y, (cx - radius, cy - radius), (cx + radius, cy + radius))
    return box & (F.pow(x - cx, 2) + F.pow(y - cy, 2) <= radius * radius)
