"""Points stored along a Z-order curve of grid cells, so that a region reads only the parts of the table near it.

A cell is a square of the given size; its number interleaves the bits of its column and row, so cells that lie together
have numbers that lie together. The table is sorted by cell, and files and row groups hold short stretches of the curve.
A circle or box is covered by a few ranges of cells, which the scan compares with the statistics of files and row groups;
the exact test follows. Points beyond the grid of 2**21 by 2**21 cells count to its border cells; points with a coordinate
that is null or not a number have no cell and lie in no region.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions.geo import in_box, in_circle

CELL = "cell"
BITS = 21
MIDDLE = 1 << (BITS - 1)
# The masks that spread the bits of a number to every second place.
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _place(value: Column, size: float) -> Column:
    at = F.least(F.greatest(value / size, F.lit(-float(MIDDLE))), F.lit(float(MIDDLE - 1)))
    return F.when(~F.isnan(value), F.floor(at).cast("bigint") + MIDDLE)


def _spread(place: Column) -> Column:
    for shift, mask in SPREAD:
        place = place.bitwiseOR(F.shiftleft(place, shift)).bitwiseAND(F.lit(mask))
    return place


def cell(x: Column, y: Column, size: float) -> Column:
    """The number of the cell of a point on the curve."""
    x, y = x.cast("double"), y.cast("double")
    return _spread(_place(x, size)).bitwiseOR(F.shiftleft(_spread(_place(y, size)), 1))


def write_points(df: DataFrame, path: str, x: str, y: str, size: float, **options) -> None:
    """Writes ``df`` with its cells, sorted by cell. Points that share a cell are spread by a hash of the row."""
    placed = df.withColumn(CELL, cell(F.col(x), F.col(y), size))
    order = [CELL, F.xxhash64(*df.columns)]
    placed.repartitionByRange(*order).sortWithinPartitions(*order).write.options(**options).parquet(path)


def cover(inside: Callable[[int, int, int, int], bool], touches: Callable[[int, int, int, int], bool], ranges: int = 48) -> list[tuple[int, int]]:
    """Ranges of cell numbers that hold all cells of a region, first and last included.

    ``inside`` and ``touches`` tell of a square of cells (first column, first row, last column, last row) whether it lies
    in the region, or may have a point of it. Squares at the border are quartered while there are few enough.
    """
    done, border = [], [(0, 0, BITS)]  # number of the square's first cell, as column and row; bits of its side
    while border and len(done) + len(border) < ranges:
        level, border = border, []
        for column, row, bits in level:
            if bits == 0:
                done.append((column, row, bits))
                continue
            half = 1 << (bits - 1)
            for left, low in ((column, row), (column + half, row), (column, row + half), (column + half, row + half)):
                square = (left, low, left + half - 1, low + half - 1)
                if touches(*square):
                    (done if inside(*square) else border).append((left, low, bits - 1))
    first = sorted((_number(column, row), bits) for column, row, bits in done + border)
    merged: list[tuple[int, int]] = []
    for start, bits in first:
        stop = start + (1 << (2 * bits)) - 1
        if merged and merged[-1][1] + 1 == start:
            start = merged.pop()[0]
        merged.append((start, stop))
    return merged


def _number(column: int, row: int) -> int:
    return sum(((column >> bit & 1) | (row >> bit & 1) << 1) << 2 * bit for bit in range(BITS))


def _cells(low: float, high: float, size: float) -> tuple[int, int]:
    """Places of the first and last cell of an interval; division and floor never swap two numbers, so none is lost."""
    return tuple(math.floor(min(max(value / size, -MIDDLE), MIDDLE - 1)) + MIDDLE for value in (low, high))


def box_ranges(corner: tuple[float, float], opposite: tuple[float, float], size: float) -> list[tuple[int, int]]:
    (left, right), (low, high) = (_cells(*sorted(pair), size) for pair in zip(corner, opposite))

    def inside(a: int, b: int, c: int, d: int) -> bool:
        return left <= a and c <= right and low <= b and d <= high

    def touches(a: int, b: int, c: int, d: int) -> bool:
        return a <= right and left <= c and b <= high and low <= d

    return cover(inside, touches)


def circle_ranges(centre: tuple[float, float], radius: float, size: float) -> list[tuple[int, int]]:
    (x, y), last = centre, (1 << BITS) - 1
    slack = 1e-9 * (radius + size + abs(x) + abs(y))

    def edges(first: int, stop: int) -> tuple[float, float]:
        """Coordinates of a stretch of cells; border cells reach to infinity."""
        return (-math.inf if first == 0 else (first - MIDDLE) * size), (math.inf if stop == last else (stop + 1 - MIDDLE) * size)

    def touches(a: int, b: int, c: int, d: int) -> bool:
        (left, right), (low, high) = edges(a, c), edges(b, d)
        return math.hypot(max(left - x, 0.0, x - right), max(low - y, 0.0, y - high)) <= radius + slack

    def inside(a: int, b: int, c: int, d: int) -> bool:
        (left, right), (low, high) = edges(a, c), edges(b, d)
        return math.hypot(max(x - left, right - x), max(y - low, high - y)) <= radius

    return cover(inside, touches)


def _near(points: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    wanted = F.lit(False)
    for start, stop in ranges:
        wanted = wanted | F.col(CELL).between(start, stop)
    return points.where(wanted)


def points_in_box(spark: SparkSession, path: str, x: str, y: str, size: float, corner: tuple[float, float], opposite: tuple[float, float]) -> DataFrame:
    near = _near(spark.read.parquet(path), box_ranges(corner, opposite, size))
    return near.where(in_box(F.col(x), F.col(y), corner, opposite)).drop(CELL)


def points_in_circle(spark: SparkSession, path: str, x: str, y: str, size: float, centre: tuple[float, float], radius: float) -> DataFrame:
    near = _near(spark.read.parquet(path), circle_ranges(centre, radius, size))
    return near.where(in_circle(F.col(x), F.col(y), centre, radius)).drop(CELL)
