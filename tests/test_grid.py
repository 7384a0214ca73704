"""Points along a curve of cells: covers lose nothing, scans read little."""

import math
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lotwise.functions.geo import in_box, in_circle
from lotwise.sources import grid
from lotwise.sources.workspace import delete, layout, names, new_path


def scattered(count=4000):
    pick = random.Random(4)
    rows = [(n, pick.uniform(-5, 5), pick.gauss(0, 2)) for n in range(count)]
    rows += [(count + n, 1.0, 1.0) for n in range(count // 2)]  # a third of all at one point
    odd = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1e300, 0.5, 0.25]
    return rows + [(-1 - n, x, y) for n, (x, y) in enumerate((x, y) for x in odd for y in odd)]


@pytest.fixture(scope="module")
def points(spark):
    df = spark.createDataFrame(scattered(), "id bigint, x double, y double")
    path = new_path(spark, "points")
    grid.write_points(df, path, "x", "y", 0.25, maxRecordsPerFile=200)
    return df.cache(), path


SHAPES = [((1.0, 1.0), 0.0), ((0.0, 0.0), 0.5), ((-2.1, 0.3), 1.7), ((4.9, 0.0), 3.0), ((0.0, 0.0), 1e9), ((90.0, 0.0), 1.0)]


@pytest.mark.parametrize(("centre", "radius"), SHAPES)
def test_circles(spark, points, centre, radius):
    df, path = points
    want = df.where(in_circle(F.col("x"), F.col("y"), centre, radius))
    found = grid.points_in_circle(spark, path, "x", "y", 0.25, centre, radius)
    assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in want.collect())


@pytest.mark.parametrize(("corner", "opposite"), [((0.5, 0.25), (0.25, -1.0)), ((1, 1), (1, 1)), ((-1e9, -1e9), (1e9, 1e9)), ((3, 3), (3.1, 3.1)), ((0.0, 0.0), (0.0, 0.0))])
def test_boxes(spark, points, corner, opposite):
    df, path = points
    want = df.where(in_box(F.col("x"), F.col("y"), corner, opposite))
    found = grid.points_in_box(spark, path, "x", "y", 0.25, corner, opposite)
    assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in want.collect())


def test_plan_filters_by_cell_and_few_row_groups_match(spark, points):
    _, path = points
    found = grid.points_in_circle(spark, path, "x", "y", 0.25, (-2.0, 0.0), 0.4)
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "GreaterThanOrEqual(cell," in pushed and "LessThanOrEqual(cell," in pushed
    ranges = grid.circle_ranges((-2.0, 0.0), 0.4, 0.25)
    groups = read = 0
    for name in names(spark, path):
        file = pq.ParquetFile(f"{path}/{name}")
        for number in range(file.num_row_groups):
            group = file.metadata.row_group(number)
            cells = next(group.column(i).statistics for i in range(group.num_columns) if group.column(i).path_in_schema == "cell")
            groups += 1
            read += cells is not None and cells.has_min_max and any(cells.min <= stop and start <= cells.max for start, stop in ranges)
    assert groups > 25 and read <= groups / 5


def test_covers_are_short_and_whole():
    pick = random.Random(2)
    for _ in range(30):
        centre, radius = (pick.uniform(-9, 9), pick.uniform(-9, 9)), pick.uniform(0, 4)
        ranges = grid.circle_ranges(centre, radius, 0.1)
        assert len(ranges) < 160 and all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
        for _ in range(50):
            angle, far = pick.uniform(0, 7), radius * math.sqrt(pick.random())
            x, y = centre[0] + far * math.cos(angle), centre[1] + far * math.sin(angle)
            number = grid._number(*(math.floor(v / 0.1) + grid.MIDDLE for v in (x, y)))
            assert any(start <= number <= stop for start, stop in ranges)


def test_cells_of_columns_are_those_of_the_cover(spark):
    rows = [(x, y) for x in (-3.0, -0.1, 0.0, 0.1, 2.7, 1e12, -1e12) for y in (-0.3, 0.0, 0.2)]
    found = spark.createDataFrame(rows, "x double, y double").select("x", "y", grid.cell(F.col("x"), F.col("y"), 0.1).alias("c")).collect()
    for x, y, number in found:
        assert number == grid._number(grid._cells(x, x, 0.1)[0], grid._cells(y, y, 0.1)[0])


def test_layouts_are_made_once_and_follow_their_source(spark, tmp_path):
    source, built = str(tmp_path / "source"), []

    def write(path):
        built.append(path)
        spark.read.parquet(source).write.parquet(path)

    spark.range(5).write.parquet(source)
    first = layout(spark, "copy", [source], write)
    assert layout(spark, "copy", [source], write) == first and len(built) == 1
    assert spark.read.parquet(first).count() == 5
    spark.range(7).write.mode("append").parquet(source)
    second = layout(spark, "copy", [source], write)
    assert second != first and spark.read.parquet(second).count() == 12
    for path in (first, second):
        delete(spark, path)
