"""Sliced windows against Spark's own windows, on data where one key holds a third of the rows and values repeat."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lotwise.operators import ordered


@pytest.fixture
def rows(many_slices):
    spark = many_slices
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 41).cast("string")))
    value = F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") * 7919 % 97).cast("int"))
    df = spark.range(0, 3000, 1, 6).select("id", F.when(F.col("id") % 50 != 0, key).alias("key"), value.alias("value"))
    return df


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    names = sorted(left.columns)
    take = lambda df: sorted(map(repr, df.select(*names).collect()))
    assert take(left) == take(right)


def native(order):
    return ordered.sort_columns(order)


def test_slices_split_the_hot_key(rows):
    cut = ordered.slices(rows, ["key"], ["value", "id"])
    held = cut.where("key = 'hot'").select(ordered.SLICE).distinct().count()
    assert held > 1


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("order", [["value", "id"], ["-value", "-id"]])
def test_row_numbers(rows, keys, order):
    w = Window.partitionBy(*keys).orderBy(*native(order))
    same(ordered.row_numbers(rows, keys, order, "n"), rows.withColumn("n", F.row_number().over(w).cast("bigint")))


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("step", [1, 7, 1000])
def test_row_frames_by_slice(rows, keys, step):
    order = ["value", "id"]

    def columns(w):
        return {"back": F.lag("id", 3).over(w), "ahead": F.lead("id", 2).over(w), "sum": F.sum("id").over(w.rowsBetween(-3, 2))}

    mine = ordered.row_frames(rows, keys, order, columns, before=3, after=2, slice_of=F.expr(f"value * value div {step}"))
    same(mine, rows.withColumns(columns(Window.partitionBy(*keys).orderBy(*native(order)))))


def test_one_shuffle_of_the_table(rows):
    framed = ordered.row_frames(rows, ["key"], ["id"], lambda w: {"p": F.lag("value").over(w)}, before=1, slice_of=F.expr("id div 100"))
    plan = framed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    # The other shuffles carry what a limit per slice has left over.
    assert plan.count("Exchange hashpartitioning") - plan.count("WindowGroupLimit") // 2 <= 4


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_running_totals(rows, keys):
    w = Window.partitionBy(*keys).orderBy(*native(["value", "id"])).rowsBetween(Window.unboundedPreceding, 0)
    weight = F.coalesce("value", F.lit(0)).cast("bigint")
    mine = ordered.running_totals(rows, keys, ["value", "id"], {"t": weight, "n": F.lit(1).cast("bigint")})
    same(mine, rows.withColumn("t", F.sum(weight).over(w)).withColumn("n", F.count("*").over(w)))


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("descending", [True, False])
def test_ranks(rows, keys, descending):
    w = Window.partitionBy(*keys).orderBy(*native(["-value" if descending else "value"]))
    expected = rows.withColumn("position", F.rank().over(w).cast("bigint")).withColumn(
        "dense_position", F.dense_rank().over(w).cast("bigint")
    )
    same(ordered.with_ranks(rows, keys, "value", descending), expected)


@pytest.mark.parametrize("count", [1, 4, 7, 5000])
def test_tiles(rows, count):
    w = Window.orderBy(*native(["-value", "id"]))
    same(ordered.tiles(rows, ["-value", "id"], count, "t"), rows.withColumn("t", F.ntile(count).over(w).cast("bigint")))


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("before,after", [(1, 0), (0, 1), (2, 3), (40, 0)])
def test_row_frames(rows, keys, before, after):
    def columns(window):
        frame = window.rowsBetween(-before, after)
        return {
            "back": F.lag("id", max(before, 1)).over(window) if before else F.lit(0),
            "ahead": F.lead("id", max(after, 1)).over(window) if after else F.lit(0),
            "total": F.sum("id").over(frame),
            "n": F.count("*").over(frame),
        }

    mine = ordered.row_frames(rows, keys, ["value", "id"], columns, before, after)
    w = Window.partitionBy(*keys).orderBy(*native(["value", "id"]))
    same(mine, rows.withColumns(columns(w)))


def test_row_frames_over_tiny_slices(many_slices):
    few = many_slices.range(0, 5, 1, 1).select("id")
    mine = ordered.row_frames(few, [], ["id"], lambda w: {"p": F.lag("id", 3).over(w), "s": F.sum("id").over(w.rowsBetween(-3, 0))}, before=3)
    assert sorted(map(tuple, mine.collect())) == [(0, None, 0), (1, None, 1), (2, None, 3), (3, 0, 6), (4, 1, 10)]


@pytest.mark.parametrize("before,after", [(5, 5), (0, 9), (30, 0), (1000, 1000)])
def test_value_frames(rows, before, after):
    known = rows.where("value IS NOT NULL")
    w = Window.orderBy("value").rangeBetween(-before, after)
    frames = [ordered.Frame(before, after, {"n": F.count("*"), "sum": F.sum("id")}, "w_"), ordered.Frame(3, 0, {"n": F.count("*")}, "v_")]
    mine = ordered.value_frames(known, "value", frames)
    want = known.withColumn("w_n", F.count("*").over(w)).withColumn("w_sum", F.sum("id").over(w))
    same(mine, want.withColumn("v_n", F.count("*").over(Window.orderBy("value").rangeBetween(-3, 0))))


def test_value_frames_of_negative_and_far_values(many_slices):
    values = many_slices.range(-500, 500, 7, 5).selectExpr("id AS value", "1 AS one").union(many_slices.sql("SELECT * FROM VALUES (-1000000000000L, 1), (1000000000000L, 1), (NULL, 1), (NULL, 1)"))
    w = Window.orderBy("value").rangeBetween(-20, 15)
    mine = ordered.value_frames(values, "value", [ordered.Frame(20, 15, {"n": F.sum("one")}, "w_")])
    same(mine, values.withColumn("w_n", F.sum("one").over(w)))


def test_value_frames_write_nothing(many_slices):
    frames = [ordered.Frame(9, 0, {"n": F.count("*")}, "a_"), ordered.Frame(0, 9, {"n": F.count("*")}, "b_")]
    plan = ordered.value_frames(many_slices.range(100).withColumnRenamed("id", "value"), "value", frames)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Scan parquet" not in plan and "hashpartitioning(_bin" in plan


def test_empty_input(many_slices):
    none = many_slices.createDataFrame([], "id bigint, key string")
    assert ordered.row_numbers(none, [], ["id"], "n").count() == 0
    assert ordered.row_numbers(none, ["key"], ["id"], "n").count() == 0
    assert ordered.row_frames(none, ["key"], ["id"], lambda w: {"p": F.lag("id").over(w)}, before=1).count() == 0
