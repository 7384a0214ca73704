"""Ordered computations whose groups may be larger than any one task.

A window partitioned by a key sends all rows of that key to one task, and a window without keys sends the whole
table. The functions here cut the sorted table into slices by range partitioning on (keys, order), so one key can
span many slices, compute inside each slice, and correct the slice borders with a table of about one row per slice.

Sort orders are column names; a leading minus means descending. Nulls count as larger than every value, as in
PostgreSQL: last ascending, first descending.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lotwise.sources.workspace import stage

SLICE = "_slice"


def sort_columns(order: Sequence[str], backwards: bool = False) -> list[Column]:
    result = []
    for name in order:
        descending = name.startswith("-")
        column = F.col(name.lstrip("-"))
        result.append(column.desc_nulls_first() if descending != backwards else column.asc_nulls_last())
    return result


def same_row(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality on the named columns."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def joined_null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Inner join on equal names where nulls equal each other; the names appear once."""
    renamed = right.select(*[F.col(name).alias(f"_on_{name}") if name in names else F.col(name) for name in right.columns])
    on = F.lit(True)
    for name in names:
        on = on & F.col(name).eqNullSafe(F.col(f"_on_{name}"))
    return left.join(renamed, on).drop(*[f"_on_{name}" for name in names])


def slices(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` cut into range slices of (keys, order) and written once, so that every use sees the same borders.

    The number of slices follows ``spark.sql.shuffle.partitions`` and adaptive coalescing.
    """
    cut = df.repartitionByRange(*sort_columns(keys), *sort_columns(order))
    return stage(cut.withColumn(SLICE, F.spark_partition_id()), "slices")


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Adds, per key, the inclusive running sum of each (never null) measure in the given total order."""
    inputs = {name: f"_in_{name}" for name in measures}
    cut = slices(df.withColumns({inputs[name]: column for name, column in measures.items()}), keys, order)
    inside = Window.partitionBy(SLICE, *keys).orderBy(*sort_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({f"_local_{name}": F.sum(inputs[name]).over(inside) for name in measures})

    # One row per (slice, key). Only a key that continues from an earlier slice has something before it,
    # and at most one key per slice does, so the table joined back is as small as the number of slices.
    sums = cut.groupBy(SLICE, *keys).agg(*[F.sum(inputs[name]).alias(f"_sum_{name}") for name in measures])
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    first = next(iter(measures))
    offsets = (
        sums.withColumns({f"_before_{name}": F.sum(f"_sum_{name}").over(earlier) for name in measures})
        .where(F.col(f"_before_{first}").isNotNull())
        .select(
            F.col(SLICE).alias("_slice_of"),
            *[F.col(key).alias(f"_key_{key}") for key in keys],
            *[f"_before_{name}" for name in measures],
        )
    )
    on = F.col(SLICE) == F.col("_slice_of")
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return local.join(F.broadcast(offsets), on, "left").select(
        *df.columns,
        *[(F.col(f"_local_{name}") + F.coalesce(F.col(f"_before_{name}"), F.lit(0))).alias(name) for name in measures],
    )


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """ROW_NUMBER per key (or over the whole table without keys); ``order`` must be total."""
    if keys:
        return _numbers_in_groups(df, keys, order, name)
    # The slices are sorted as they are written, and the row id holds both the slice and the place in it:
    # one shuffle, no window. What is broadcast is one row per slice.
    cut = df.repartitionByRange(*sort_columns(order)).sortWithinPartitions(*sort_columns(order))
    placed = stage(cut.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    slice_of, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(slice_of.alias("_slice_of")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_slice_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice_of", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    joined = placed.join(F.broadcast(offsets), slice_of == F.col("_slice_of"))
    return joined.select(*df.columns, (F.col("_before") + place + 1).alias(name))


def _numbers_in_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """The same per key. A row's number is its place in the sorted slice, less the place where its key begins there, and
    the rows of the key in earlier slices: a table of one row for each slice and key, which Spark broadcasts if it is small.
    """
    sorted_by = [*sort_columns(keys), *sort_columns(order)]
    cut = df.repartitionByRange(*sorted_by).sortWithinPartitions(*sorted_by)
    placed = stage(cut.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    slice_of, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    of = [f"_of_{key}" for key in keys]
    groups = placed.groupBy(slice_of.alias("_slice_of"), *[F.col(key).alias(f"_of_{key}") for key in keys])
    groups = groups.agg(F.min(place).alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*of).orderBy("_slice_of").rowsBetween(Window.unboundedPreceding, -1)
    shifts = groups.select("_slice_of", *of, (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    on = slice_of == F.col("_slice_of")
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    return placed.join(shifts, on).select(*df.columns, (place + F.col("_shift") + 1).alias(name))


def ranks(df: DataFrame, keys: Sequence[str], value: str, descending: bool = True, count: Column | None = None) -> DataFrame:
    """Distinct (keys, value) rows with RANK as ``position`` and DENSE_RANK as ``dense_position``.

    Counting equal values first means a value held by a third of the rows is one row here. ``count`` is the aggregate
    that counts them where ``df`` already holds counted rows.
    """
    counted = df.groupBy(*keys, value).agg((F.count("*") if count is None else count).alias("_n"))
    measures = {"_upto": F.col("_n"), "dense_position": F.lit(1).cast("bigint")}
    summed = running_totals(counted, keys, [f"-{value}" if descending else value], measures)
    return summed.select(*keys, value, (F.col("_upto") - F.col("_n") + 1).alias("position"), "dense_position")


def with_ranks(df: DataFrame, keys: Sequence[str], value: str, descending: bool = True) -> DataFrame:
    """Every row with the RANK and DENSE_RANK of its value inside its key."""
    ranked = ranks(df, keys, value, descending)
    names = [*keys, value]
    ranked = ranked.select(*[F.col(name).alias(f"_r_{name}") for name in names], "position", "dense_position")
    on = F.lit(True)
    for name in names:
        on = on & F.col(name).eqNullSafe(F.col(f"_r_{name}"))
    return df.join(ranked, on, "inner").select(*df.columns, "position", "dense_position")


def tiles(df: DataFrame, order: Sequence[str], count: int, name: str) -> DataFrame:
    """NTILE(count) over the whole table: the first ``rows % count`` tiles hold one row more."""
    numbered = row_numbers(df, [], order, "_row").withColumn("_rows", df.agg(F.count("*")).scalar())
    numbered = numbered.withColumns({"_small": F.expr(f"_rows div {count}"), "_extra": F.col("_rows") % count})
    in_large = F.col("_extra") * (F.col("_small") + 1)
    tile = F.when(F.col("_row") <= in_large, F.expr("(_row - 1) div (_small + 1)") + 1).otherwise(
        F.col("_extra") + F.expr("(_row - 1 - _extra * (_small + 1)) div greatest(_small, 1)") + 1
    )
    return numbered.select(*df.columns, tile.alias(name))


def row_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Callable[[WindowSpec], Mapping[str, Column]],
    before: int = 0,
    after: int = 0,
    slice_of: Column | None = None,
) -> DataFrame:
    """Adds window columns that look at most ``before`` rows back and ``after`` rows ahead within a key.

    Each slice borrows that many rows from its neighbours, the window runs per slice, and the borrowed rows leave.
    ``slice_of`` is a number that grows with the first order column, such as its day; with it the slices need no sampled
    borders and no written table, and the rows are shuffled once, by key and slice.
    """
    if slice_of is not None:
        return _frames_by_slice(df, keys, order, columns, before, after, slice_of)
    cut = slices(df, keys, order)
    padded = cut.withColumn("_lent", F.lit(False))
    if before:
        padded = padded.unionByName(_neighbours(cut, keys, order, before, ahead=False))
    if after:
        padded = padded.unionByName(_neighbours(cut, keys, order, after, ahead=True))
    added = columns(Window.partitionBy(SLICE, *keys).orderBy(*sort_columns(order)))
    return padded.withColumns(added).where(~F.col("_lent")).select(*df.columns, *added)


def _frames_by_slice(df, keys, order, columns, before, after, slice_of) -> DataFrame:
    cut = df.withColumn(SLICE, slice_of)
    padded = cut.withColumn("_lent", F.lit(False))
    for rows, ahead in ((before, False), (after, True)):
        if rows:
            padded = padded.unionByName(_lent(cut, keys, order, rows, ahead))
    added = columns(Window.partitionBy(*keys, SLICE).orderBy(*sort_columns(order)))
    return padded.withColumns(added).where(~F.col("_lent")).select(*df.columns, *added)


def _lent(cut: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, ahead: bool) -> DataFrame:
    """For every slice of every key, the ``rows`` rows just before it (or after it), over empty slices, re-tagged.

    Only the last (or first) rows of each slice are needed for that; they are picked before they are shuffled.
    """
    edge = Window.partitionBy(*keys, SLICE).orderBy(*sort_columns(order, backwards=not ahead))
    edges = cut.withColumn("_edge", F.row_number().over(edge)).where(F.col("_edge") <= rows).drop("_edge")
    line = Window.partitionBy(*keys).orderBy(*sort_columns([SLICE, *order]))
    placed = edges.withColumn("_at", F.row_number().over(line))
    wanted = F.sequence(F.max("_at") + 1, F.max("_at") + rows) if ahead else F.sequence(F.min("_at") - rows, F.min("_at") - 1)
    takers = placed.groupBy(*keys, SLICE).agg(wanted.alias("_wanted"))
    takers = takers.select(*keys, F.col(SLICE).alias("_taker"), F.explode("_wanted").alias("_at"))
    lent = joined_null_safe(placed.drop(SLICE), takers, [*keys, "_at"])
    return lent.drop("_at").withColumnRenamed("_taker", SLICE).withColumn("_lent", F.lit(True))


def day_of(column: str, days: int = 1) -> Column:
    """The number of the day, or of the span of days, that a time lies in."""
    return F.expr(f"unix_date(CAST({column} AS DATE)) div {days}")


def _neighbours(cut: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, ahead: bool) -> DataFrame:
    """For every slice, the ``rows`` rows just before it (or just after it), re-tagged with that slice."""
    full = [*keys, *order]
    edge = Window.partitionBy(SLICE).orderBy(*sort_columns(full, backwards=not ahead))
    edges = cut.withColumn("_edge", F.row_number().over(edge)).where(F.col("_edge") <= rows).drop("_edge")
    # At most slices x rows rows are left, whatever the size of the table.
    placed = edges.withColumn("_at", F.row_number().over(Window.orderBy(SLICE, *sort_columns(full))))
    if ahead:
        wanted = F.sequence(F.max("_at") + 1, F.max("_at") + rows)
    else:
        wanted = F.sequence(F.min("_at") - rows, F.min("_at") - 1)
    takers = placed.groupBy(F.col(SLICE).alias("_taker")).agg(wanted.alias("_wanted"))
    takers = takers.select("_taker", F.explode("_wanted").alias("_at"))
    return (
        placed.join(takers, "_at")
        .drop("_at", SLICE)
        .withColumnRenamed("_taker", SLICE)
        .withColumn("_lent", F.lit(True))
    )


@dataclass(frozen=True)
class Frame:
    """RANGE BETWEEN ``before`` PRECEDING AND ``after`` FOLLOWING; ``measures`` are sums or counts that are never null, and
    ``ready`` prefixes their columns in the result."""

    before: int
    after: int
    measures: Mapping[str, Column]
    ready: str


#: Into so many bins the widest frame is cut.
BINS = 32


def value_frames(df: DataFrame, value: str, frames: Sequence[Frame]) -> DataFrame:
    """RANGE frames over the whole table for additive measures, several frames in one pass.

    ``value`` is an integer column (cents, days, seconds); rows where it is null are a frame of their own. A frame is the
    difference of two running totals: rows are added up per distinct value, and every value asks for the totals at the
    last position inside each frame and at the last position before it. Values lie in bins of a fixed width, a function of
    the row: one shuffle by bin, without sampled borders or a written table. Inside a bin the totals run over its distinct
    values and questions, at most a few per position of the bin whatever the number of rows; what the bins before hold is
    a running total over the bins. The work is linear however many rows a frame holds.
    """
    every = df.groupBy(value).agg(*[column.alias(f"_m{i}_{name}") for i, frame in enumerate(frames) for name, column in frame.measures.items()])
    summed = every.where(F.col(value).isNotNull())
    sums = [name for name in summed.columns if name != value]
    width = max(frame.before + frame.after for frame in frames) // BINS + 1

    def asking(position: Column, frame: int, sign: int) -> DataFrame:
        nothing = [F.lit(0).cast(summed.schema[name].dataType).alias(name) for name in sums]
        return summed.select(position.cast("bigint").alias("_at"), F.lit(1).alias("_asks"), F.col(value).alias("_value"), F.lit(frame).alias("_frame"), F.lit(sign).alias("_sign"), *nothing)

    no_value = F.lit(None).cast(summed.schema[value].dataType).alias("_value")
    line = summed.select(F.col(value).cast("bigint").alias("_at"), F.lit(0).alias("_asks"), no_value, F.lit(-1).alias("_frame"), F.lit(0).alias("_sign"), *sums)
    for i, frame in enumerate(frames):
        line = line.unionByName(asking(F.col(value) + frame.after, i, 1)).unionByName(asking(F.col(value) - frame.before - 1, i, -1))
    line = line.withColumn("_bin", F.expr(f"(_at - pmod(_at, {width})) DIV {width}"))
    inside = Window.partitionBy("_bin").orderBy("_at", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    local = line.withColumns({f"_in{name}": F.sum(name).over(inside) for name in sums}).where("_asks = 1")

    # One row per bin; their number follows the range of the values, not the rows.
    earlier = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = line.groupBy("_bin").agg(*[F.sum(name).alias(name) for name in sums])
    bins = bins.select("_bin", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_to{name}") for name in sums])
    totals = local.join(bins, "_bin")

    def framed(i: int, name: str) -> Column:
        total = F.col(f"_in_m{i}_{name}") + F.col(f"_to_m{i}_{name}")
        return F.sum(F.when(F.col("_frame") == i, F.when(F.col("_sign") == 1, total).otherwise(-total)))

    named = [(i, name, f"{frame.ready}{name}") for i, frame in enumerate(frames) for name in frame.measures]
    found = totals.groupBy("_value").agg(*[framed(i, name).alias(shown) for i, name, shown in named])
    missing = every.where(F.col(value).isNull()).select(F.col(value).alias("_value"), *[F.col(f"_m{i}_{name}").alias(shown) for i, name, shown in named])
    return df.join(found.unionByName(missing), F.col(value).eqNullSafe(F.col("_value")), "inner").drop("_value")
