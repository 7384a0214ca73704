"""Multi-level aggregates and strings gathered from groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.operators.copies import steps
from lotwise.operators.ordered import joined_null_safe, running_totals


def _levels(
    df: DataFrame,
    labels: Mapping[str, str],
    sums: Mapping[str, Column],
    lows: Mapping[str, Column],
    highs: Mapping[str, Column],
    method: str,
) -> DataFrame:
    """Aggregates to the finest level first, so only those rows are repeated for the upper levels.

    Totals carry their label; a real null stays null, which GROUPING() tells apart.
    """
    finest = df.groupBy(*labels).agg(
        *[column.alias(name) for named in (sums, lows, highs) for name, column in named.items()]
    )
    again = (
        [F.sum(name).alias(name) for name in sums]
        + [F.min(name).alias(name) for name in lows]
        + [F.max(name).alias(name) for name in highs]
        + [F.grouping(key).alias(f"_g_{key}") for key in labels]
    )
    leveled = getattr(finest, method)(*labels).agg(*again)
    return leveled.select(
        *[F.when(F.col(f"_g_{key}") == 1, F.lit(label)).otherwise(F.col(key)).alias(key) for key, label in labels.items()],
        *sums,
        *lows,
        *highs,
    )


def rollup_of(df, labels, sums, lows=None, highs=None) -> DataFrame:
    return _levels(df, labels, sums, lows or {}, highs or {}, "rollup")


def cube_of(df, labels, sums, lows=None, highs=None) -> DataFrame:
    return _levels(df, labels, sums, lows or {}, highs or {}, "cube")


def joined_segments(
    df: DataFrame, key: str, entry: str, separator: str, length: int, count: Column | None = None
) -> DataFrame:
    """STRING_AGG(entry ORDER BY entry) per key, in numbered segments of ``length`` entries.

    The string of a large group does not fit one cell or one task; its segments, read in order, are that string.
    Equal entries are counted first, then placed by running totals, and each count is dealt out to its segments.
    ``count`` is the aggregate that counts them where ``df`` already holds counted rows. Null entries take no part.
    """
    counted = df.where(F.col(entry).isNotNull()).groupBy(key, entry).agg((F.count("*") if count is None else count).alias("_n"))
    placed = running_totals(counted, [key], [entry], {"_end": F.col("_n")})
    begin, end = F.col("_end") - F.col("_n"), F.col("_end")
    first, last = F.expr(f"(_end - _n) DIV {length}"), F.expr(f"(_end - 1) DIV {length}")
    parts = steps(placed, first, last, "segment")
    copies = F.least(end, (F.col("segment") + 1) * length) - F.greatest(begin, F.col("segment") * length)
    pieces = parts.select(
        key,
        "segment",
        entry,
        copies.alias("_copies"),
        F.array_join(F.array_repeat(F.col(entry), copies.cast("int")), separator).alias("_piece"),
    )
    return pieces.groupBy(key, "segment").agg(
        F.sum("_copies").alias("entries"),
        F.expr(f"listagg(_piece, '{separator}') WITHIN GROUP (ORDER BY {entry})").alias("text"),
    )


def distinct_pairs(df: DataFrame, key: str, **columns: str) -> DataFrame:
    """Per key the number of distinct values of several columns, each counted on its own.

    Counting them in one aggregate copies every row once per column before the shuffle. Here each column's distinct
    (key, value) pairs are combined in the tasks that read them, and only the counts are joined.
    """
    counts = None
    for name, column in columns.items():
        pairs = df.select(key, column).distinct()
        found = pairs.groupBy(key).agg(F.count(column).alias(name))
        counts = found if counts is None else joined_null_safe(counts, found, [key])
    return counts


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, name: str, precision: int = 12) -> DataFrame:
    """A sketch of the distinct values of each group: at most one row per group and task reaches the shuffle.

    ``precision`` p gives a standard error of about 0.8 / sqrt(2**p) after any number of merges, and sketches of 2**p
    bytes at most.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, precision).alias(name))


def distinct_estimates(sketches: DataFrame, keys: Sequence[str], sketch: str, name: str) -> DataFrame:
    """Distinct values of coarser groups, from the sketches of finer ones: days make any span, parts make a whole."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(name))
