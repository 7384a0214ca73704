"""Subquery forms Spark SQL lacks, built on one-row aggregates instead of nested-loop joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _summary(values: DataFrame) -> Column:
    column = F.col(values.columns[0])
    return values.agg(
        F.struct(
            F.count("*").alias("n"),
            F.count(F.when(column.isNull(), 1)).alias("nulls"),
            F.min(column).alias("low"),
            F.max(column).alias("high"),
        )
    ).scalar()


def greater_than_all(x: Column, values: DataFrame) -> Column:
    """``x > ALL (values)`` as a WHERE predicate: true for no values, never true once one of them is null."""
    s = _summary(values)
    return (s["n"] == 0) | ((s["nulls"] == 0) & (x > s["high"]))


def greater_than_any(x: Column, values: DataFrame) -> Column:
    """``x > ANY (values)`` as a WHERE predicate; nulls in ``values`` cannot make it true."""
    return x > _summary(values)["low"]


def less_than_any(x: Column, values: DataFrame) -> Column:
    return x < _summary(values)["high"]


def with_each_entry(df: DataFrame, dictionary: DataFrame, per_segment: int = 1000, salts: int = 16) -> DataFrame:
    """Every row of ``df`` paired with every entry of a dictionary (the use of CROSS JOIN on lookup tables).

    The entries are dealt into numbered segments by their hash, about ``per_segment`` in each. A row is repeated once per
    segment and meets it in an equi-join, where the segment exists in ``salts`` copies: no cell or task needs the whole
    dictionary, whatever its size, and neither side meets one task.
    """
    names = dictionary.columns
    segments = dictionary.agg(F.expr(f"CAST(count(*) div {per_segment} + 1 AS BIGINT)")).scalar()
    entries = dictionary.select(F.struct(*names).alias("_entry"), F.monotonically_increasing_id().alias("_place"))
    entries = entries.withColumn("_segment", F.pmod(F.xxhash64("_place", "_entry"), segments))
    listed = entries.groupBy("_segment").agg(F.collect_list("_entry").alias("_entries"))
    listed = listed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    rows = rows.withColumn("_segment", F.explode(F.sequence(F.lit(0).cast("bigint"), segments - 1)))
    paired = rows.join(listed, ["_segment", "_salt"]).withColumn("_entry", F.explode("_entries"))
    return paired.select(*df.columns, *[F.col(f"_entry.{name}").alias(name) for name in names])
