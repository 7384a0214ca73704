"""Turning counted rows back into rows without a task that writes all copies of one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 100_000


def steps(df: DataFrame, first: Column, last: Column, name: str, block: int = BLOCK) -> DataFrame:
    """Each row once for every whole number from ``first`` to ``last``, as the column ``name``.

    Every span is cut into blocks, and the blocks are shuffled to different tasks before they are exploded.
    """
    bounded = df.withColumn("_from", first.cast("bigint")).withColumn("_to", last.cast("bigint")).where("_from <= _to")
    blocks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_to - _from) div {block}"))
    cut = bounded.withColumn("_block", F.explode(blocks))
    cut = cut.withColumn("_from", F.col("_from") + F.col("_block") * block)
    cut = cut.withColumn("_to", F.least(F.col("_to"), F.col("_from") + block - 1))
    spread = cut.repartition("_from", "_to", F.col("_block")).drop("_block")
    return spread.withColumn(name, F.explode(F.sequence("_from", "_to"))).drop("_from", "_to")
