"""Outer joins whose many-side may hold a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_many(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """LEFT JOIN where ``right`` may hold a third of its rows under one key.

    Adaptive execution cannot split the right side of a left outer join, but it can split both sides of an inner join.
    So matched rows come from an inner join, and unmatched rows from an anti join with the distinct keys.
    """
    matched = left.join(right, F.col(left_key) == F.col(right_key))
    keys = right.select(F.col(right_key).alias("_matched")).distinct()
    alone = left.join(keys, F.col(left_key) == F.col("_matched"), "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)
