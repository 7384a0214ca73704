"""Rule-driven data quality: rules are conditions that must hold, checked in one pass over the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The patterns are the rules.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE = r"^\+[0-9]{10,15}$"


def written(df: DataFrame, path: str, **metrics: Column) -> dict:
    """Writes ``df`` as Parquet and returns aggregates of the rows that went into the files.

    They are collected by the tasks that write, so a gate on a load needs no second pass over its source.
    """
    seen = Observation("load")
    df.observe(seen, *[column.alias(name) for name, column in metrics.items()]).write.parquet(path)
    return seen.get


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns the schema lacks, without touching the data."""
    return sorted(set(required) - set(df.columns))


def violations(df: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """One row (key, rule) per broken rule. As with CHECK, an unknown condition passes."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(holds, F.lit(True)), F.lit(name)) for name, holds in rules.items()])
    )
    return df.select(F.col(key), F.explode(broken).alias("rule"))


def broken(df: DataFrame, holds: Column) -> DataFrame:
    """The rows themselves that break one rule."""
    return df.where(~F.coalesce(holds, F.lit(True)))


def present(column: str) -> Column:
    """The value is neither null nor blank."""
    return F.coalesce(F.trim(F.col(column)) != "", F.lit(False))


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, failed) for every rule, zero included, in one aggregate over the table."""
    counts = df.agg(
        *[F.count(F.when(~F.coalesce(holds, F.lit(True)), 1)).alias(name) for name, holds in rules.items()]
    )
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("failed")) for name in rules])
    return counts.select(F.explode(pairs).alias("_pair")).select("_pair.rule", "_pair.failed")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def orphans(children: DataFrame, parents: DataFrame, foreign_key: str, key: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent."""
    known = parents.select(F.col(key).alias("_parent"))
    return children.where(F.col(foreign_key).isNotNull()).join(known, F.col(foreign_key) == F.col("_parent"), "left_anti")


def first_failure(rules: Sequence[tuple[str, Column]], passed: str = "ok") -> Column:
    """The code of the first condition that is true, in the order given, else ``passed``."""
    result = F.lit(passed)
    for code, fails in reversed(rules):
        result = F.when(F.coalesce(fails, F.lit(False)), F.lit(code)).otherwise(result)
    return result
