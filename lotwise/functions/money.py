"""Exact money arithmetic on columns that arrive as doubles with two decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value) -> Column:
    return _col(value).cast("decimal(18,2)")


def total(value) -> Column:
    """Order-independent sum."""
    return F.sum(money(value)).cast("decimal(28,2)")


def mean(value) -> Column:
    """Exact sum divided once, so the result does not depend on the order of rows."""
    return F.sum(money(value)).cast("double") / F.count(_col(value))


def mean_rounded(value, digits: int = 2) -> Column:
    """AVG rounded half up in decimal arithmetic."""
    return F.round(F.sum(money(value)) / F.count(_col(value)), digits).cast("double")


def mean_of(total_column: str, count_column: str) -> Column:
    """The mean of sums and counts gathered in an earlier step."""
    return F.sum(total_column).cast("double") / F.sum(count_column)


def mean_of_rounded(total_column: str, count_column: str, digits: int = 2) -> Column:
    return F.round(F.sum(total_column).cast("decimal(28,2)") / F.sum(count_column), digits).cast("double")


def sql_total(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(18,2))) AS DECIMAL(28,2))"


def sql_mean(value: str) -> str:
    return f"(CAST(sum(CAST({value} AS DECIMAL(18,2))) AS DOUBLE) / count({value}))"


def sql_mean_rounded(value: str) -> str:
    """Half-up mean of a non-negative two-decimal column in integer cents."""
    cents = f"sum(CAST(round({value} * 100) AS BIGINT))"
    return f"(CAST((2 * {cents} + count({value})) // (2 * count({value})) AS BIGINT) / 100.0)"
