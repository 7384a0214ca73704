"""One place where a query key, its DataFrame program and its ANSI SQL twin meet."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lotwise.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # the tables hold times without a zone
        return self.build(Tables(spark, folder))


CATALOGUE: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if key in CATALOGUE:
            raise ValueError(f"{key} is registered twice")
        CATALOGUE[key] = Query(key, build, sql)
        return build

    return register
