"""Time-series reads: trailing windows, counter rates, last values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.operators.change import keep_one
from lotwise.operators.ordered import day_of, row_frames


def trailing(rows: DataFrame, time: str, as_of: Column, span: str) -> DataFrame:
    """Rows of the last ``span`` before ``as_of``."""
    return rows.where(F.col(time) >= as_of - F.expr(f"interval {span}"))


def increases(samples: DataFrame, series: Sequence[str], time: str, key: str, value: str) -> DataFrame:
    """Growth of each counter since its previous sample; a counter that fell has restarted from zero."""
    paired = row_frames(samples, series, [time, key], lambda w: {"_prev": F.lag(value).over(w)}, before=1, slice_of=day_of(time))
    grown = (
        F.when(F.col("_prev").isNull(), F.lit(0))
        .when(F.col(value) < F.col("_prev"), F.col(value))
        .otherwise(F.col(value) - F.col("_prev"))
    )
    return paired.withColumn("increase", grown).drop("_prev")


def sliding_growth(grown: DataFrame, keys: Sequence[str], time: str, span: int = 300, step: int = 15) -> DataFrame:
    """Growth in windows of ``span`` seconds that start every ``step`` seconds, summed per key.

    Growth is added up per step before each step is dealt to the windows that contain it.
    """
    second = F.unix_timestamp(F.col(time).cast("timestamp"))
    per_step = grown.groupBy(*keys, (F.floor(second / step) * step).alias("_step")).agg(F.sum("increase").alias("_sum"))
    back = F.explode(F.array(*[F.lit(i * step) for i in range(span // step)]))
    dealt = per_step.withColumn("_back", back).withColumn("window_start", F.col("_step") - F.col("_back"))
    return dealt.groupBy(*keys, "window_start").agg(F.sum("_sum").alias("growth"))


def sliding_rates(
    grown: DataFrame, keys: Sequence[str], time: str, span: int = 300, step: int = 15, unit: int = 1
) -> DataFrame:
    """Growth per second in the same windows; a counter in cents has ``unit`` 100."""
    growth = sliding_growth(grown, keys, time, span, step)
    return growth.select(*keys, "window_start", (F.col("growth").cast("double") / unit / span).alias("rate"))


def mean_rates(
    grown: DataFrame, series: Sequence[str], time: str, span: int = 300, step: int = 15, unit: int = 1
) -> DataFrame:
    """Mean over the series of their growth per second. Growth is added exactly and divided once.

    A series is counted in a window once: by the first of its steps there. A step is the first one in the windows that do
    not reach back to the step before it, so steps are counted by how many windows these are, and only the counts, which do
    not grow with the number of series, are dealt to windows.
    """
    second = F.unix_timestamp(F.col(time).cast("timestamp"))
    per_step = grown.groupBy(*series, (F.floor(second / step) * step).alias("_step")).agg(F.sum("increase").alias("_sum"))
    placed = row_frames(per_step, series, ["_step"], lambda w: {"_before": F.lag("_step").over(w)}, before=1)
    windows = span // step
    fresh = F.when(F.col("_step").isNull(), 1).otherwise(F.coalesce(F.least(F.expr(f"(_step - _before) div {step}"), F.lit(windows)), F.lit(windows)))
    counted = placed.groupBy("_step", fresh.alias("_fresh")).agg(F.sum("_sum").alias("_sum"), F.count("*").alias("_n"))
    dealt = counted.withColumn("_back", F.explode(F.array(*[F.lit(i) for i in range(windows)])))
    dealt = dealt.groupBy((F.col("_step") - F.col("_back") * step).alias("window_start"))
    sums = dealt.agg(F.sum("_sum").cast("double").alias("_all"), F.sum(F.when(F.col("_back") < F.col("_fresh"), F.col("_n")).otherwise(0)).alias("_series"))
    return sums.select("window_start", (F.col("_all") / unit / span / F.col("_series")).alias("mean_rate"))


def last_values(samples: DataFrame, series: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest sample of every series."""
    return keep_one(samples, series, order, last=True)
