"""The task queue: dispatch order, outcomes with retry, lag and throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.streaming.keyed import BACK_OFF_MINUTES, ERROR_TEXT


def dispatch_plan(tasks: DataFrame, as_of: Column, count: int) -> DataFrame:
    """The next tasks to hand out: ready and due, by priority, then age, then id."""
    due = tasks.where((F.col("status") == "Ready") & (F.col("scheduled_at") <= as_of))
    return due.orderBy(F.col("priority").desc(), "created_at", "task_id").limit(count)


def fold_outcomes(tasks: DataFrame, outcomes: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """Tasks after their outcomes (task_id, seq, at, success), in the order of ``seq``.

    Failures before the first success put the task back with one attempt more and a delay; the first success
    completes it, and anything after that is ignored. Both sums combine before the shuffle, so one task with a third
    of all outcomes is no problem. Without ``max_attempts`` retries never end.
    """
    done = outcomes.where("success").groupBy(F.col("task_id").alias("_task")).agg(F.min("seq").alias("_done"))
    known = outcomes.join(done, F.col("task_id") == F.col("_task"), "left")
    counted = known.where(~F.col("success") & (F.col("_done").isNull() | (F.col("seq") < F.col("_done"))))
    failures = counted.groupBy(F.col("task_id").alias("_failed")).agg(
        F.count("*").alias("_failures"), F.max_by("at", "seq").alias("_last")
    )
    joined = tasks.join(failures, F.col("task_id") == F.col("_failed"), "left").join(
        done, F.col("task_id") == F.col("_task"), "left"
    )
    attempts = F.col("attempts") + F.coalesce("_failures", F.lit(0))
    status = F.when(F.col("_done").isNotNull(), "Completed")
    if max_attempts is not None:
        status = status.when(attempts >= max_attempts, "Failed")
    delayed = F.col("_last") + F.expr(f"interval {BACK_OFF_MINUTES} minutes")
    return joined.select(
        "task_id",
        status.otherwise(F.col("status")).alias("status"),
        attempts.alias("attempts"),
        F.coalesce(delayed, F.col("scheduled_at")).alias("scheduled_at"),
        F.when(F.col("_failures").isNotNull(), ERROR_TEXT).otherwise(F.col("last_error")).alias("last_error"),
    )


def lag(tasks: DataFrame, as_of: Column) -> DataFrame:
    """Age in seconds of the oldest ready task, as a number and as minutes and seconds, and the number waiting."""
    ready = tasks.where("status = 'Ready'").agg(
        F.min("created_at").alias("oldest_ready"), F.count("*").alias("queue_size")
    )
    seconds = F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(F.col("oldest_ready").cast("timestamp"))
    clock = F.format_string("%02d:%02d", F.expr("lag_seconds div 60 % 60"), F.col("lag_seconds") % 60)
    return ready.withColumn("lag_seconds", seconds).withColumn("lag_text", clock)


def throughput(finished: DataFrame, time: str, seconds: int = 10) -> DataFrame:
    """Tasks per second in tumbling windows. On a stream, put a watermark on ``time`` first to bound its state."""
    windowed = finished.groupBy(F.window(time, f"{seconds} seconds").alias("_w")).agg(F.count("*").alias("tasks"))
    return windowed.select(
        F.col("_w.start").alias("window_start"), "tasks", (F.col("tasks") / seconds).alias("tasks_per_second")
    )
