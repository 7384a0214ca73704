"""Star schema, marts and the catalogue ETL as DataFrame steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.money import mean
from lotwise.operators.change import keep_one, upsert
from lotwise.operators.ordered import row_numbers
from lotwise.sources.generate import days
from lotwise.sources.workspace import stage


def date_key(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def calendar(facts: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day from a year before the first to a year after the last date of the facts."""
    bounds = facts.agg(F.min(first).alias("low"), F.max(F.coalesce(last, first)).alias("high"))
    every = days(bounds, F.expr("low - interval 1 year"), F.expr("high + interval 1 year"))
    day, weekday = F.col("day"), F.weekday("day") + 1
    return every.select(
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "E").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
    )


def dimension(rows: DataFrame, natural_key: str, surrogate: str) -> DataFrame:
    """A dimension with a surrogate key that follows the order of the natural key, so a rerun gives the same keys.

    It is written as a table: facts join it again and again, and Spark knows the size of a written table.
    """
    return stage(row_numbers(rows, [], [natural_key], surrogate), "dimension")


def enrollment_fact(
    enrollment: DataFrame, user: DataFrame, flow: DataFrame, unit: DataFrame
) -> DataFrame:
    """Fact rows with date keys, surrogate keys and 0/1 flags; rows without a user, flow or unit drop out.

    ``enrollment`` has (id, line, user_id, flow_id, enrolled_at, dropped_at, attendance, score, status). Each join
    meets a written dimension of known size, so Spark can tell which of them to broadcast.
    """
    users = user.select(F.col("user_id").alias("_user"), "user_key")
    flows = flow.select(F.col("flow_id").alias("_flow"), "flow_key", F.col("unit_id").alias("_unit"))
    units = unit.select("unit_id", "unit_key")
    placed = enrollment.where(F.col("enrolled_at").isNotNull())
    joined = (
        placed.join(users, F.col("user_id") == F.col("_user"))
        .join(flows, F.col("flow_id") == F.col("_flow"))
        .join(units, F.col("unit_id") == F.col("_unit"))
    )
    return joined.select(
        F.col("id").alias("enrollment_id"),
        "line",
        date_key(F.col("enrolled_at")).alias("enroll_date_key"),
        F.when(F.col("dropped_at").isNotNull(), date_key(F.col("dropped_at"))).alias("drop_date_key"),
        "user_key",
        "flow_key",
        "unit_key",
        "attendance",
        "score",
        F.when(F.col("dropped_at").isNotNull(), 1).otherwise(0).alias("is_dropped"),
        F.when(F.col("status") == "completed", 1).otherwise(0).alias("is_completed"),
        F.lit(1).alias("enrollment_cnt"),
        "status",
    )


def wide_extract(enrollment: DataFrame, user: DataFrame, flow: DataFrame, unit: DataFrame) -> DataFrame:
    """The fact with the readable columns of its dimensions, as the analytical store takes it.

    Flows meet their units first, so an enrollment meets each of its dimensions once and brings the readable columns
    along. Its day needs no join: the calendar holds every day of the facts.
    """
    flows = flow.join(unit.select("unit_id", F.col("name").alias("unit_name")), "unit_id")
    flows = flows.select(F.col("flow_id").alias("_flow"), F.col("code").alias("flow_code"), F.col("title").alias("flow_title"), "unit_name", "modality")
    placed = enrollment.where(F.col("enrolled_at").isNotNull())
    joined = placed.join(user.select(F.col("user_id").alias("_user")), F.col("user_id") == F.col("_user"))
    joined = joined.join(flows, F.col("flow_id") == F.col("_flow"))
    return joined.select(
        F.col("id").alias("enrollment_id"),
        "line",
        F.to_date("enrolled_at").alias("enroll_date"),
        "flow_code",
        "flow_title",
        "unit_name",
        "modality",
        "status",
        "attendance",
        "score",
        F.when(F.col("dropped_at").isNotNull(), 1).otherwise(0).alias("is_dropped"),
        F.when(F.col("status") == "completed", 1).otherwise(0).alias("is_completed"),
        F.lit(1).alias("enrollment_cnt"),
    )


def _enrollments() -> Column:
    return F.sum("enrollment_cnt")


def daily_mart(wide: DataFrame) -> DataFrame:
    return wide.groupBy("enroll_date").agg(
        _enrollments().alias("enrollments"), mean("score").alias("avg_score"), mean("attendance").alias("avg_attendance")
    )


def popularity_mart(wide: DataFrame) -> DataFrame:
    completed = F.coalesce(F.expr("sum(enrollment_cnt) FILTER (WHERE status = 'completed')"), F.lit(0))
    dropped = F.coalesce(F.expr("sum(enrollment_cnt) FILTER (WHERE status = 'dropped')"), F.lit(0))
    sums = wide.groupBy("flow_code").agg(
        F.min("flow_title").alias("flow_title"),
        _enrollments().alias("total_enrollments"),
        completed.alias("completed_cnt"),
        dropped.alias("dropped_cnt"),
    )
    rate = F.when(F.col("total_enrollments") == 0, 0.0).otherwise(F.col("completed_cnt") / F.col("total_enrollments") * 100)
    return sums.withColumn("completion_rate", rate)


def funnel_mart(wide: DataFrame) -> DataFrame:
    """Rows per status and their share of all rows; the whole comes from the few status rows, not from the fact."""
    counts = wide.groupBy("status").agg(_enrollments().alias("cnt"))
    return counts.withColumn("pct", F.col("cnt") * F.lit(100.0) / F.sum("cnt").over(Window.partitionBy()))


def unit_mart(wide: DataFrame) -> DataFrame:
    return wide.groupBy("unit_name").agg(_enrollments().alias("enrollments"), mean("score").alias("avg_score"))


def clean_catalogue(raw: DataFrame, position: str) -> DataFrame:
    """Trimmed upper-case codes, numeric credits (null when unreadable), the last row of each code."""
    cleaned = raw.withColumns(
        {
            "code": F.upper(F.trim("code")),
            "title": F.trim("title"),
            "unit_code": F.upper(F.trim("unit_code")),
            "ects_credits": F.col("ects_credits").try_cast("double"),
        }
    )
    return keep_one(cleaned, ["code"], [F.col(position)], last=True)


def clean_rooms(raw: DataFrame, position: str) -> DataFrame:
    """Trimmed keys, defaults for missing fields, the first row of each (building, room_number)."""
    cleaned = raw.withColumns(
        {
            "building": F.trim("building"),
            "room_number": F.trim("room_number"),
            "campus": F.trim(F.coalesce("campus", F.lit(""))),
            "has_projector": F.coalesce("has_projector", F.lit(False)),
            "has_pc": F.coalesce("has_pc", F.lit(False)),
            "is_accessible": F.coalesce("is_accessible", F.lit(False)),
            "status": F.coalesce("status", F.lit("active")),
        }
    )
    return keep_one(cleaned, ["building", "room_number"], [F.col(position)])


def resolve_parent(rows: DataFrame, code: str, parents: DataFrame, parent_code: str, parent_id: str) -> DataFrame:
    """Adds the id of the parent with the same code, null if there is none; of several parents the lowest id."""
    one_each = parents.groupBy(F.col(parent_code).alias("_code")).agg(F.min(parent_id).alias(parent_id))
    return rows.join(one_each, F.col(code) == F.col("_code"), "left").drop("_code")


def log_loads(log: DataFrame, run_id: str, counts: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """The load log with the row counts of this run; logging a run again replaces its rows."""
    rows = None
    for source, loaded in counts:
        one = loaded.agg(F.count("*").alias("rows_loaded")).select(
            F.lit(run_id).alias("run_id"), F.lit(source).alias("source_name"), "rows_loaded"
        )
        rows = one if rows is None else rows.unionByName(one)
    return upsert(log, stage(rows, "load-log"), ["run_id", "source_name"])


def last_runs(runs: DataFrame, status: str, count: int = 20) -> DataFrame:
    """The latest runs with a status and their duration in seconds. ``runs`` has (run_id, job, started, ended, status)."""
    found = runs.where(F.col("status") == status).withColumn("seconds", F.expr("timestampdiff(SECOND, started, ended)"))
    return found.orderBy(F.col("started").desc(), F.col("run_id").desc()).limit(count)
