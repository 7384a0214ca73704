"""Row and statement triggers as stream steps. The column functions are the same for a batch table and a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions import text
from lotwise.operators.ordered import row_frames
from lotwise.operators.quality import EMAIL
from lotwise.sources.workspace import new_path
from lotwise.streaming.runtime import read_batches, run_batches, write_batch


#: Numbers of a sequence that are one slice of it.
SEQUENCE = 100_000
#: Names told in one message, on average at most.
NAMES = 1000


def low_rating_notes(feedback: DataFrame, limit: float = 3.0) -> DataFrame:
    """A notification per feedback (feedback_id, seller_id, rating, text) below the limit."""
    message = F.concat(
        F.lit("Low rating received: "), F.col("rating").cast("string"), F.lit(". Text: "), F.coalesce("text", F.lit("no text"))
    )
    return feedback.where(F.col("rating") < limit).select(
        "seller_id", "feedback_id", F.lit("low_rating").alias("notification_type"), message.alias("message")
    )


def first_mileage(vehicles: DataFrame) -> DataFrame:
    """The opening mileage row of each new vehicle (vehicle_id, state)."""
    return vehicles.where("state = 'new'").select("vehicle_id", F.lit(0).alias("mileage_km"))


def clean_ads(rows: DataFrame) -> DataFrame:
    """Normalised header and VIN of (id, header, vin, email); rows with a bad VIN or address are marked rejected."""
    cleaned = rows.withColumns({"header": text.header("header"), "vin": text.vin("vin")})
    verdict = F.when(F.length("vin") != 17, "vin").when(~F.col("email").rlike(EMAIL), "email").otherwise("ok")
    return cleaned.withColumn("verdict", verdict)


def batch_summary(rows: DataFrame, name: str, table: str) -> DataFrame:
    """Notifications about a batch: how many rows, and which distinct names they carry.

    The names are told in messages of up to ``NAMES`` of them, by their hash; few names make one message. Each message
    has the count of the rows whose names it tells.
    """
    names = rows.groupBy(name).agg(F.count("*").alias("_n"))
    parts = names.agg(F.expr(f"CAST(count(*) div {NAMES} + 1 AS BIGINT)")).scalar()
    told = names.groupBy(F.pmod(F.xxhash64(name), parts).alias("_part")).agg(
        F.sum("_n").alias("record_count"),
        F.expr(f"listagg({name}, ', ') WITHIN GROUP (ORDER BY {name})").alias("_names"),
    )
    message = F.concat(
        F.lit("Bulk insert: "), F.col("record_count").cast("string"), F.lit(" rows. Names: "), F.coalesce("_names", F.lit("none"))
    )
    return told.select(F.lit(table).alias("table_name"), message.alias("message"), "record_count")


def operation_log(spark: SparkSession, stream: DataFrame, operation: str, table: str) -> DataFrame:
    """Appends every batch to a table and writes one log row per batch with its true row count."""
    data, log = new_path(spark, "rows"), new_path(spark, "log")

    def step(batch: DataFrame, number: int) -> None:
        write_batch(batch, data, number)
        written = spark.read.schema(batch.schema).parquet(f"{data}/batch={number}")
        row = written.agg(F.count("*").alias("affected_rows")).select(
            F.lit(operation).alias("operation_type"),
            F.lit(table).alias("table_name"),
            "affected_rows",
            F.current_timestamp().alias("operation_date"),
        )
        write_batch(row, log, number)

    run_batches(stream, step)
    return read_batches(spark, log, "operation_type string, table_name string, affected_rows bigint, operation_date timestamp")


def batch_alerts(spark: SparkSession, stream: DataFrame, name: str, table: str) -> DataFrame:
    path = new_path(spark, "alerts")
    run_batches(stream, lambda batch, number: write_batch(batch_summary(batch, name, table), path, number))
    return read_batches(spark, path, "table_name string, message string, record_count bigint")


def with_first_mileage(spark: SparkSession, vehicles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two sinks of one stream: the vehicles and their opening mileage rows."""
    cars, log = new_path(spark, "vehicles"), new_path(spark, "mileage")
    schema = vehicles.schema

    def step(batch: DataFrame, number: int) -> None:
        write_batch(batch, cars, number)
        stored = spark.read.schema(schema).parquet(f"{cars}/batch={number}")
        write_batch(first_mileage(stored), log, number)

    run_batches(vehicles, step)
    ddl = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema.fields)
    return read_batches(spark, cars, ddl).drop("batch"), read_batches(spark, log, "vehicle_id bigint, mileage_km int").drop("batch")


def price_changes(prices: DataFrame) -> DataFrame:
    """(ad_id, seq, old_price, new_price, difference) wherever a price differs from the one before it for the same ad."""
    paired = row_frames(prices, ["ad_id"], ["seq"], lambda w: {"old_price": F.lag("price").over(w), "_first": F.lag("seq").over(w).isNull()}, before=1, slice_of=F.expr(f"seq div {SEQUENCE}"))
    changed = paired.where(~F.col("_first") & ~F.col("old_price").eqNullSafe(F.col("price")))
    return changed.select("ad_id", "seq", "old_price", F.col("price").alias("new_price"), (F.col("price") - F.col("old_price")).alias("difference"))
