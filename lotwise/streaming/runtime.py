"""Running a stream over what is available now, and tables written one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.sources.workspace import new_path


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over a Parquet file or folder; event times become zoned timestamps, which watermarks need."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    folder, _, name = path.rpartition("/")
    rows = reader.parquet(f"{folder}/{{{name}}}")  # as a pattern, since a plain path has to be a folder
    times = [field.name for field in rows.schema.fields if field.dataType.typeName() == "timestamp_ntz"]
    return rows.withColumns({name: F.col(name).cast("timestamp") for name in times}) if times else rows


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str | None = None, poll: str | None = None
) -> None:
    """Feeds micro-batches to ``handle``. Without ``poll`` it ends when the input is used up, with ``poll`` (such as
    ``"5 seconds"``) it goes on until stopped."""
    folder = checkpoint or new_path(stream.sparkSession, "checkpoint")
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", folder)
    writer = writer.trigger(processingTime=poll) if poll else writer.trigger(availableNow=True)
    writer.start().awaitTermination()


def write_batch(rows: DataFrame, path: str, batch: int) -> None:
    """One folder per batch, overwritten when the batch is replayed, so a restart writes no row twice."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows written by ``write_batch``, with the batch number as the column ``batch``."""
    return spark.read.schema(f"{schema}, batch int").parquet(path)


def collected(stream: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """The rows of a stateless stream, as a written table."""
    spark = stream.sparkSession
    path = new_path(spark, "stream")
    stream.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint or new_path(spark, "checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def final_result(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last state of every group of a streaming aggregate.

    Update mode: a batch tells the groups that it changed, and what the watermark has passed leaves the engine's state.
    ``keys`` are the columns of the group; the batch that told it last counts.
    """
    spark = stream.sparkSession
    path = new_path(spark, "aggregate")
    stream.writeStream.outputMode("update").foreachBatch(lambda batch, number: write_batch(batch, path, number)).option(
        "checkpointLocation", new_path(spark, "checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in stream.schema)
    told = read_batches(spark, path, schema)
    values = [name for name in stream.columns if name not in keys]
    last = F.max_by(F.struct(*values), "batch").alias("_last")
    return told.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{name}").alias(name) for name in values]).select(*stream.columns)
