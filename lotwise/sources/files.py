"""File sources and sinks: declared schemas on the way in, skew-aware layouts on the way out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.sources.workspace import layout


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header line. Bad cells become null and the whole line lands in ``_corrupt`` if that is declared."""
    return spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", "_corrupt").csv(path)


def read_json_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON array of objects. One file is one task, so keep the files of bounded size."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json_arrays(df: DataFrame, path: str, chunk: Column) -> None:
    """One JSON array file per value of ``chunk``, which must keep the objects per file bounded."""
    arrays = df.groupBy(chunk.alias("chunk")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arrays.write.partitionBy("chunk").text(path)


def write_partitioned(df: DataFrame, path: str, *columns: str, mode: str = "errorifexists") -> None:
    """A folder per partition value. Rows of one value meet in few files, and adaptive execution splits a value that
    is too large for one task."""
    df.hint("rebalance", *[F.col(name) for name in columns]).write.mode(mode).partitionBy(*columns).parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def month_of(date: Column) -> Column:
    """Partition value of a RANGE-by-month layout."""
    return F.trunc(date.cast("date"), "MM")


def bucket_of(key: Column, buckets: int) -> Column:
    """Partition value of a HASH layout."""
    return F.pmod(F.hash(key), F.lit(buckets))


def in_bucket(df: DataFrame, bucket: str, key: str, value: int, buckets: int) -> DataFrame:
    """Equality lookup that also names the bucket, so that only its folder is read."""
    return df.where((F.col(bucket) == bucket_of(F.lit(value).cast("bigint"), buckets)) & (F.col(key) == value))


def bucketed(spark: SparkSession, label: str, sources: Sequence[str], rows: Callable[[], DataFrame], key: str, buckets: int) -> DataFrame:
    """The rows as a table in buckets of a key, made once for these sources: two such tables with equally many buckets
    join and group by their keys without an exchange. A bucket is read by one task, so a key with a great part of all rows
    is better joined from an ordinary table, whose partitions adaptive execution can split.
    """

    def write(path: str) -> None:
        building = f"building_{uuid.uuid4().hex}"
        spread = rows().repartition(buckets, key)  # one file per bucket
        spread.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(building)
        spark.sql(f"DROP TABLE {building}")  # the files of a table with a path of its own stay

    path = layout(spark, f"{label}-{buckets}", sources, write)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in spark.read.parquet(path).schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def write_for_key(df: DataFrame, path: str, key: str) -> None:
    """A layout for one access key: ranges of the key per file, sorted, so row-group statistics skip the rest."""
    df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.parquet(path)


# A backslash takes the meaning from the sign after it; a quoted text may hold blanks and commas.
NAME, TEXT = r"(?:\\.|[^,=\s\\])+", r'"(?:\\.|[^"\\])*"'
ONE = rf'{NAME}=(?:{TEXT}|[^,\s"]+)'
LINE = rf'^((?:\\.|[^,\s\\])+)((?:,{NAME}={NAME})*) +({ONE}(?:,{ONE})*)(?: +(-?\d+))?\s*$'
TAG, FIELD = rf",({NAME})=({NAME})", rf'({NAME})=({TEXT}|[^,\s"]+)'


def parse_line_protocol(lines: DataFrame) -> DataFrame:
    """``measurement,tag=v,... field=v,... [nanoseconds]`` from the column ``value``, of a table or a stream.

    Backslashes before blanks, commas and equal signs are taken off; fields that are no numbers are null; a line without a
    time has none. Other lines, and lines that name a tag or field twice, are left out.
    """

    def plain(text: Column) -> Column:
        return F.regexp_replace(text, r"\\([,= \\])", "$1")

    def pairs(part: Column, pattern: str) -> tuple[Column, Column]:
        names, values = (F.regexp_extract_all(part, F.lit(pattern), F.lit(i)) for i in (1, 2))
        return F.transform(names, plain), values

    matched = lines.where(F.col("value").rlike(LINE))
    group = [F.regexp_extract("value", LINE, i) for i in range(5)]
    (tags, tag_values), (fields, field_values) = pairs(group[2], TAG), pairs(group[3], FIELD)
    once = (F.size(tags) == F.size(F.array_distinct(tags))) & (F.size(fields) == F.size(F.array_distinct(fields)))
    numbers = F.transform(field_values, lambda v: F.rtrim(v, F.lit("iu")).try_cast("double"))
    return matched.where(once).select(
        plain(group[1]).alias("measurement"),
        F.when(F.size(tags) > 0, F.map_from_arrays(tags, F.transform(tag_values, plain))).alias("tags"),
        F.map_from_arrays(fields, numbers).alias("fields"),
        F.when(group[4] != "", group[4].cast("bigint")).alias("time_ns"),
    )


def line_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same rows of line-protocol files as they arrive in a folder, read by Spark from any store it reaches.

    A line without a time gets that of its file, as a server would give it its time of arrival.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else spark.readStream
    lines = reader.text(path).select("value", F.col("_metadata.file_modification_time").alias("arrived"))
    return with_arrival(lines)


def with_arrival(lines: DataFrame) -> DataFrame:
    """Parsed lines of (value, arrived), times filled in."""
    arrived = F.unix_micros("arrived") * 1000
    named = lines.where(F.col("value").rlike(LINE)).select(
        F.when(F.regexp_extract("value", LINE, 4) != "", F.col("value")).otherwise(F.concat(F.rtrim("value"), F.lit(" "), arrived.cast("string"))).alias("value")
    )
    return parse_line_protocol(named)
