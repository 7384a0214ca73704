"""A stored table that changes by whole versions: copy on write by key bucket.

Rows lie in buckets by a hash of the key. A change set reads the buckets its keys fall into, rewrites those in which a row
really differs into new files, and then switches to them by naming one manifest file. Everything else stays where it is:
the new version lists the old files of untouched buckets. Readers hold the files of the version they began with; a writer
that stops before the switch leaves the old version as it was, and one that finds its version number taken is refused.
Applying the same changes again finds no difference and writes nothing.

Keys may be null, which is a key of its own. A manifest has a row per bucket, and buckets are a parameter, so what reaches
the driver does not grow with the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotwise.operators.change import latest_changes
from lotwise.sources.workspace import delete, names, renamed, scratch, stage

MANIFEST = "bucket int, files string"
#: The manifest row that describes the table instead of a bucket.
TABLE = -1
#: The partition column of the files, and no column of a table.
BUCKET = "bucket_of_key"


class VersionTaken(RuntimeError):
    """Another writer switched to this version first; read again and repeat the change."""


class StoredTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], buckets: int = 64) -> StoredTable:
        """Writes version 0. ``rows`` has one row per key."""
        table = cls(spark, path)
        about = {"schema": rows.schema.jsonValue(), "keys": list(keys), "buckets": buckets}
        table._switch(0, table._written(rows, about), about)
        return table

    def version(self) -> int:
        return max(map(int, names(self.spark, f"{self.path}/versions")))

    def read(self, version: int | None = None) -> DataFrame:
        about, files = self._manifest(self.version() if version is None else version)
        return self._rows(about, files.values())

    def files(self, version: int | None = None) -> dict[int, str]:
        """The folder of each bucket that has rows."""
        return self._manifest(self.version() if version is None else version)[1]

    def upsert(self, incoming: DataFrame) -> int:
        """Incoming rows, one per key, replace those of their key or are added. The version after it."""
        return self._change(incoming.withColumn("_gone", F.lit(False)))

    def apply(self, feed: DataFrame, sequence: str = "seq", operation: str = "op") -> int:
        """The last change of each key of a feed of I, U and D; feed columns that the table lacks are ignored."""
        keys = self._manifest(self.version())[0]["keys"]
        last = latest_changes(feed, keys, sequence)
        return self._change(last.withColumn("_gone", F.col(operation) == "D"))

    def vacuum(self, keep: int = 1) -> int:
        """Deletes all but the last ``keep`` versions, and the files that none of those lists. No reader may hold them."""
        versions = sorted(map(int, names(self.spark, f"{self.path}/versions")))
        listed = {path.split("/")[0] for version in versions[-keep:] for path in self.files(version).values()}
        for version in versions[:-keep]:
            delete(self.spark, self._name(version))
        gone = [name for name in names(self.spark, f"{self.path}/data") if name not in listed]
        for name in gone:
            delete(self.spark, f"{self.path}/data/{name}")
        return len(gone)

    def _change(self, changes: DataFrame) -> int:
        version = self.version()
        about, files = self._manifest(version)
        columns = [field["name"] for field in about["schema"]["fields"]]
        with scratch(self.spark):
            changes = stage(changes.select(*columns, "_gone").withColumn(BUCKET, _bucket(about)), "changes")
            touched = _numbers(changes)
            old = self._rows(about, (files[number] for number in touched if number in files))
            changes = stage(_effective(old, changes, columns, about["keys"]), "effective")
            touched = _numbers(changes)
            if not touched:
                return version
            old = self._rows(about, (files[number] for number in touched if number in files))
            named = changes.select(*[F.col(key).alias(f"_{key}") for key in about["keys"]])
            kept = old.join(named, _same(about["keys"]), "left_anti")
            rows = kept.unionByName(changes.where("NOT _gone").select(*columns))
            written = self._written(rows, about)
            after = {number: path for number, path in files.items() if number not in touched} | written
            self._switch(version + 1, after, about)
        return version + 1

    def _written(self, rows: DataFrame, about: dict) -> dict[int, str]:
        """Writes rows into new files by bucket; a bucket too large for one task becomes several."""
        name = uuid.uuid4().hex
        folder = f"{self.path}/data/{name}"
        placed = rows.withColumn(BUCKET, _bucket(about)).hint("rebalance", F.col(BUCKET))
        placed.write.partitionBy(BUCKET).parquet(folder)
        return {int(part.split("=")[1]): f"{name}/{part}" for part in names(self.spark, folder)}

    def _switch(self, version: int, files: dict[int, str], about: dict) -> None:
        """Names the manifest of the next version, the one step that readers notice."""
        building = f"{self.path}/versions/.{uuid.uuid4().hex}"
        rows = [(TABLE, json.dumps(about)), *sorted(files.items())]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(building)
        if not renamed(self.spark, building, self._name(version)):
            delete(self.spark, building)
            raise VersionTaken(self._name(version))

    def _name(self, version: int) -> str:
        return f"{self.path}/versions/{version:010d}"

    def _manifest(self, version: int) -> tuple[dict, dict[int, str]]:
        rows = dict(map(tuple, self.spark.read.schema(MANIFEST).json(self._name(version)).collect()))
        return json.loads(rows.pop(TABLE)), rows

    def _rows(self, about: dict, files) -> DataFrame:
        schema = StructType.fromJson(about["schema"])
        paths = [f"{self.path}/data/{path}" for path in files]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)


def _bucket(about: dict) -> Column:
    return F.pmod(F.xxhash64(*about["keys"]), F.lit(about["buckets"])).cast("int")


def _numbers(changes: DataFrame) -> list[int]:
    return sorted(row[0] for row in changes.select(BUCKET).distinct().collect())


def _same(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return condition


def _effective(old: DataFrame, changes: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The changes after which a row is different, new or gone."""
    stored = old.select(*[F.col(key).alias(f"_{key}") for key in keys], F.struct(*columns).alias("_row"))
    both = changes.join(stored, _same(keys), "left")
    known = F.col("_row").isNotNull()
    differs = F.when(F.col("_gone"), known).otherwise(~known | ~F.struct(*columns).eqNullSafe(F.col("_row")))
    return both.where(differs).select(*changes.columns)
