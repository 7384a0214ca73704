"""Stored tables: versions, untouched files, writers that stop half-way."""

import pytest
from pyspark.sql import functions as F

from lotwise.operators import change
from lotwise.sources.stored import StoredTable, VersionTaken
from lotwise.sources.workspace import names, new_path

COLUMNS = "id bigint, region string, amount decimal(12,2), tags array<string>"


def base(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") != 7, F.col("id")).alias("id"),
        F.concat(F.lit("r"), F.col("id") % 5).alias("region"),
        (F.col("id") / 4).cast("decimal(12,2)").alias("amount"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit("a"), F.lit(None))).alias("tags"),
    )
    return rows


@pytest.fixture
def table(spark):
    return StoredTable.create(spark, new_path(spark, "table"), base(spark), ["id"], buckets=16)


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def incoming(spark):
    new = [(None, "null", None, None), (5, "r0", None, ["x"]), (9000, "new", None, None), (12, "r2", None, ["a", None])]
    return spark.createDataFrame(new, COLUMNS)


def test_upsert_rewrites_touched_buckets_only(spark, table):
    before, files = table.read(), table.files()
    want = [r for r in base(spark).collect() if r["id"] not in (None, 5, 12)]
    assert table.upsert(incoming(spark)) == 1
    assert rows(table.read()) == sorted(map(repr, map(tuple, want + incoming(spark).collect())))
    changed = {bucket for bucket, path in table.files().items() if files[bucket] != path}
    assert 1 <= len(changed) <= 4 and len(files) == 16
    # A reader of the old version still has its files.
    assert rows(before) == rows(base(spark)) == rows(table.read(0))


def test_the_same_change_again_writes_nothing(spark, table):
    table.upsert(incoming(spark))
    files, data = table.files(), sorted(names(spark, f"{table.path}/data"))
    assert table.upsert(incoming(spark)) == 1 == table.version()
    assert (table.files(), sorted(names(spark, f"{table.path}/data"))) == (files, data)
    # Of changes that differ in one row, one bucket is rewritten.
    more = incoming(spark).withColumn("region", F.when(F.col("id") == 5, "other").otherwise(F.col("region")))
    assert table.upsert(more) == 2
    assert sum(files[bucket] != path for bucket, path in table.files().items()) == 1


def test_feeds_equal_the_transformation(spark, table):
    feed = spark.range(4000).select(
        F.col("id").alias("seq"),
        F.element_at(F.array(F.lit("I"), F.lit("U"), F.lit("D")), (F.col("id") % 3 + 1).cast("int")).alias("op"),
        (F.col("id") * 7 % 3500).alias("id"),
        F.lit("fed").alias("region"),
        F.col("id").cast("decimal(12,2)").alias("amount"),
        F.lit(None).cast("array<string>").alias("tags"),
        F.lit("ignored").alias("more"),
    )
    want = change.apply_changes(base(spark).where("id IS NOT NULL"), feed, ["id"])
    table.apply(feed)
    assert rows(table.read().where("id IS NOT NULL")) == rows(want)
    assert table.read().where("id IS NULL").count() == 1
    assert table.apply(feed) == 1


def test_a_stop_before_the_switch_leaves_the_old_table(spark, table, monkeypatch):
    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(StoredTable, "_switch", stop)
    with pytest.raises(KeyboardInterrupt):
        table.upsert(incoming(spark))
    monkeypatch.undo()
    assert table.version() == 0 and rows(table.read()) == rows(base(spark))
    assert len(names(spark, f"{table.path}/data")) == 2
    assert table.upsert(incoming(spark)) == 1
    assert table.vacuum() == 1 and rows(table.read()) != rows(base(spark))  # the files that no version lists are gone


def test_only_one_writer_gets_a_version(spark, table):
    late = StoredTable(spark, table.path)
    late.version = lambda: 0  # it read before the other switched
    table.upsert(incoming(spark))
    with pytest.raises(VersionTaken):
        late.upsert(incoming(spark).where("id = 9000"))
    assert table.version() == 1


def test_deletes_can_empty_buckets(spark):
    table = StoredTable.create(spark, new_path(spark, "table"), spark.createDataFrame([(1, "a")], "id int, name string"), ["id"], buckets=4)
    feed = spark.createDataFrame([(1, "D", 1, None), (2, "D", 5, None)], "seq int, op string, id int, name string")
    assert table.apply(feed) == 1 and table.read().count() == 0 and table.files() == {}
    assert table.upsert(spark.createDataFrame([], "id int, name string")) == 1
    assert table.upsert(spark.createDataFrame([(3, "c")], "id int, name string")) == 2 and rows(table.read()) == ["(3, 'c')"]
    table.vacuum()
    assert rows(table.read()) == ["(3, 'c')"] and table.version() == 2


def test_versions_that_are_kept_stay_readable(spark, table):
    for amount in range(4):
        table.upsert(spark.createDataFrame([(amount, "v", None, None)], COLUMNS))
    table.vacuum(keep=2)
    assert table.read(3).where("region = 'v'").count() == 3 and table.read().where("region = 'v'").count() == 4
    assert len(names(spark, f"{table.path}/versions")) == 2
