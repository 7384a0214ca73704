"""Data change as dataset transformation: (table, change set) in, new table out.

Each function anti-joins the table with the keys of the change set and appends, so a small change set is broadcast
by Spark after its own size check and the large table is not shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.operators.copies import steps



def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE: incoming rows win. ``incoming`` holds one row per key."""
    kept = target.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming.select(*target.columns))


def insert_absent(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING."""
    new = incoming.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """One row per key, the first (or last) in a total order. The choice is an aggregate, combined before the shuffle."""
    rest = [name for name in df.columns if name not in keys]
    pick = F.max_by if last else F.min_by
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return chosen.select(*[F.col(name) if name in keys else F.col(f"_row.{name}").alias(name) for name in df.columns])


def patch(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Partial update: only named, non-null fields of ``changes`` replace the row with the same key."""
    fields = [name for name in changes.columns if name != key]
    renamed = changes.select(F.col(key).alias("_key"), *[F.col(name).alias(f"_new_{name}") for name in fields])
    joined = target.join(renamed, F.col(key) == F.col("_key"), "left")
    return joined.select(
        *[F.coalesce(F.col(f"_new_{name}"), F.col(name)).alias(name) if name in fields else F.col(name)
          for name in target.columns]
    )


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE: an unknown condition leaves the row alone."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({name: F.when(hit, value).otherwise(F.col(name)) for name, value in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE ... WHERE: rows with an unknown condition stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def split_deleted(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(kept rows, deleted rows) of one DELETE, for archives and follow-up changes."""
    hit = F.coalesce(condition, F.lit(False))
    return df.where(~hit), df.where(hit)


def delete_children(children: DataFrame, deleted: DataFrame, foreign_key: str, key: str) -> DataFrame:
    """ON DELETE CASCADE one level down."""
    gone = deleted.select(F.col(key).alias("_gone")).distinct()
    return children.join(gone, F.col(foreign_key) == F.col("_gone"), "left_anti")


def flag_children(children: DataFrame, deleted: DataFrame, foreign_key: str, key: str, flag: str) -> DataFrame:
    """Adds a boolean column: does the row refer to a deleted parent?"""
    gone = deleted.select(F.col(key).alias("_gone")).distinct()
    joined = children.join(gone, F.col(foreign_key) == F.col("_gone"), "left")
    return joined.withColumn(flag, F.col("_gone").isNotNull()).drop("_gone")


def null_children(children: DataFrame, deleted: DataFrame, foreign_key: str, key: str) -> DataFrame:
    """ON DELETE SET NULL one level down."""
    flagged = flag_children(children, deleted, foreign_key, key, "_orphan")
    return flagged.withColumn(foreign_key, F.when(~F.col("_orphan"), F.col(foreign_key))).drop("_orphan")


def changed_rows(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Audit of one column between two snapshots: rows where it IS DISTINCT FROM its earlier value.

    A key that exists in only one snapshot is an insert or a delete, not a change of the value.
    """
    before = old.select(F.col(key).alias("_key"), F.col(value).alias("old_value"))
    after = new.select(key, F.col(value).alias("new_value"))
    joined = after.join(before, F.col(key) == F.col("_key"), "inner")
    changed = joined.where(~F.col("old_value").eqNullSafe(F.col("new_value")))
    return changed.select(key, "old_value", "new_value", (F.col("new_value") - F.col("old_value")).alias("difference"))


def latest_changes(feed: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The last change of each key; only one row per key and map task reaches the shuffle."""
    return keep_one(feed, keys, [F.col(sequence)], last=True)


def apply_changes(
    target: DataFrame, feed: DataFrame, keys: Sequence[str], sequence: str = "seq", operation: str = "op"
) -> DataFrame:
    """Applies a feed of I/U/D changes by key, the latest winning; feed columns the target lacks are ignored."""
    last = latest_changes(feed, keys, sequence)
    kept = target.join(last.select(*keys), list(keys), "left_anti")
    return kept.unionByName(last.where(F.col(operation) != "D").select(*target.columns))


def apply_keyless(target: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """Applies changes to a table without a key, matching whole old rows (nulls equal).

    An update is one removed and one added row. Rows are counted with a sign, so of several equal rows exactly as
    many disappear as changes name them, and chains of changes cancel out. Only rows equal to a removed row are counted;
    the rest of the table is told from them by the removed rows, which Spark broadcasts if they are few.
    """
    names = target.columns
    gone = removed.select(*[F.col(name).alias(f"_{name}") for name in names]).distinct()
    equal = F.lit(True)
    for name in names:
        equal = equal & F.col(name).eqNullSafe(F.col(f"_{name}"))
    signed = (
        target.join(gone, equal, "left_semi")
        .withColumn("_n", F.lit(1).cast("bigint"))
        .unionByName(added.select(*names).withColumn("_n", F.lit(1).cast("bigint")))
        .unionByName(removed.select(*names).withColumn("_n", F.lit(-1).cast("bigint")))
    )
    left = signed.groupBy(*names).agg(F.sum("_n").alias("_n")).where(F.col("_n") > 0)
    return target.join(gone, equal, "left_anti").unionByName(steps(left, F.lit(1), F.col("_n"), "_copy").select(*names))


def drift(stored: DataFrame, recomputed: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows where a stored aggregate differs from its recomputation, including rows on one side only."""
    left = stored.select(*keys, *[F.col(name).alias(f"stored_{name}") for name in values]).alias("s")
    right = recomputed.select(*keys, *[F.col(name).alias(f"actual_{name}") for name in values]).alias("r")
    joined = left.join(right, list(keys), "full_outer")
    differs = F.lit(False)
    for name in values:
        differs = differs | ~F.col(f"stored_{name}").eqNullSafe(F.col(f"actual_{name}"))
    return joined.where(differs)


