"""Property-graph patterns on node and edge tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotwise.operators.ordered import row_numbers
from lotwise.sources.workspace import partitions_for, stage


def pairs_with_counts(edges: DataFrame, links: DataFrame, reader: str, item: str, category: str, rows: int = 0) -> DataFrame:
    """Two-hop pattern reader -> item -> category with the number of paths, written.

    Edges are first counted per (reader, item), so a reader who reads one item a million times is one row. ``rows`` is about
    the number of edges; the partitions follow it, since most edges may be different and a task holds those of its share.
    """
    with partitions_for(edges.sparkSession, rows):
        counted = edges.groupBy(reader, item).agg(F.count("*").alias("_n"))
        return stage(counted.join(links, item).groupBy(reader, category).agg(F.sum("_n").alias("paths")), "paths")


def scattered(key: Column) -> Column:
    """A number below 2**32 that puts keys in an order of its own: multiplication by a large odd number."""
    return F.pmod(key, F.lit(2**31)) * 2654435761 % 2**32


def picked(readers: DataFrame, items: DataFrame, reader: str, item: str, k: int) -> DataFrame:
    """(reader, item) with ``k`` different items for each reader, all of them if there are fewer.

    The items are put in a scattered order and numbered; a reader takes the ``k`` that follow a place of its own, round the
    end. So every reader asks for ``k`` numbers, and readers and items meet in one join by number, never in pairs.
    """
    placed = items.select(item).distinct().withColumn("_order", scattered(F.col(item)))
    numbered = stage(row_numbers(placed, [], ["_order", item], "_place").select(item, "_place"), "numbered")
    count = numbered.agg(F.max("_place")).first()[0] or 0
    if not count:
        return readers.sparkSession.createDataFrame([], StructType([readers.schema[reader], items.schema[item]]))
    asked = readers.select(reader).distinct().withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(min(k, count) - 1))))
    asked = asked.withColumn("_place", (scattered(F.col(reader)) + F.col("_at")) % count + 1)
    return asked.join(numbered, "_place").select(reader, item)


def counted_edges(edges: DataFrame, reader: str, item: str, rows: int = 0) -> DataFrame:
    """(reader, item, n) with each pair once, written: patterns that go over the edges several times read this table.

    ``rows`` is about the number of edges, for the number of partitions.
    """
    with partitions_for(edges.sparkSession, rows):
        return stage(edges.groupBy(reader, item).agg(F.count("*").alias("n")), "edges")


def similar_items(distinct: DataFrame, reader: str, item: str, target: Column, k: int) -> DataFrame:
    """Items with the most readers in common with one target item; ``distinct`` has each edge once.

    Starts from the target's readers, so no pairs of items are formed; hub readers cost their own edges only.
    """
    readers = distinct.where(F.col(item) == target).select(reader)
    others = distinct.where(F.col(item) != target).join(readers, reader, "left_semi")
    common = others.groupBy(item).agg(F.count("*").alias("common_readers"))
    return common.orderBy(F.col("common_readers").desc(), item).limit(k)


def recommend(
    edges: DataFrame, links: DataFrame, views: DataFrame, reader: str, item: str, category: str, who: Column, k: int
) -> DataFrame:
    """Unseen items in the categories ``who`` already reads, by number of matching categories, then views, then id."""
    seen = edges.where(F.col(reader) == who).select(item).distinct()
    known = links.join(seen, item, "left_semi").select(category).distinct()
    unseen = links.distinct().join(known, category, "left_semi").join(seen, item, "left_anti")
    weighed = unseen.groupBy(item).agg(
        F.count("*").alias("relevance"), F.array_join(F.array_sort(F.collect_set(category)), ",").alias("categories")
    )
    viewed = weighed.join(views, item, "left").withColumn("views", F.coalesce("views", F.lit(0)))
    return viewed.orderBy(F.col("relevance").desc(), F.col("views").desc(), item).limit(k)


def with_neighbours(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Every node with each relationship it takes part in, in either direction, or with none.

    ``nodes`` has (kind, id), ``edges`` has (from_kind, from_id, to_kind, to_id).
    """
    forward = edges.select(
        F.col("from_kind").alias("kind"),
        F.col("from_id").alias("id"),
        F.col("to_kind").alias("other_kind"),
        F.col("to_id").alias("other_id"),
    )
    backward = edges.select(
        F.col("to_kind").alias("kind"),
        F.col("to_id").alias("id"),
        F.col("from_kind").alias("other_kind"),
        F.col("from_id").alias("other_id"),
    )
    both = forward.unionByName(backward)
    # A hub node holds many edges: an inner join lets Spark split it, which a left outer join would not.
    alone = nodes.join(both.select("kind", "id").distinct(), ["kind", "id"], "left_anti")
    return nodes.join(both, ["kind", "id"]).unionByName(alone, allowMissingColumns=True)


def merge(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE without ON MATCH: what exists stays as it is, each new key is created once."""
    rest = [name for name in existing.columns if name not in keys]
    new = incoming.join(existing.select(*keys), list(keys), "left_anti")
    if rest:
        created = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")
    else:
        created = new.select(*keys).distinct()
    return existing.unionByName(created.select(*existing.columns))
