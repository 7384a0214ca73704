"""Exact nearest neighbours by cosine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.vector import DIGITS, dot

#: Vectors and queries that meet in one task at most, on average.
SLICE, BLOCK = 20_000, 1_000


def fault_of(vector: str, size: int) -> Column:
    """Why a vector does not belong into a collection of the given size, null if it does."""
    v = F.col(vector)
    return (
        F.when(v.isNull(), "missing")
        .when(F.size(v) != size, "size")
        .when(F.exists(v, lambda item: item.isNull()), "null element")
        .when(dot(v, v) == 0, "zero")
    )


def collection_faults(df: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """Vectors that do not belong into a collection of the given size: missing, of another size, with a null, or zero."""
    return df.select(key, fault_of(vector, size).alias("fault")).where(F.col("fault").isNotNull())


def top_k(df: DataFrame, key: str, vector: str, query: Column, k: int) -> DataFrame:
    """The ``k`` rows most like one query vector (a literal or a scalar subquery). Filter ``df`` first."""
    # The query is measured once, in a row of its own; a vector with a fault has no length and drops out.
    spark = df.sparkSession
    asked = spark.range(1).select(query.alias("v")).select(F.struct("v", F.sqrt(dot(F.col("v"), F.col("v"))).alias("length")).alias("q"))
    own = F.col(vector)
    fits = (F.size(own) == F.size("_q.v")) & ~F.exists(own, lambda item: item.isNull()) & F.exists(own, lambda item: item != 0)
    placed = df.withColumn("_q", asked.scalar()).where(fits & (F.col("_q.length") > 0))
    product = F.struct(dot(own, F.col("_q.v")).alias("to_query"), F.sqrt(dot(own, own)).alias("length"))
    placed = placed.withColumn("_p", product)
    scored = placed.withColumn("score", F.round(F.col("_p.to_query") / (F.col("_p.length") * F.col("_q.length")), DIGITS))
    return scored.drop("_q", "_p").orderBy(F.col("score").desc(), F.col(key)).limit(k)


def top_k_each(vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, k: int) -> DataFrame:
    """The ``k`` nearest rows for each of many query vectors, whatever the type of the keys.

    Vectors are dealt into slices and queries into blocks of bounded size; every slice meets every block in a task of its
    own, which keeps its best ``k`` per query, so k rows per query and slice reach the last shuffle. A vector meets only
    queries of its size; vectors with nulls and zero vectors take no part.
    """
    fine = lambda name: F.col(name).isNotNull() & ~F.exists(name, lambda x: x.isNull()) & F.exists(name, lambda x: x != 0)
    rows = vectors.where(fine(vector)).select(F.col(key).alias("id"), F.col(vector).alias("vector"), F.size(vector).alias("size"))
    asked = queries.where(fine(vector)).select(F.col(query_key).alias("asker"), F.col(vector).alias("question"), F.size(vector).alias("its_size"))

    def parts(df: DataFrame, most: int) -> Column:
        return df.agg(F.expr(f"CAST(count(*) div {most} + 1 AS BIGINT)")).scalar()

    def every(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1))

    slices, blocks = parts(vectors, SLICE), parts(queries, BLOCK)
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("id", "vector"), slices)).withColumn("block", every(blocks))
    asked = asked.withColumn("its_block", F.pmod(F.xxhash64("asker", "question"), blocks)).withColumn("its_slice", every(slices))
    ids, askers = vectors.schema[key].dataType, queries.schema[query_key].dataType

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        return nearest(left, right, k)

    schema = f"query {askers.simpleString()}, id {ids.simpleString()}, score double"
    partial = rows.groupBy("slice", "block", "size").cogroup(asked.groupBy("its_slice", "its_block", "its_size")).applyInArrow(compare, schema)
    place = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    ranked = partial.withColumn("place", F.row_number().over(place).cast("bigint")).where(F.col("place") <= k)
    return ranked.select(F.col("query").alias(query_key), F.col("id").alias(key), "score", "place")


def nearest(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The best ``k`` of the left vectors for each of the right ones, all of one size. Keys are carried by position."""
    ids, askers = left.column("id"), right.column("asker")
    if not left.num_rows or not right.num_rows:
        return pa.table({"query": askers.slice(0, 0), "id": ids.slice(0, 0), "score": pa.array([], pa.float64())})

    def unit(column: pa.ChunkedArray, rows: int) -> np.ndarray:
        matrix = pa.concat_arrays([chunk.flatten() for chunk in column.chunks]).to_numpy(zero_copy_only=False)
        matrix = matrix.astype(np.float64).reshape(rows, -1)
        return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)

    vectors, questions = unit(left.column("vector"), left.num_rows), unit(right.column("question"), right.num_rows)
    # Equal scores go to the smaller key: positions are those of the sorted keys.
    order = np.array(sorted(range(left.num_rows), key=ids.to_pylist().__getitem__))
    vectors = vectors[order]
    found: tuple[list, list, list] = ([], [], [])
    for at in range(0, len(questions), 64):
        scores = np.round(questions[at : at + 64] @ vectors.T, DIGITS)
        for row, score in enumerate(scores, start=at):
            best = np.arange(len(score))
            if k < len(score):
                limit = score[np.argpartition(-score, k - 1)[:k]].min()
                best = np.flatnonzero(score >= limit)
            best = best[np.argsort(-score[best], kind="stable")][:k]
            found[0].append(np.full(len(best), row))
            found[1].append(order[best])
            found[2].append(score[best])
    query, one, score = map(np.concatenate, found)
    return pa.table({"query": askers.take(pa.array(query)), "id": ids.take(pa.array(one)), "score": pa.array(score)})
