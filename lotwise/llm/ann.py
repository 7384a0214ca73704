"""Approximate nearest neighbours by multi-index hashing, nearness being the inner product.

Vectors become binary codes: signs after learned rotations (principal directions, turned so that signs lose least). A
code is cut into substrings, each of which is indexed. Two codes within a Hamming radius agree in some substring up to
radius / number of substrings (pigeonhole), so probing every index that far finds every code within the radius; these
are ranked by the exact inner product of the original vectors in double precision, ties to the smaller id.

Rotations and radius are fitted on at most ``SAMPLE`` vectors (smallest hashes of their ids): the radius holds the wanted
share of true neighbours in the sample, where neighbours are farther than in the whole table. Every row is indexed. For
vectors of unequal length one further coordinate makes the inner product an angle.

Equal vectors are searched once, as one class. A class answers with its k + 1 smallest ids, which is all that ties can
ask for. The index is cut into slices and the queries into blocks of bounded size; a task has one of each, so no bucket,
however common, meets one task. The substring indexes of a slice list its codes by value, and only codes on the lists that
a query probes are compared with it. Queries that find fewer than k + 1 classes within the radius, over all slices, are
compared with every code in a second pass.

A vector takes no part if it is null, zero, holds a null or a number that is not finite, or differs in size from most
(ties: the larger size). Rows that repeat an id and a vector count once; null ids take no part; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.sources.workspace import stage

SAMPLE = 4_000
BITS, SUBSTRINGS = 256, 16
KEPT = 0.97
SLICE, BLOCK = 16_384, 4_096
FOUND = "query bigint, class bigint, score double"


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass(frozen=True)
class Hashing:
    longest: float  # largest length of a vector
    mean: np.ndarray
    turn: np.ndarray  # coordinates by bits
    radius: int

    def codes(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        return packed((stretched(vectors, self.longest, queries) - self.mean) @ self.turn > 0)


def stretched(vectors: np.ndarray, longest: float, queries: bool) -> np.ndarray:
    """Vectors on the unit sphere of one more dimension, where angles order as inner products do."""
    square = (vectors**2).sum(axis=1)
    if queries:
        return np.concatenate([vectors / np.sqrt(square)[:, None], np.zeros((len(vectors), 1))], axis=1)
    rest = np.sqrt(np.maximum(longest**2 - square, 0))
    return np.concatenate([vectors, rest[:, None]], axis=1) / longest


def packed(signs: np.ndarray) -> np.ndarray:
    return np.packbits(signs, axis=1, bitorder="little").view("<u2")


def fit(sample: np.ndarray, longest: float, k: int, seed: int = 5) -> Hashing:
    random = np.random.default_rng(seed)
    points = stretched(sample, longest, False)
    mean = points.mean(axis=0)
    centred = points - mean
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    size = points.shape[1]
    axes = np.linalg.qr(np.concatenate([axes.T, random.normal(size=(size, size))], axis=1))[0][:, :size]
    turns = []
    while sum(turn.shape[1] for turn in turns) < BITS:
        turn = np.linalg.qr(random.normal(size=(size, size)))[0]
        for _ in range(20):
            signs = np.sign(centred @ axes @ turn)
            left, _, right = np.linalg.svd(signs.T @ (centred @ axes))
            turn = (left @ right).T
        turns.append(axes @ turn)
    turn = np.concatenate(turns, axis=1)[:, :BITS]
    asked = random.permutation(len(sample))[:256]
    hashing = Hashing(longest, mean, turn, BITS)
    near = sample[asked] @ sample.T
    near[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-near, axis=1)[:, : min(k, len(sample) - 1)]
    apart = distances(hashing.codes(sample[asked], True), hashing.codes(sample))
    apart = np.take_along_axis(apart, best, axis=1)
    radius = int(np.ceil(np.quantile(apart, KEPT))) if apart.size else BITS
    return Hashing(longest, mean, turn, radius)


def distances(queries: np.ndarray, codes: np.ndarray) -> np.ndarray:
    wide = [np.ascontiguousarray(side).view(np.uint64) for side in (queries, codes)]
    result = np.zeros((len(queries), len(codes)), np.int32)
    for place in range(wide[0].shape[1]):
        result += np.bitwise_count(wide[0][:, place][:, None] ^ wide[1][:, place][None, :])
    return result


def probed(codes: np.ndarray, indexes: list[tuple[np.ndarray, np.ndarray]], probes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probe, code, distance) of all codes within the radius, by the substring indexes.

    Of two codes within the radius some substring differs in at most ``radius // SUBSTRINGS`` bits. Each index lists the
    codes by the values that their substring takes: the values near enough to the probe's are picked, their lists united,
    and only the codes on them are compared.
    """
    reach = radius // SUBSTRINGS
    hit = np.zeros((len(probes), len(codes)), bool)
    for place, (values, where) in enumerate(indexes):
        near = np.bitwise_count(values[None, :] ^ probes[:, place][:, None]) <= reach
        rows = np.flatnonzero(near.any(axis=1))
        hit[rows] |= near[rows][:, where]
    row, one = np.nonzero(hit)
    apart = np.zeros(len(row), np.int32)
    wide = [np.ascontiguousarray(side).view(np.uint64) for side in (probes, codes)]
    for place in range(wide[0].shape[1]):
        apart += np.bitwise_count(wide[0][row, place] ^ wide[1][one, place])
    within = apart <= radius
    return row[within], one[within], apart[within]


def search(hashing: Hashing, ids: np.ndarray, vectors: np.ndarray, asked: np.ndarray, queries: np.ndarray, k: int, every: bool = False):
    """(query, id, score) of the nearest k of the vectors within the radius for each query, found by the substring indexes.

    With ``every``, the k nearest codes however far, found by comparing them all: for queries with too few in the radius.
    """
    codes, probes = hashing.codes(vectors), hashing.codes(queries, True)
    indexes = [np.unique(codes[:, place], return_inverse=True) for place in range(SUBSTRINGS)]
    found = []
    for at in range(0, len(asked), 32):
        part = probes[at : at + 32]
        if every:
            apart, most = distances(part, codes), min(k, len(codes)) - 1
            limit = np.partition(apart, most, axis=1)[:, most]
            row, one = np.nonzero(apart <= np.maximum(limit, hashing.radius)[:, None])
        else:
            row, one, _ = probed(codes, indexes, part, hashing.radius)
        score = np.einsum("ij,ij->i", queries[at + row], vectors[one])
        order = np.lexsort((ids[one], -score, row))
        row, one, score = row[order], one[order], score[order]
        first = np.searchsorted(row, np.arange(len(part)))
        kept = np.arange(len(row)) - first[row] < k
        found.append((asked[at + row[kept]], ids[one[kept]], score[kept]))
    return [np.concatenate(column) for column in zip(*found)]


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = pa.concat_arrays([chunk.flatten() for chunk in column.chunks]) if column.num_chunks else pa.array([], pa.float32())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def nearest(df: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, key, score): for each row that ``is_query`` selects, the nearest k of all other rows found."""
    rows = df.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.col("count").desc(), F.col("size").desc()).first()
    spark = df.sparkSession
    if sizes is None:
        return spark.range(0).select(F.lit(0).cast("bigint").alias("query_id"), F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias(key), F.lit(0.0).alias("score"))
    rows = rows.where(F.size("vector") == sizes["size"])
    place = Window.partitionBy("vector").orderBy("id")
    members = rows.withColumn("place", F.dense_rank().over(place)).where(F.col("place") <= k + 1).select("id", "vector", "place").distinct()
    members = stage(members, "members")
    classes = members.where("place = 1").select(F.col("id").alias("class"), "vector")
    members = members.join(classes, "vector").select("class", "id")
    asking = stage(rows.where("asks").select("id", "vector").distinct().join(classes, "vector").select(F.col("id").alias("query_id"), "class"), "asking")
    asked = asking.select("class").distinct().join(classes, "class")

    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    longest, count = classes.agg(F.sqrt(F.max(square)), F.count("*")).first()
    picked = classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("vector").toArrow()
    hashing = fit(_matrix(picked.column(0), picked.num_rows), longest, k)

    slices = -(-count // SLICE)
    sliced = classes.withColumn("slice", F.pmod(F.xxhash64("class"), F.lit(slices)))

    def searched(asked: DataFrame, every: bool) -> DataFrame:
        """All slices of the vectors against all blocks of the queries."""
        blocks = max(1, -(-asked.count() // BLOCK))
        index = sliced.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        probes = asked.withColumn("block", F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int"))
        probes = probes.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint"))))
        probes = probes.toDF("asker", "question", "its_block", "its_slice")

        def compare(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return pa.table({"query": pa.array([], pa.int64()), "class": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
            ids, queries = left.column("class").to_numpy(), right.column("asker").to_numpy()
            found = search(hashing, ids, _matrix(left.column("vector"), len(ids)), queries, _matrix(right.column("question"), len(queries)), k + 1, every)
            return pa.table(dict(zip(("query", "class", "score"), found)))

        return index.groupBy("slice", "block").cogroup(probes.groupBy("its_slice", "its_block")).applyInArrow(compare, FOUND)

    within = stage(searched(asked, False), "within")
    # A query with fewer than it asks for in the radius, over all slices, is compared with every code.
    enough = within.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") >= min(k + 1, count))
    short = stage(asked.join(enough, F.col("class") == F.col("query"), "left_anti"), "short")
    rest = searched(short, True)
    found = within.join(short.select(F.col("class").alias("query")), "query", "left_anti").unionByName(rest)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "class")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1).drop("rank")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    found = found.join(members, "class").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1).drop("rank", "class")
    answers = asking.join(found.withColumnRenamed("query", "class"), "class").where("id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    answers = answers.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return answers.select("query_id", "rank", F.col("id").alias(key), "score")
