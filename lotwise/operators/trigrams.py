"""Names by their three-letter pieces: lists of names by piece, written once and sorted by piece.

The similarity of a name and a question is the number of pieces in common over the number in either. A list entry carries
the name's number of pieces, so counting the lists that hold a name gives its similarity exactly, and names that share no
piece with the question are never looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions.text import trigrams


def write_trigrams(names: DataFrame, name: str, path: str) -> None:
    """Lists of the distinct names; names without a word have no piece and no entry."""
    distinct = names.select(F.col(name).alias("name")).distinct().withColumn("_pieces", trigrams("name"))
    listed = distinct.select(F.explode("_pieces").alias("piece"), "name", F.size("_pieces").alias("pieces"))
    listed.repartitionByRange("piece", "name").sortWithinPartitions("piece", "name").write.parquet(path)


def pieces_of(spark: SparkSession, question: str) -> list[str]:
    return spark.range(1).select(trigrams(F.lit(question))).first()[0]


def _lists(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    return spark.read.parquet(path).where(F.col("piece").isin(*wanted))


def _similarities(lists: DataFrame, wanted: int) -> DataFrame:
    counted = lists.groupBy("name", "pieces").agg(F.count("*").alias("shared"))
    return counted.select("name", (F.col("shared").cast("double") / (F.col("pieces") + wanted - F.col("shared"))).alias("similarity"))


def similar(spark: SparkSession, path: str, question: str, least: float) -> DataFrame:
    """(name, similarity) of the names at least so similar, for a threshold above 0.

    Names with too many or too few pieces are left out first. A similar name shares a certain number of pieces, so it is
    on one of the shortest lists, all but that number less one; the long lists only add to the names found there.
    """
    if least <= 0:
        raise ValueError("names that share nothing are not on any list; the threshold must be above 0")
    wanted = pieces_of(spark, question)
    if not wanted:
        return spark.createDataFrame([], "name string, similarity double")
    size = len(wanted)
    lists = _lists(spark, path, wanted).where(F.col("pieces").between(math.ceil(least * size), math.floor(size / least)))
    by_length = _by_length(lists, wanted)
    short = by_length[: size - math.ceil(least * size) + 1]
    found = lists.where(F.col("piece").isin(*short)).select("name").distinct()
    return _similarities(lists.join(found, "name", "left_semi"), size).where(F.col("similarity") >= least)


def _by_length(lists: DataFrame, wanted: list[str]) -> list[str]:
    lengths = {row["piece"]: row["n"] for row in lists.groupBy("piece").agg(F.count("*").alias("n")).collect()}  # one row a piece
    return sorted(wanted, key=lambda piece: (lengths.get(piece, 0), piece))


def nearest(spark: SparkSession, path: str, question: str, k: int) -> tuple[DataFrame, bool]:
    """(name, similarity) of the ``k`` most similar names with all their ties, and whether so many share a piece at all.

    The shortest lists come first. A name on none of them shares at most the pieces that are left, which bounds its
    similarity; as soon as ``k`` names lie above that bound, no other can come among them.
    """
    wanted = pieces_of(spark, question)
    if not wanted:
        return spark.createDataFrame([], "name string, similarity double"), False
    size, read = len(wanted), 1
    lists = _lists(spark, path, wanted)
    by_length = _by_length(lists, wanted)
    while True:
        found = candidates(lists, by_length[:read], size)
        best = [row["similarity"] for row in found.orderBy(F.desc("similarity")).limit(k).collect()]
        if read == size or (len(best) == k and best[-1] > (size - read) / size):
            break
        read = min(size, 2 * read)
    enough = len(best) == k
    return (found.where(F.col("similarity") >= best[-1]) if enough else found), enough


def candidates(lists: DataFrame, short: list[str], size: int) -> DataFrame:
    """The names on some of the lists, with the similarity that all lists give them."""
    names = lists.where(F.col("piece").isin(*short)).select("name").distinct()
    return _similarities(lists.join(names, "name", "left_semi"), size)
