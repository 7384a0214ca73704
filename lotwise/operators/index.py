"""A full-text index written once and asked many times: no query reads a text.

``terms`` holds, sorted by term, the posting lists in segments of row numbers; an entry is a row with the term's frequency
and the length of its text, all that BM25 needs. ``rows`` holds the stored columns by row, ``corpus`` the number of texts
and words. Rows are numbered as they are indexed, so null and repeated keys are rows like others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions.text import term_counts
from lotwise.operators.search import K1, B
from lotwise.sources.workspace import scratch, stage

SEGMENT = 1024


def write_index(df: DataFrame, path: str, text: str, stored: Sequence[str]) -> None:
    """Indexes a text column. One exchange carries the postings; texts and stored columns are not shuffled."""
    with scratch(df.sparkSession):
        counted = df.select(F.monotonically_increasing_id().alias("row"), *stored, term_counts(text).alias("_counts"))
        length = F.aggregate("_counts", F.lit(0), lambda total, one: total + one["tf"]).alias("length")
        counted = stage(counted.select("*", length), "counted")
        counted.select("row", "length", *stored).write.parquet(f"{path}/rows")
        counted.agg(F.count("*").alias("texts"), F.coalesce(F.sum("length"), F.lit(0)).alias("words")).coalesce(1).write.parquet(f"{path}/corpus")
        listed = counted.select("row", "length", F.explode("_counts").alias("one")).select("one.term", F.expr(f"row DIV {SEGMENT}").alias("segment"), "row", "one.tf", "length")
        # Segments are bounded by their row numbers, and the range exchange serves the grouping too.
        grouped = listed.repartitionByRange("term", "segment").groupBy("term", "segment")
        lists = grouped.agg(F.count("*").alias("documents"), F.sort_array(F.collect_list(F.struct("row", "tf", "length"))).alias("entries"))
        lists.sortWithinPartitions("term", "segment").write.parquet(f"{path}/terms")


class Index:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def lists(self, terms: Sequence[str]) -> DataFrame:
        """The posting segments of the terms; the scan skips files and row groups without them."""
        return self.spark.read.parquet(f"{self.path}/terms").where(F.col("term").isin(*_terms(terms)))

    def stored(self, found: DataFrame) -> DataFrame:
        """The stored columns of found rows, with the further columns of ``found``."""
        return self.spark.read.parquet(f"{self.path}/rows").drop("length").join(found, "row").drop("row")

    def with_all(self, terms: Sequence[str]) -> DataFrame:
        """Rows with every term: segments that all terms have, their lists intersected. Every row, if there are no terms."""
        wanted = _terms(terms)
        if not wanted:
            return self.spark.read.parquet(f"{self.path}/rows").drop("row", "length")
        listed = self.lists(terms).groupBy("segment").agg(F.collect_list(_rows(F.col("entries"))).alias("lists"))
        whole = listed.where(F.size("lists") == len(wanted))
        common = F.aggregate("lists", F.get("lists", F.lit(0)), F.array_intersect)
        return self.stored(whole.select(F.explode(common).alias("row")))

    def with_any(self, terms: Sequence[str]) -> DataFrame:
        """Rows with at least one term: the lists of a segment united."""
        listed = self.lists(terms).groupBy("segment").agg(F.collect_list(_rows(F.col("entries"))).alias("lists"))
        return self.stored(listed.select(F.explode(F.array_distinct(F.flatten("lists"))).alias("row")))

    def scored(self, terms: Sequence[str]) -> DataFrame:
        """Rows with at least one term and their BM25 ``score``, from the lists alone."""
        corpus = self.spark.read.parquet(f"{self.path}/corpus")
        lists = self.lists(terms)
        frequency = lists.groupBy(F.col("term").alias("of")).agg(F.sum("documents").alias("df"))  # a row for each term
        corpus = corpus.select(F.struct("texts", (F.col("words").cast("double") / F.col("texts")).alias("mean"))).scalar()
        # Each term once, however often the question names it, as a match with equal terms adds them up.
        often = F.create_map(*[F.lit(item) for term in _terms(terms) for item in (term, [t.lower() for t in terms].count(term))]) if terms else None
        entries = lists.join(F.broadcast(frequency), F.col("term") == F.col("of")).select("term", "df", F.explode("entries").alias("e")).withColumn("c", corpus)
        tf, df = F.col("e.tf"), F.col("df")
        idf = F.log(1 + (F.col("c.texts") - df + 0.5) / (df + 0.5))
        weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("e.length") / F.col("c.mean")))
        if often is not None:
            weight = weight * F.get(F.array(often[F.col("term")]), F.lit(0))
        return self.stored(entries.groupBy(F.col("e.row").alias("row")).agg(F.sum(weight).alias("score")))


def _terms(terms: Sequence[str]) -> list[str]:
    return sorted({term.lower() for term in terms})


def _rows(entries: Column) -> Column:
    return F.transform(entries, lambda one: one["row"])
