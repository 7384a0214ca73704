"""Full-text search as jobs over a document table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.text import term_counts, words
from lotwise.sources.workspace import stage

# The usual BM25 parameters.
K1, B = 1.2, 0.75


def _frequency(words_column: str, term: str) -> Column:
    return F.size(F.filter(words_column, lambda word: word == F.lit(term)))


def match(df: DataFrame, key: str, text: str, terms: Sequence[str]) -> DataFrame:
    """(key, score) of documents with at least one of the terms, scored by BM25.

    Only the query terms are counted, so the corpus is never exploded. One pass over the texts leaves a few numbers per
    document; those are written, and serve the corpus statistics and the scores. No text is shuffled. For texts that are
    asked more than once, ``operators.index`` keeps what this pass finds.
    """
    terms = [term.lower() for term in terms]
    listed = df.select(F.col(key), words(text).alias("_words"))
    counted = stage(
        listed.select(
            key,
            F.size("_words").alias("_length"),
            *[_frequency("_words", term).alias(f"_tf{i}") for i, term in enumerate(terms)],
        ),
        "term-counts",
    )
    statistics = counted.agg(
        F.struct(
            F.count("*").alias("n"),
            (F.sum("_length").cast("double") / F.count("*")).alias("mean"),
            *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))],
        )
    ).scalar()
    found = counted.where(F.greatest(*[F.col(f"_tf{i}") for i in range(len(terms))], F.lit(0)) > 0)
    scored = found.withColumn("_s", statistics)
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, df_i = F.col(f"_tf{i}"), F.col(f"_s.df{i}")
        idf = F.log(1 + (F.col("_s.n") - df_i + 0.5) / (df_i + 0.5))
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("_length") / F.col("_s.mean")))
    return scored.select(key, score.alias("score"))


def bool_query(df: DataFrame, must: Sequence[Column], should: Sequence[tuple[Column, float]]) -> DataFrame:
    """Rows that meet every ``must``; each optional clause only adds its weight to ``score``."""
    for condition in must:
        df = df.where(condition)
    score = F.lit(0.0)
    for condition, weight in should:
        score = score + F.when(condition, weight).otherwise(0.0)
    return df.withColumn("score", score)


def postings(df: DataFrame, key: str, text: str, segment: int = 1024) -> DataFrame:
    """Inverted index: for each term and range of ``segment`` document ids, the ids with their term frequency.

    A common word occurs in a third of the documents; its posting list is kept in segments that stay small. Words are
    counted inside each row, so no text is shuffled; the counts of rows that repeat an id are added up before and after
    they are dealt out by id and term, so that an id with a third of all rows is spread over the tasks.
    """
    listed = df.select(F.col(key), F.explode(term_counts(text)).alias("_one")).select(key, "_one.*")
    counted = listed.groupBy(key, "term").agg(F.sum("tf").alias("tf"))
    part = F.expr(f"`{key}` div {segment}").alias("segment")
    gathered = counted.groupBy("term", part).agg(
        F.count("*").alias("documents"),
        F.sum("tf").alias("occurrences"),
        F.sort_array(F.collect_list(F.struct(F.col(key).alias("id"), "tf"))).alias("_list"),
    )
    written = F.transform("_list", lambda p: F.concat(p["id"].cast("string"), F.lit(":"), p["tf"].cast("string")))
    return gathered.select("term", "segment", "documents", "occurrences", F.array_join(written, " ").alias("postings"))
