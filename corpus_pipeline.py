"""A training corpus from raw documents: every stage reads the Parquet that its predecessor wrote.

A stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``. Null texts count as empty, a null
id is an id like others, empty tables pass through, further columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import bpe, decontaminate, minhash, pii, quality
from lotwise.llm.members import with_listed
from lotwise.sources.tables import Tables
from lotwise.sources.workspace import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Per cent of shingles that two documents share at least to be near-copies; ``op8_minhash_near_duplicates`` has its own, 85.
NEAR = 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranker, learned from all labels of the folder, does not reject."""
    docs = docs.select(*COLUMNS)
    ranker = quality.trained(docs, Tables(spark, sf_dir).labels)
    return quality.scored(docs, ranker).where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays: the one with the smallest id, null ids last, and of that one row.

    A document is an id with a text: unlike texts that share an id are not copies of each other.
    """
    key = F.xxhash64("doc_id", "text").alias("key")
    docs = docs.select(*COLUMNS)
    found = minhash.near_duplicates(docs.select(key, "text"), key="key", percent=NEAR).withColumnRenamed("doc_id", "key")
    found = found.groupBy("key").agg(F.min("component_id").alias("component"), F.count("*").alias("rows"))
    named = docs.select(key, "doc_id").distinct().join(found, "key")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    best = named.groupBy("component").agg(F.min_by("key", order).alias("best"))
    found = stage(named.join(best, "component").select("key", "rows", (F.col("key") == F.col("best")).alias("kept")), "kept")
    # Most rows stay as they are, where they are; where a row is repeated, one of them does. Both parts of what may not stay
    # come from one join.
    changed = found.where("NOT kept OR rows > 1").select("key", "kept")
    told = with_listed(docs.withColumn("key", key), "key", changed.select("key"))
    marked = told.where("listed").join(changed, "key", "left")
    one = F.min_by(F.struct(*COLUMNS), F.xxhash64(*COLUMNS)).alias("row")
    once = marked.where("kept").groupBy("key", "doc_id", F.xxhash64("text")).agg(one).select("row.*")
    return told.where("NOT listed").select(*COLUMNS).unionByName(marked.where("kept IS NULL").select(*COLUMNS)).unionByName(once)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. An id in a struct joins also where it is null, the text tells repeats apart."""
    docs = docs.select(*COLUMNS)
    leaks = decontaminate.contaminated(docs, Tables(spark, sf_dir).benchmark, own="own")
    leaks = leaks.select(F.struct("doc_id", "own").alias("leak")).distinct()
    return docs.join(leaks, F.struct("doc_id", F.xxhash64("text").alias("own")) == F.col("leak"), "left_anti").select(*COLUMNS)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, ``n_chars`` counted anew where that changed the text."""
    spans = pii.with_spans(docs.select(*COLUMNS))
    changed = F.size("pii_spans") > 0
    text = F.when(changed, pii.redacted(F.col("text"), F.col("pii_spans"))).otherwise(F.col("text"))
    redacted = spans.withColumn("text", text)
    return redacted.withColumn("n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers of every text (unsigned 32-bit little-endian), their count, and what they read back to."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), "word_bpe_49k.json")
    count = F.expr("CAST(octet_length(token_ids) / 4 AS BIGINT)").alias("n_tokens")
    return encoded.select("doc_id", "lang", "source", count, "token_ids", "decoded")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", without_benchmarks),
    ("personal_data", without_personal_data),
    ("tokens", tokens),
]

#: Fitted models and hashed candidates have no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
