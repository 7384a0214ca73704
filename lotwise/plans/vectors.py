"""Exact vector search over the embeddings, with labels and documents as payload."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators.change import upsert
from lotwise.operators.vectors import fault_of, top_k, top_k_each
from lotwise.plans.registry import query

SQL_COSINE = """round(list_inner_product(CAST(e.embedding AS DOUBLE[]), q.v)
                / (sqrt(list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))
                   * sqrt(list_inner_product(q.v, q.v))), 9)"""
SQL_QUERY = "(SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0) q"


def _query_vector(t):
    return t.embeddings.where("vec_id = 0").select("embedding").scalar()


def _payload(t):
    # A vector without a document or a label stays; only a filter on their fields drops it.
    vectors = t.embeddings.join(t.documents.withColumnRenamed("doc_id", "_doc"), F.col("_doc") == F.col("vec_id"), "left")
    return vectors.join(t.labels.withColumnRenamed("doc_id", "_labelled"), F.col("_labelled") == F.col("vec_id"), "left")


def _shown(df):
    return df.select("vec_id", "label", F.round("score", 6).alias("score"))


@query("VEC-1", "SELECT label, count(*) AS vectors, CAST(0 AS BIGINT) AS faults FROM embeddings GROUP BY label")
def collection_check(t):
    return t.embeddings.groupBy("label").agg(F.count("*").alias("vectors"), F.count(fault_of("embedding", 64)).alias("faults"))


@query(
    "VEC-2",
    f"""SELECT vec_id, label, round(score, 6) AS score FROM (SELECT vec_id, label, {SQL_COSINE} AS score FROM embeddings e, {SQL_QUERY})
        ORDER BY score DESC, vec_id LIMIT 3""",
)
def nearest(t):
    return _shown(top_k(t.embeddings, "vec_id", "embedding", _query_vector(t), 3))


FILTERED = """SELECT vec_id, label, round(s, 6) AS score
              FROM (SELECT vec_id, label, quality, n_chars, {cosine} AS s FROM embeddings e
                    LEFT JOIN documents d ON d.doc_id = e.vec_id LEFT JOIN labels l ON l.doc_id = e.vec_id, {query})
              WHERE {condition} ORDER BY s DESC, vec_id LIMIT {k}"""


def _filtered_sql(condition, k):
    return FILTERED.format(cosine=SQL_COSINE, query=SQL_QUERY, condition=condition, k=k)


def _filtered(t, condition, k):
    return _shown(top_k(_payload(t).where(condition), "vec_id", "embedding", _query_vector(t), k))


@query("VEC-3", _filtered_sql("label = 3 AND quality >= 1", 5))
def nearest_in_category(t):
    return _filtered(t, "label = 3 AND quality >= 1", 5)


@query("VEC-4", _filtered_sql("n_chars > 2000", 5))
def nearest_above(t):
    return _filtered(t, "n_chars > 2000", 5)


@query("VEC-5", _filtered_sql("label IN (1, 2) AND quality >= 1 AND n_chars BETWEEN 500 AND 5000", 10))
def nearest_any_of(t):
    return _filtered(t, "label IN (1, 2) AND quality >= 1 AND n_chars BETWEEN 500 AND 5000", 10)


@query(
    "VEC-6",
    f"""WITH firsts AS (SELECT label AS query, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
                        WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label)),
             scored AS (SELECT query, vec_id, {SQL_COSINE} AS score FROM embeddings e, firsts q),
             placed AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS place FROM scored)
        SELECT CAST(query AS BIGINT) AS query, vec_id, round(score, 6) AS score, place FROM placed WHERE place <= 5""",
)
def nearest_for_many(t):
    firsts = t.embeddings.groupBy(F.col("label").cast("bigint").alias("query")).agg(
        F.min_by("embedding", "vec_id").alias("embedding")
    )
    found = top_k_each(t.embeddings, "vec_id", "embedding", firsts, "query", 5)
    return found.withColumn("score", F.round("score", 6))


@query(
    "VEC-7",
    """SELECT vec_id, label, len(embedding) AS size FROM embeddings WHERE label <> 0
       UNION ALL SELECT vec_id, 100, len(embedding) FROM embeddings WHERE label = 0""",
)
def upsert_points(t):
    incoming = t.embeddings.where("label = 0").withColumn("label", F.lit(100))
    points = upsert(t.embeddings, incoming, ["vec_id"])
    return points.select("vec_id", "label", F.size("embedding").cast("bigint").alias("size"))
