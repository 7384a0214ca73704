"""Readers, articles and categories: customers read parts through their orders; brand and type are categories."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators import graph
from lotwise.plans.registry import query

READ = "(SELECT o_custkey AS reader, l_partkey AS article, l_shipdate AS read_at, l_quantity AS rating FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"
IS_IN = "(SELECT p_partkey AS article, p_brand AS category FROM part UNION ALL SELECT p_partkey, p_type FROM part)"
MOST_READ = f"(SELECT article FROM {READ} GROUP BY article ORDER BY count(*) DESC, article LIMIT 1)"
MOST_ACTIVE = f"(SELECT reader FROM {READ} GROUP BY reader ORDER BY count(*) DESC, reader LIMIT 1)"


def read_edges(t):
    joined = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("o_custkey").alias("reader"),
        F.col("l_partkey").alias("article"),
        F.col("l_shipdate").alias("read_at"),
        F.col("l_quantity").alias("rating"),
    )


def category_links(t):
    article = F.col("p_partkey").alias("article")
    brands = t.part.select(article, F.col("p_brand").alias("category"))
    return brands.union(t.part.select(article, F.col("p_type")))


def _most(counted, column):
    counts = counted.groupBy(column).agg(F.sum("n").alias("_n"))
    return counts.orderBy(F.col("_n").desc(), column).limit(1).select(column).scalar()


@query(
    "GRF-1",
    f"""SELECT c_name AS reader, p_name AS article, strftime(read_at, '%Y-%m-%d') AS read_at, rating
        FROM {READ} JOIN customer ON c_custkey = reader JOIN part ON p_partkey = article""",
)
def one_hop(t):
    edges = read_edges(t)
    joined = edges.join(t.customer, F.col("c_custkey") == F.col("reader")).join(
        t.part, F.col("p_partkey") == F.col("article")
    )
    return joined.select(
        F.col("c_name").alias("reader"),
        F.col("p_name").alias("article"),
        F.date_format("read_at", "yyyy-MM-dd").alias("read_at"),
        "rating",
    )


SCATTERED = "(({0} % 2147483648) * 2654435761 % 4294967296)"


@query(
    "GRF-1-picked",
    f"""WITH placed AS (SELECT p_partkey AS article, row_number() OVER (ORDER BY {SCATTERED.format("p_partkey")}, p_partkey) - 1 AS place, count(*) OVER () AS n FROM part)
        SELECT c_custkey AS reader, article, 3 + (c_custkey * 7 + article) % 3 AS rating, strftime(TIMESTAMP '2024-01-01' + to_days(CAST((c_custkey + article) % 365 AS INTEGER)), '%Y-%m-%d') AS read_at
        FROM customer, (SELECT unnest(range(5)) AS i) JOIN placed ON place = ({SCATTERED.format("c_custkey")} + i) % n""",
)
def picked_articles(t):
    """Five articles for every reader, with a rating and a day by arithmetic on the keys."""
    edges = graph.picked(t.customer.select(F.col("c_custkey").alias("reader")), t.part.select(F.col("p_partkey").alias("article")), "reader", "article", 5)
    rating = 3 + (F.col("reader") * 7 + F.col("article")) % 3
    read_at = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("reader") + F.col("article")) % 365).cast("int")), "yyyy-MM-dd")
    return edges.select("reader", "article", rating.alias("rating"), read_at.alias("read_at"))


@query(
    "GRF-2",
    f"""SELECT reader, category, count(*) AS paths FROM {READ} JOIN {IS_IN} USING (article) GROUP BY reader, category""",
)
def categories_read(t):
    return graph.pairs_with_counts(read_edges(t), category_links(t), "reader", "article", "category", t.lineitem.count())


@query(
    "GRF-3",
    f"""SELECT c_name AS reader, articles_read FROM (SELECT reader, count(*) AS articles_read FROM {READ} GROUP BY reader
        ORDER BY articles_read DESC, reader LIMIT 10) JOIN customer ON c_custkey = reader""",
)
def most_active(t):
    degrees = read_edges(t).groupBy("reader").agg(F.count("*").alias("articles_read"))
    top = degrees.orderBy(F.col("articles_read").desc(), "reader").limit(10)
    joined = top.join(t.customer, F.col("c_custkey") == F.col("reader"))
    return joined.select(F.col("c_name").alias("reader"), "articles_read")


@query(
    "GRF-4",
    f"""SELECT article, count(DISTINCT reader) AS common_readers FROM {READ}
        WHERE reader IN (SELECT reader FROM {READ} WHERE article = {MOST_READ}) AND article <> {MOST_READ}
        GROUP BY article ORDER BY common_readers DESC, article LIMIT 10""",
)
def similar_articles(t):
    edges = graph.counted_edges(read_edges(t), "reader", "article", t.lineitem.count())
    return graph.similar_items(edges, "reader", "article", _most(edges, "article"), 10)


@query(
    "GRF-5",
    f"""WITH seen AS (SELECT DISTINCT article FROM {READ} WHERE reader = {MOST_ACTIVE}),
             known AS (SELECT DISTINCT category FROM {IS_IN} WHERE article IN (SELECT article FROM seen)),
             views AS (SELECT article, count(*) AS views FROM {READ} GROUP BY article)
        SELECT l.article, count(DISTINCT category) AS relevance,
               string_agg(DISTINCT category, ',' ORDER BY category) AS categories, coalesce(any_value(views), 0) AS views
        FROM {IS_IN} l LEFT JOIN views v ON v.article = l.article
        WHERE category IN (SELECT category FROM known) AND l.article NOT IN (SELECT article FROM seen)
        GROUP BY l.article ORDER BY relevance DESC, views DESC, l.article LIMIT 10""",
)
def recommendations(t):
    edges = graph.counted_edges(read_edges(t), "reader", "article", t.lineitem.count())
    views = edges.groupBy("article").agg(F.sum("n").alias("views"))
    who = _most(edges, "reader")
    return graph.recommend(edges, category_links(t), views, "reader", "article", "category", who, 10)


@query(
    "GRF-6",
    """WITH nodes AS (SELECT 'document' AS kind, doc_id AS id FROM documents
                      UNION ALL SELECT 'quality', quality FROM labels GROUP BY quality),
            edges AS (SELECT 'document' AS k1, doc_id AS i1, 'quality' AS k2, quality AS i2 FROM labels),
            both_ways AS (SELECT * FROM edges UNION ALL SELECT k2, i2, k1, i1 FROM edges)
       SELECT kind, id, coalesce(k2, 'none') AS other_kind, CAST(coalesce(i2, -1) AS BIGINT) AS other_id FROM nodes
       LEFT JOIN both_ways ON k1 = kind AND i1 = id""",
)
def all_nodes(t):
    document, quality = F.lit("document"), F.lit("quality")
    grades = t.labels.select(F.col("quality").cast("bigint").alias("id")).distinct()
    nodes = t.documents.select(document.alias("kind"), F.col("doc_id").alias("id")).union(grades.select(quality, "id"))
    edges = t.labels.select(
        document.alias("from_kind"),
        F.col("doc_id").alias("from_id"),
        quality.alias("to_kind"),
        F.col("quality").cast("bigint").alias("to_id"),
    )
    found = graph.with_neighbours(nodes, edges)
    return found.select(
        "kind",
        "id",
        F.coalesce("other_kind", F.lit("none")).alias("other_kind"),
        F.coalesce("other_id", F.lit(-1)).alias("other_id"),
    )


@query(
    "GRF-7",
    f"""WITH known AS (SELECT DISTINCT reader, article FROM {READ} WHERE rating > 25)
        SELECT reader, article, 'known' AS origin FROM known
        UNION ALL SELECT DISTINCT reader, article, 'new' FROM {READ} WHERE rating <= 25
          AND (reader, article) NOT IN (SELECT (reader, article) FROM known)""",
)
def merge_edges(t):
    edges = read_edges(t)
    known = edges.where("rating > 25").select("reader", "article").distinct().withColumn("origin", F.lit("known"))
    incoming = edges.where("rating <= 25").select("reader", "article").withColumn("origin", F.lit("new"))
    return graph.merge(known, incoming, ["reader", "article"])
