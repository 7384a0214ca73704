"""Quantified comparisons, quality rules, text, ranges, geometry, vectors and graph patterns on fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.functions import geo, ranges, text
from lotwise.functions.bands import price_band
from lotwise.operators import graph, quality, search, subqueries, vectors


def rows(df, *names):
    return sorted(map(tuple, df.select(*names).collect() if names else df.collect()), key=repr)


@pytest.mark.parametrize(
    "values,above_all,above_any,below_any",
    [
        ([1, 3], [4], [2, 3, 4], [0, 1, 2]),
        ([1, None, 3], [], [2, 3, 4], [0, 1, 2]),
        ([None], [], [], []),
        ([], [0, 1, 2, 3, 4], [], []),
    ],
)
def test_quantified(spark, values, above_all, above_any, below_any):
    x = spark.range(5).select(F.col("id").cast("int").alias("x"))
    s = spark.createDataFrame([(v,) for v in values], "v int")
    got = lambda condition: [r[0] for r in sorted(x.where(condition).collect())]
    assert got(subqueries.greater_than_all(F.col("x"), s)) == above_all
    assert got(subqueries.greater_than_any(F.col("x"), s)) == above_any
    assert got(subqueries.less_than_any(F.col("x"), s)) == below_any


def test_null_never_passes_a_comparison(spark):
    x = spark.createDataFrame([(None,), (9,)], "x int")
    s = spark.createDataFrame([(1,)], "v int")
    assert rows(x.where(subqueries.greater_than_all(F.col("x"), s))) == [(9,)]


def test_every_dictionary_entry(spark):
    pairs = subqueries.with_each_entry(spark.range(3), spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "name string"))
    assert sorted(map(str, pairs.select("id", "name").collect())) == sorted(
        f"Row(id={i}, name={name!r})" for i in range(3) for name in ("a", "b", "b", None)
    )
    large = spark.range(5000).withColumnRenamed("id", "n")
    pairs = subqueries.with_each_entry(spark.range(7), large)
    assert pairs.count() == pairs.distinct().count() == 35_000
    assert subqueries.with_each_entry(spark.range(3), large.where("n < 0")).count() == 0


def test_rules(spark):
    df = spark.createDataFrame(
        [(1, "+79991234567", "x@mail.test", 5), (2, "123", "bad", -1), (3, None, None, None), (4, "+7999", "y@z.io", 0)],
        "id int, phone string, email string, price int",
    )
    rules = {
        "phone": F.col("phone").rlike(quality.PHONE),
        "email": F.col("email").rlike(quality.EMAIL),
        "price": F.col("price") >= 0,
        "phone given": quality.present("phone"),
    }
    assert rows(quality.violations(df, "id", rules)) == [(2, "email"), (2, "phone"), (2, "price"), (3, "phone given"), (4, "phone")]
    assert dict(rows(quality.rule_counts(df, rules))) == {"phone": 2, "email": 1, "price": 1, "phone given": 1}
    assert quality.missing_columns(df, ["id", "vin", "code"]) == ["code", "vin"]


def test_keys(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 9), (3, 9)], "id int, parent int")
    parent = spark.createDataFrame([(1,)], "pid int")
    assert rows(quality.duplicates(child, ["id", "parent"])) == [(3, 9, 2)]
    assert rows(quality.orphans(child, parent, "parent", "pid")) == [(3, 9), (3, 9)]


def test_trigrams(spark):
    one = spark.range(1)
    got = lambda c: one.select(c).first()[0]
    assert sorted(got(text.trigrams(F.lit("Word")))) == ["  w", " wo", "ord", "rd ", "wor"]
    assert got(text.trigram_similarity(F.lit("word"), F.lit("two words"))) == pytest.approx(4 / 11)
    assert got(text.trigram_similarity(F.lit("Тест"), F.lit("тест"))) == 1.0
    assert got(text.trigram_similarity(F.lit(""), F.lit("!!"))) == 0.0


def test_words_and_headers(spark):
    one = spark.range(1)
    got = lambda c: one.select(c).first()[0]
    assert got(text.words(F.lit("Один, two-ONE"), F.lit(None).cast("string"), F.lit("x2!"))) == ["один", "two", "one", "x2"]
    assert got(text.tokens(F.lit("a b A"))) == ["a", "b"]
    assert got(text.header(F.lit("  ПРОДАМ   АВТОМОБИЛЬ  "))) == "Продам автомобиль"
    assert got(text.vin(F.lit(" jh4ka8260pc123456 "))) == "JH4KA8260PC123456"
    assert got(text.has_all(text.tokens(F.lit("Toyota Camry")), ["toyota", "Camry"])) is True
    assert got(text.has_any(text.tokens(F.lit("Toyota Camry")), ["urgent", "owner"])) is False


def test_price_bands(spark):
    df = spark.createDataFrame([(None,), (999999,), (1000000,), (3000000,), (5000000,)], "p int")
    assert [r[0] for r in df.select(price_band(F.col("p"))).collect()] == ["no price", "budget", "middle", "premium", "luxury"]


def test_range_bounds(spark):
    def overlap(a, b):
        make = lambda lo, hi, k: ranges.make_range(F.lit(lo).cast("int"), F.lit(hi).cast("int"), k)
        return spark.range(1).select(ranges.overlaps(make(*a), make(*b))).first()[0]

    assert overlap((1, 5, "[]"), (5, 9, "[]"))
    assert not overlap((1, 5, "[)"), (5, 9, "[]"))
    assert not overlap((1, 5, "[]"), (5, 9, "(]"))
    assert overlap((None, 5, "[]"), (3, None, "[]"))
    assert not overlap((5, 5, "[)"), (1, 9, "[]"))
    assert not overlap((6, 2, "[]"), (1, 9, "[]"))


def test_geometry(spark):
    points = spark.createDataFrame([(58.0, 45.0), (58.0, 45.1), (61.0, 44.0), (61.1, 44.0), (None, 1.0)], "x double, y double")
    x, y = F.col("x"), F.col("y")
    inside = points.where(geo.in_circle(x, y, (58, 40), 5))
    plain = points.where(F.pow(x - 58, 2) + F.pow(y - 40, 2) <= 25)
    assert rows(inside) == rows(plain) == [(58.0, 45.0), (61.0, 44.0)]
    box = geo.in_box(x, y, (60, 45), (56, 38))
    assert rows(points.where(box)) == [(58.0, 45.0)]


@pytest.fixture
def points(spark):
    draw = np.random.default_rng(5)
    values = draw.normal(size=(300, 8)).astype(np.float32)
    values[100:200] = values[100]  # a third of the vectors are copies
    values[7] = 0
    return values, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "id bigint, v array<float>").repartition(7)


def brute_force(values, query, k):
    data, q = values.astype(np.float64), query.astype(np.float64)
    with np.errstate(invalid="ignore"):
        scores = np.round(data @ q / (np.linalg.norm(data, axis=1) * np.linalg.norm(q)), 9)
    order = sorted((i for i in range(len(data)) if not np.isnan(scores[i])), key=lambda i: (-scores[i], i))
    return order[:k]


@pytest.mark.parametrize("query", [0, 100, 250])
def test_nearest_one(spark, points, query):
    values, df = points
    wanted = df.where(F.col("id") == query).select("v").scalar()
    found = vectors.top_k(df, "id", "v", wanted, 5)
    assert [r["id"] for r in found.orderBy(F.col("score").desc(), "id").collect()] == brute_force(values, values[query], 5)


@pytest.mark.parametrize("at_once", [1024, 4])
def test_nearest_many(points, at_once, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", at_once)
    monkeypatch.setattr(vectors, "SLICE", 10 * at_once)
    values, df = points
    queries = df.where("id % 30 = 10").select(F.col("id").alias("q"), "v")
    found = vectors.top_k_each(df, "id", "v", queries, "q", 4).orderBy("q", "place").collect()
    for query in range(10, 300, 30):
        assert [r["id"] for r in found if r["q"] == query] == brute_force(values, values[query], 4)


def test_nearest_many_of_unlike_sizes(spark):
    data = [("a", [1.0, 0.0]), ("b", [1.0, 1.0]), ("c", [1.0]), ("d", [0.0, 0.0]), ("e", None), ("f", [1.0, None]), ("g", [3.0, 1.0, 2.0])]
    df = spark.createDataFrame(data, "id string, v array<float>")
    queries = spark.createDataFrame([("two", [2.0, 0.0]), ("one", [-1.0]), ("zero", [0.0, 0.0])], "q string, v array<float>")
    found = vectors.top_k_each(df, "id", "v", queries, "q", 2).orderBy("q", "place").collect()
    assert [(r["q"], r["id"], r["score"]) for r in found] == [("one", "c", -1.0), ("two", "a", 1.0), ("two", "b", 0.707106781)]


def test_collection_faults(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0]), (4, None), (5, [1.0, None])], "id int, v array<float>")
    assert rows(vectors.collection_faults(df, "id", "v", 2)) == [(2, "zero"), (3, "size"), (4, "missing"), (5, "null element")]


def test_graph(spark):
    edges = spark.createDataFrame([("u", 1), ("u", 1), ("u", 2), ("v", 1), ("v", 3), ("w", 3), ("w", 4)], "reader string, article int")
    links = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, "x"), (4, "y"), (5, "z")], "article int, category string")
    assert rows(graph.pairs_with_counts(edges, links, "reader", "article", "category")) == [("u", "x", 2), ("u", "y", 1), ("v", "x", 2), ("w", "x", 2), ("w", "y", 1)]
    assert [tuple(r) for r in graph.similar_items(graph.counted_edges(edges, "reader", "article"), "reader", "article", F.lit(1), 5).collect()] == [(2, 1), (3, 1)]
    views = edges.groupBy("article").agg(F.count("*").alias("views"))
    found = graph.recommend(edges, links, views, "reader", "article", "category", F.lit("u"), 5)
    assert [tuple(r) for r in found.collect()] == [(4, 2, "x,y", 1), (3, 1, "x", 2)]
    merged = graph.merge(edges.distinct(), spark.createDataFrame([("u", 1), ("z", 9), ("z", 9)], "reader string, article int"), ["reader", "article"])
    assert merged.count() == 7


def test_partitions_of_paths_follow_the_edges(spark, monkeypatch):
    """The shuffles have a partition for each share of the edges, and the session's settings are as before afterwards."""
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before, seen, real = [spark.conf.get(name) for name in names], [], graph.stage
    monkeypatch.setattr(graph, "stage", lambda df, label: seen.append(int(spark.conf.get(names[0]))) or real(df, label))
    monkeypatch.setattr("lotwise.sources.workspace.TASK_ROWS", 100)
    edges = spark.range(5000).selectExpr("id % 70 AS reader", "id % 9 AS article")
    links = spark.range(9).selectExpr("id AS article", "id % 2 AS category")
    found = graph.pairs_with_counts(edges, links, "reader", "article", "category", 5000)
    graph.counted_edges(edges, "reader", "article", 5000)
    graph.counted_edges(edges, "reader", "article")
    assert seen == [50, 50, int(before[0])] and [spark.conf.get(name) for name in names] == before
    counts = {(r["reader"], r["category"]): r["paths"] for r in found.collect()}
    assert len(counts) == 140 and sum(counts.values()) == 5000


def test_every_reader_picks_different_items(spark):
    readers, items = spark.range(300).withColumnRenamed("id", "r"), spark.range(1000, 1040).withColumnRenamed("id", "i")
    found = graph.picked(readers.union(readers), items, "r", "i", 5).collect()
    assert len(found) == len(set(map(tuple, found))) == 1500
    assert len({r["i"] for r in found}) == 40 and len({tuple(sorted(r["i"] for r in found if r["r"] == n)) for n in range(300)}) > 20
    assert graph.picked(readers, items.limit(3), "r", "i", 5).count() == 900
    assert graph.picked(readers, items.limit(0), "r", "i", 5).count() == 0


def test_bool_query_and_postings(spark):
    df = spark.createDataFrame([(1, "Samsung phone", 900), (2, "phone", 800), (3, "phone", 10)], "id bigint, name string, price int")
    found = search.bool_query(df, [F.col("price") >= 800], [(text.has_any(text.tokens("name"), ["Samsung"]), 1.0)])
    assert rows(found, "id", "score") == [(1, 1.0), (2, 0.0)]
    assert rows(search.postings(df, "id", "name", 2), "term", "segment", "postings") == [("phone", 0, "1:1"), ("phone", 1, "2:1 3:1"), ("samsung", 0, "1:1")]


def test_pairs_of_equal_predicates(spark):
    """The array and JSON predicates that have two written forms give the same rows."""
    df = spark.createDataFrame([(1, ["abs", "esp"], '{"marketing": true}'), (2, ["abs"], '{"marketing": false}'), (3, [], "{}"), (4, None, None)], "id int, features array<string>, profile string")
    overlap = df.where(F.arrays_overlap("features", F.array(F.lit("bluetooth"), F.lit("abs"))))
    unnested = df.where(F.exists("features", lambda f: f.isin("bluetooth", "abs")))
    assert rows(overlap, "id") == rows(unnested, "id") == [(1,), (2,)]
    contains = df.where(F.size(F.array_except(F.array(F.lit("abs"), F.lit("esp")), F.col("features"))) == 0)
    chained = df.where(F.array_contains("features", "abs") & F.array_contains("features", "esp"))
    assert rows(contains, "id") == rows(chained, "id") == [(1,)]
    contained = df.where(F.try_variant_get(F.try_parse_json("profile"), "$.marketing", "boolean"))
    extracted = df.where(F.get_json_object("profile", "$.marketing").cast("boolean"))
    assert rows(contained, "id") == rows(extracted, "id") == [(1,)]
