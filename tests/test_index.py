"""Search from written lists: the rows of a scan, without one."""

import random

import pytest
from pyspark.sql import functions as F

from lotwise.functions import text
from lotwise.functions.text import term_counts, trigram_similarity
from lotwise.operators import search, trigrams
from lotwise.operators.index import SEGMENT, Index, write_index
from lotwise.operators.search import match
from lotwise.plans import CATALOGUE
from lotwise.sources.workspace import new_path
from tests.conftest import SMALL

WORDS = ["red", "blue", "Ring", "bolt", "nut", "wheel", "ÉTÉ", "x1", "the"]


def documents(spark, count=3000):
    pick = random.Random(6)
    rows = [(n % 700 if n % 11 else None, pick.choice("ab"), " ".join(pick.choices(WORDS, k=pick.randint(0, 30)))) for n in range(count)]
    rows += [(1, "a", None), (2, "b", ""), (3, None, "the the THE red " * 500)]
    return spark.createDataFrame(rows, "id bigint, kind string, body string").repartition(5)


@pytest.fixture(scope="module")
def indexed(spark):
    path = new_path(spark, "index")
    docs = documents(spark).cache()
    write_index(docs, path, "body", ["id", "kind"])
    return docs, Index(spark, path), path


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("terms", [["red"], ["Red", "the", "RED"], ["red", "blue", "x1", "été"], ["absent", "red"], ["absent"]])
def test_all_and_any_equal_scans(indexed, terms):
    docs, index, _ = indexed
    tokens = text.tokens("body")
    assert rows(index.with_all(terms)) == rows(docs.where(text.has_all(tokens, terms)).select("id", "kind"))
    assert rows(index.with_any(terms)) == rows(docs.where(text.has_any(tokens, terms)).select("id", "kind"))


def test_scores_equal_scans(indexed):
    docs, index, _ = indexed
    for terms in (["the"], ["the", "bolt", "Été"], ["nut", "absent"], ["nut", "NUT"]):
        found = index.scored(terms).select("id", "kind", F.round("score", 9).alias("s"))
        want = match(docs.withColumn("key", F.struct("id", "kind")), "key", "body", terms).select("key.*", F.round("score", 9).alias("s"))
        assert rows(found) == rows(want) and found.count() > 0


def test_lists_are_cut_into_segments(spark, indexed):
    _, _, path = indexed
    lists = spark.read.parquet(f"{path}/terms")
    assert lists.agg(F.max("documents")).first()[0] <= SEGMENT
    assert lists.where("term = 'the'").count() > 1
    assert lists.groupBy("term", "segment").count().where("count > 1").count() == 0


@pytest.mark.parametrize("key", ["TXT-2", "TXT-3", "TXT-7"])
def test_queries_read_no_documents(spark, key):
    df = CATALOGUE[key](spark, SMALL)
    assert not [path for path in df.inputFiles() if "documents.parquet" in path]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term" in plan or "EqualTo(term" in plan


def test_counts_of_words(spark):
    df = spark.createDataFrame([("b a B a-a, c",), ("",), (None,), ("x " * 5000,)], "body string")
    found = [[tuple(one) for one in row[0]] for row in df.select(term_counts("body")).collect()]
    assert found == [[("a", 3), ("b", 2), ("c", 1)], [], [], [("x", 5000)]]


def test_postings_of_a_repeated_id_are_spread(spark, many_slices):
    df = spark.createDataFrame([(None if n % 3 == 0 else n % 7, f"w{n % 50} common") for n in range(6000)], "id bigint, body string").repartition(6)
    found = {(r["term"], r["segment"]): r for r in search.postings(df, "id", "body").collect()}
    assert found["common", 0]["documents"] == 7 and found["common", 0]["occurrences"] == 4000
    assert found["common", None]["occurrences"] == 2000
    plan = search.postings(df, "id", "body")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if " Exchange " in line]
    assert len(exchanges) == 2 + 1 and not any("body" in line for line in exchanges if "hashpartitioning(id" in line and "term" not in line)
    assert "RoundRobin" in exchanges[-1]  # that of the test's own repartition


NAMES = ["small red ring", "red ring", "small ring", "large blue bolt", "tiny nut", "smell rad rang", "", "!!", None, "ring red small", "smallredring", "blue bolts"]


@pytest.fixture(scope="module")
def named(spark):
    pick = random.Random(1)
    more = [" ".join(pick.choices(["large", "small", "blue", "green", "wheel", "nut", "axle", "pump", "gear"], k=3)) + f" {n}" for n in range(600)]
    names = spark.createDataFrame([(name,) for name in NAMES + more + more[:50]], "name string")
    path = new_path(spark, "pieces")
    trigrams.write_trigrams(names, "name", path)
    return names, path


@pytest.mark.parametrize("question", ["small red ring", "blue bolt", "gear 17", "zzz", "", "a"])
def test_similar_names_equal_scan(spark, named, question):
    names, path = named
    every = names.distinct().withColumn("similarity", trigram_similarity("name", F.lit(question)))
    for least in (0.2, 0.5, 1.0):
        assert rows(trigrams.similar(spark, path, question, least)) == rows(every.where(F.col("similarity") >= least))
    for k in (1, 5, 40):
        found, enough = trigrams.nearest(spark, path, question, k)
        order = sorted((r["similarity"] for r in every.collect()), reverse=True)
        sharing = every.where("similarity > 0")
        assert enough == (sharing.count() >= k)
        assert rows(found) == rows(sharing.where(F.col("similarity") >= order[k - 1]) if enough else sharing)


def test_few_names_are_measured(spark, named):
    names, path = named
    wanted = trigrams.pieces_of(spark, "small red ring")
    lists = trigrams._lists(spark, path, wanted)
    short = trigrams._by_length(lists, wanted)
    # Where the five nearest are known after half of the lists, the names on those are all that was measured.
    measured = trigrams.candidates(lists, short[: len(short) // 2], len(wanted)).count()
    assert measured < 0.1 * names.distinct().count()


def test_a_threshold_of_zero_is_refused(spark, named):
    with pytest.raises(ValueError):
        trigrams.similar(spark, named[1], "ring", 0.0)


def test_words_and_lists_are_sorted_natively(indexed):
    """No comparison by expression for each pair of words or entries."""
    docs, _, path = indexed
    for df in (docs.select(term_counts("body")), search.postings(docs, "id", "body")):
        assert "lambdafunction(if" not in df._jdf.queryExecution().analyzed().toString().lower()
    lists = docs.sparkSession.read.parquet(f"{path}/terms")
    assert lists.where("documents <> size(entries) OR entries <> array_sort(entries)").count() == 0
