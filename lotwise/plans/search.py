"""Text, array, JSON, range and geometry search. The pairs of equivalent predicates are compared in the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions import text
from lotwise.functions.json import contains
from lotwise.functions.ranges import around_highest, make_range, overlaps
from lotwise.operators import trigrams
from lotwise.operators.index import Index, write_index
from lotwise.operators.search import bool_query, postings
from lotwise.plans.registry import query
from lotwise.sources.grid import points_in_box, points_in_circle, write_points
from lotwise.sources.workspace import layout

WORDS = r"list_filter(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
TOKENS = "list_distinct(" + WORDS + ")"
TRIGRAMS = (
    "list_distinct(flatten(list_transform({words}, lambda w: list_transform(generate_series(1, length(w) + 1), "
    "lambda i: substring('  ' || w || ' ', i, 3)))))"
)


def _similarity(left: str, right: str) -> str:
    a, b = (TRIGRAMS.format(words=WORDS.format(item)) for item in (left, right))
    return f"CAST(len(list_intersect({a}, {b})) AS DOUBLE) / len(list_distinct(list_concat({a}, {b})))"


@query(
    "TXT-1",
    f"SELECT doc_id, len({TOKENS.format(chr(39) + chr(39) + ' || source || ' + chr(39) + ' ' + chr(39) + ' || text')}) AS size FROM documents",
)
def token_sets(t):
    return t.documents.select("doc_id", F.size(text.tokens("source", "text")).cast("bigint").alias("size"))


def _index(t) -> Index:
    """The full-text index of the documents, written once for these data."""
    return Index(t.spark, layout(t.spark, "texts", [t.path("documents")], lambda path: write_index(t.documents, path, "text", ["doc_id", "source"])))


def _names(t) -> str:
    """The pieces of the part names, written once for these data."""
    return layout(t.spark, "names", [t.path("part")], lambda path: trigrams.write_trigrams(t.part, "p_name", path))


@query(
    "TXT-2",
    f"SELECT doc_id, source FROM documents WHERE list_has_all({TOKENS.format('text')}, ['the', 'by', 'in'])",
)
def all_terms(t):
    return _index(t).with_all(["the", "by", "in"]).select("doc_id", "source")


@query(
    "TXT-3",
    f"SELECT doc_id, source FROM documents WHERE list_has_any({TOKENS.format('text')}, ['owner', 'nicht', 'que'])",
)
def any_term(t):
    return _index(t).with_any(["owner", "nicht", "que"]).select("doc_id", "source")


@query("TXT-4", "SELECT doc_id, source FROM documents WHERE lower(text) LIKE '%the%'")
def substring(t):
    return t.documents.where(F.lower("text").contains("the")).select("doc_id", "source")


@query(
    "TXT-5",
    f"""SELECT p_partkey, p_name, similarity FROM (SELECT p_partkey, p_name, {_similarity("p_name", "'blue bolt'")} AS similarity FROM part)
        WHERE similarity >= 0.2""",
)
def similar_names(t):
    found = trigrams.similar(t.spark, _names(t), "blue bolt", 0.2)
    return t.part.join(found, F.col("p_name") == F.col("name")).select("p_partkey", "p_name", "similarity")


@query(
    "TXT-6",
    f"""SELECT p_partkey, p_name, 1 - {_similarity("p_name", "'small red ring'")} AS distance FROM part
        ORDER BY distance, p_partkey LIMIT 5""",
)
def nearest_names(t):
    parts = t.part.select("p_partkey", "p_name")
    found, enough = trigrams.nearest(t.spark, _names(t), "small red ring", 5)
    measured = parts.join(found, F.col("p_name") == F.col("name")).select("p_partkey", "p_name", (1 - F.col("similarity")).alias("distance"))
    if not enough:  # then ``found`` has every name that shares anything, and the others are all equally far
        others = parts.join(found, F.col("p_name") == F.col("name"), "left_anti").withColumn("distance", F.lit(1.0))
        measured = measured.unionByName(others)
    return measured.orderBy("distance", "p_partkey").limit(5)


def _tf(i: int, term: str) -> str:
    return f"len(list_filter(words, lambda w: w = '{term}')) AS tf{i}"


def _bm25(i: int) -> str:
    return (
        f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (1 - 0.75 + 0.75 * length / mean))"
    )


@query(
    "TXT-7",
    f"""WITH counted AS (SELECT doc_id, len(words) AS length, {_tf(0, "the")}, {_tf(1, "que")}
                         FROM (SELECT doc_id, {WORDS.format("text")} AS words FROM documents)),
             stats AS (SELECT count(*) AS n, sum(length) / count(*) AS mean, count(*) FILTER (WHERE tf0 > 0) AS df0,
                              count(*) FILTER (WHERE tf1 > 0) AS df1 FROM counted)
        SELECT doc_id, round({_bm25(0)} + {_bm25(1)}, 6) AS score FROM counted, stats WHERE tf0 + tf1 > 0""",
)
def analysed_match(t):
    scored = _index(t).scored(["The", "que"])
    return scored.select("doc_id", F.round("score", 6).alias("score"))


@query("TXT-8", "SELECT doc_id, n_chars FROM documents WHERE lang = 'fr'")
def exact_term(t):
    return t.documents.where("lang = 'fr'").select("doc_id", "n_chars")


@query("TXT-9", "SELECT doc_id, n_chars FROM documents WHERE n_chars BETWEEN 100 AND 900")
def number_range(t):
    return t.documents.where(F.col("n_chars").between(100, 900)).select("doc_id", "n_chars")


@query(
    "TXT-10",
    f"""SELECT doc_id, lang, n_chars, CASE WHEN list_contains({TOKENS.format("text")}, 'the') THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS score
        FROM documents JOIN labels USING (doc_id) WHERE lang = 'en' AND n_chars >= 800 AND quality = 1""",
)
def combined_query(t):
    products = t.documents.join(t.labels, "doc_id")
    found = bool_query(
        products,
        must=[F.col("lang") == "en", F.col("n_chars") >= 800, F.col("quality") == 1],
        should=[(text.has_any(text.tokens("text"), ["the"]), 1.0)],
    )
    return found.select("doc_id", "lang", "n_chars", "score")


@query(
    "TXT-11",
    f"""WITH counted AS (SELECT doc_id, term, count(*) AS tf
                         FROM (SELECT doc_id, unnest({WORDS.format("text")}) AS term FROM documents) GROUP BY ALL)
        SELECT term, doc_id // 1024 AS segment, count(*) AS documents, CAST(sum(tf) AS BIGINT) AS occurrences,
               string_agg(doc_id || ':' || tf, ' ' ORDER BY doc_id) AS postings
        FROM counted GROUP BY term, doc_id // 1024""",
)
def inverted_index(t):
    return postings(t.documents, "doc_id", "text")


FEATURES = "string_split(p_name, ' ')"


def _parts(t):
    return t.part.select("p_partkey", "p_brand", "p_name", F.split("p_name", " ").alias("features"))


@query("ARR-1", f"SELECT p_partkey, p_brand, p_name FROM part WHERE list_has_any({FEATURES}, ['blue', 'ring'])")
def array_overlap(t):
    wanted = F.array(F.lit("blue"), F.lit("ring"))
    return _parts(t).where(F.arrays_overlap("features", wanted)).drop("features")


@query("ARR-2", f"SELECT p_partkey, p_brand, p_name FROM part WHERE list_has_all({FEATURES}, ['blue', 'ring'])")
def array_contains_all(t):
    wanted = F.array(F.lit("blue"), F.lit("ring"))
    return _parts(t).where(F.size(F.array_except(wanted, F.col("features"))) == 0).drop("features")


@query("ARR-3", f"SELECT p_partkey, p_brand, p_name FROM part WHERE 'red' = ANY({FEATURES}) AND 'bolt' = ANY({FEATURES})")
def any_chain(t):
    both = F.array_contains("features", "red") & F.array_contains("features", "bolt")
    return _parts(t).where(both).drop("features")


@query(
    "ARR-4",
    f"SELECT p_partkey, p_brand, p_name FROM part WHERE len(list_filter({FEATURES}, lambda f: f IN ('blue', 'ring'))) > 0",
)
def exists_in_unnested(t):
    return _parts(t).where(F.exists("features", lambda f: f.isin("blue", "ring"))).drop("features")


@query(
    "ARR-5",
    f"""SELECT p_partkey, CAST(len(list_filter({FEATURES}, lambda f: f <> 'ring')) AS INTEGER) AS features,
               len(list_filter({FEATURES}, lambda f: f = 'ring')) = 0 AS without_ring FROM part""",
)
def cardinality(t):
    others = F.filter("features", lambda f: f != "ring")
    rings = F.filter("features", lambda f: f == "ring")
    return _parts(t).select("p_partkey", F.size(others).alias("features"), (F.size(rings) == 0).alias("without_ring"))


# The feature set given to a vehicle by the last digit class of its id.
FEATURE_SETS = (
    ("abs", "esp", "heated_seats"),
    ("bluetooth", "abs", "camera"),
    ("cruise_control", "esp", "sensors"),
    ("bluetooth", "navigation", "autopilot"),
    ("4wd", "tow_bar", "abs"),
)


@query(
    "ARR-6",
    "SELECT p_partkey, CASE p_partkey % 5 "
    + " ".join(f"WHEN {i} THEN '{','.join(names)}'" for i, names in enumerate(FEATURE_SETS))
    + " END AS features FROM part",
)
def feature_sets(t):
    rest = F.col("p_partkey") % len(FEATURE_SETS)
    chosen = F.array(*[F.lit(item) for item in FEATURE_SETS[-1]])
    for number, names in enumerate(FEATURE_SETS[:-1]):
        chosen = F.when(rest == number, F.array(*[F.lit(item) for item in names])).otherwise(chosen)
    return t.part.select("p_partkey", F.array_join(chosen, ",").alias("features"))


@query("JSN-1", """SELECT event_id, user_id FROM events WHERE CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) = 69""")
def json_containment(t):
    """The documents are parsed once, into a stored variant column; no question parses them again."""

    def write(path):
        t.events.select("event_id", "user_id", F.try_parse_json("props").alias("props")).write.parquet(path)

    stored = t.spark.read.parquet(layout(t.spark, "documents", [t.path("events")], write))
    return stored.where(contains(F.col("props"), {"k": 69})).select("event_id", "user_id")


@query("JSN-2", """SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events
                   WHERE CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) >= 50""")
def json_extract(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select("event_id", k.alias("k")).where("k >= 50")


@query(
    "JSN-3",
    """SELECT c_custkey, '{"marketing":' || CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END ||
              ',"telegram":"@user' || c_custkey || '","verified":' || CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE 'false' END || '}'
              AS profile FROM customer""",
)
def json_object(t):
    key = F.col("c_custkey")
    profile = F.struct(
        (key % 2 == 0).alias("marketing"),
        F.concat(F.lit("@user"), key.cast("string")).alias("telegram"),
        (key % 3 == 0).alias("verified"),
    )
    return t.customer.select("c_custkey", F.to_json(profile).alias("profile"))


@query(
    "JSN-4",
    """SELECT o_orderkey, 'material ' || n AS title, CAST(n * 10 AS INTEGER) AS pages, o_orderstatus AS state
       FROM orders, (SELECT unnest([1, 2]) AS n)""",
)
def nested_path_and_flatten(t):
    lesson = F.struct(
        F.struct(F.col("o_orderstatus").alias("state")).alias("meta"),
        F.transform(
            F.array(F.lit(1), F.lit(2)),
            lambda n: F.struct(F.concat(F.lit("material "), n.cast("string")).alias("title"), (n * 10).alias("pages")),
        ).alias("materials"),
    )
    stored = t.orders.select("o_orderkey", F.to_json(lesson).alias("doc"))
    parsed = stored.select(
        "o_orderkey",
        F.variant_get(F.parse_json("doc"), "$.meta.state", "string").alias("state"),
        F.explode(F.from_json("doc", "materials array<struct<title string, pages int>>")["materials"]).alias("m"),
    )
    return parsed.select("o_orderkey", "m.title", "m.pages", "state")


@query(
    "RNG-1",
    """SELECT l_suppkey, lo, hi FROM (SELECT l_suppkey, min(l_extendedprice) AS lo, min(l_extendedprice) + 400 AS hi
                                      FROM lineitem GROUP BY l_suppkey)
       WHERE lo <= 1300 AND 1000 <= hi""",
)
def range_overlap(t):
    low = t.lineitem.groupBy("l_suppkey").agg(F.min("l_extendedprice").alias("lo"))
    ranged = low.withColumn("hi", F.col("lo") + 400)
    wanted = make_range(F.lit(1000.0), F.lit(1300.0))
    return ranged.where(overlaps(make_range(F.col("lo"), F.col("hi")), wanted)).select("l_suppkey", "lo", "hi")


@query(
    "RNG-2",
    """SELECT c_custkey, CASE WHEN top IS NULL THEN 0 ELSE greatest(0, top - 100) END AS lo,
              CASE WHEN top IS NULL THEN 100 ELSE top + 100 END AS hi
       FROM customer LEFT JOIN (SELECT user_id, CAST(floor(max(value)) AS INTEGER) AS top FROM events GROUP BY user_id)
       ON user_id = c_custkey""",
)
def range_from_aggregate(t):
    top = t.events.groupBy("user_id").agg(F.floor(F.max("value")).cast("int").alias("_top"))
    joined = t.customer.join(top, F.col("user_id") == F.col("c_custkey"), "left")
    ranged = joined.select("c_custkey", around_highest(F.col("_top"), 100, 100).alias("r"))
    return ranged.select("c_custkey", "r.lo", "r.hi")


@query(
    "RNG-3",
    """SELECT c_custkey, c_name, value FROM customer JOIN events ON user_id = c_custkey WHERE value BETWEEN 10 AND 40""",
)
def value_in_range(t):
    readings = t.events.where(F.col("value").between(10, 40))
    return t.customer.join(readings, F.col("user_id") == F.col("c_custkey")).select("c_custkey", "c_name", "value")


SIZE = 0.02


def _points(t) -> str:
    """The points of the vectors' first two numbers, stored along their cells once for these data."""

    def write(path: str) -> None:
        x, y = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
        write_points(t.embeddings.select("vec_id", x.alias("x"), y.alias("y")), path, "x", "y", SIZE)

    return layout(t.spark, "points", [t.path("embeddings")], write)


POINTS = "(SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)"


@query("GEO-1", f"SELECT vec_id, x, y FROM {POINTS} WHERE power(x - 0.05, 2) + power(y + 0.02, 2) <= 0.01")
def point_in_circle(t):
    return points_in_circle(t.spark, _points(t), "x", "y", SIZE, (0.05, -0.02), 0.1)


@query("GEO-2", f"SELECT vec_id, x, y FROM {POINTS} WHERE x BETWEEN -0.1 AND 0.1 AND y BETWEEN 0 AND 0.2")
def point_in_box(t):
    return points_in_box(t.spark, _points(t), "x", "y", SIZE, (0.1, 0.2), (-0.1, 0.0))
