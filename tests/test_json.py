"""Containment of documents, against its definition in Python."""

import itertools
import json

from pyspark.sql import functions as F

from lotwise.functions.json import contains
from lotwise.plans import CATALOGUE
from lotwise.sources.workspace import new_path
from tests.conftest import SMALL

DOCUMENTS = [
    {"a": 1}, {"a": 1, "b": {"c": [1, 2, {"d": "x"}], "e": None}}, {"a": "1"}, {"a": True}, {"a": 1.5}, {"a": [1, [2, 3]]}, {}, [],
    [1, "1", True, None, {"k": [1]}], [[1, 2], [3]], "text", 7, 7.25, True, None, {"a b": {"x.y": 0}}, {"b": {"c": []}}, [{"a": 1, "b": 2}, {"a": 2}],
    {"big": 12345678901234567890}, {"n": -3},
]
PATTERNS = [
    {}, {"a": 1}, {"a": 1.0}, {"a": "1"}, {"a": True}, {"a": 1.5}, {"b": {"e": None}}, {"b": {"c": [{"d": "x"}, 1]}}, {"b": {"c": []}}, {"a": [[3]]}, {"a": [[1]]},
    [], [1], [True, None], [{"k": [1]}], [[2, 1]], [1, 1], ["missing"], "text", "1", 1, True, None, 7, 7.25, {"a b": {"x.y": 0}}, [{"a": 1}, {"b": 2}], [{"a": 1, "b": 2}],
    {"big": 12345678901234567890}, {"n": -3}, {"a": None},
]


def holds(value, pattern):
    if isinstance(pattern, dict):
        return isinstance(value, dict) and all(key in value and holds(value[key], inner) for key, inner in pattern.items())
    if isinstance(pattern, list):
        return isinstance(value, list) and all(any(holds(one, inner) for one in value) for inner in pattern)
    number = (int, float)
    if isinstance(pattern, bool) or isinstance(value, bool):
        return value is pattern
    return value == pattern and (type(value) is type(pattern) or (isinstance(value, number) and isinstance(pattern, number)))


def test_containment_equals_its_definition(spark):
    path = new_path(spark, "variants")
    texts = [(n, json.dumps(document)) for n, document in enumerate(DOCUMENTS)] + [(100, None), (101, "not json")]
    spark.createDataFrame(texts, "id int, text string").select("id", F.try_parse_json("text").alias("v")).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.schema["v"].dataType.simpleString() == "variant"
    found = stored.select("id", *[contains(F.col("v"), pattern).alias(f"p{i}") for i, pattern in enumerate(PATTERNS)]).collect()
    for row, (i, pattern) in itertools.product(found, enumerate(PATTERNS)):
        document = DOCUMENTS[row["id"]] if row["id"] < 100 else ...
        want = document is not ... and (holds(document, pattern) or (isinstance(pattern, (str, int, float)) and isinstance(document, list) and any(holds(one, pattern) for one in document)))
        assert row[f"p{i}"] == want, (document, pattern)


def test_no_question_parses(spark):
    plan = CATALOGUE["JSN-1"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan.lower() and "events.parquet" not in plan
