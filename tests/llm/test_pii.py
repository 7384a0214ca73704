import random
import re

import pytest
from pyspark.sql import functions as F

from lotwise.llm import pii
from tests.llm.cases import clashing, texts

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, hit):
    digits = [int(c) for c in hit if c in "0123456789"]
    if kind == "ip":
        return all(int(part) <= 255 for part in hit.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_force(text):
    return sorted((m.start(), n, m.end()) for n, kind in enumerate(PATTERNS) for m in re.finditer(PATTERNS[kind], text or "") if passes(kind, m.group()))


def base(rows):
    return [(s["start"], s["kind"], s["stop"]) for s in rows["pii_spans"] if s["base"]]


def test_base_spans_equal_brute_force(spark):
    pick = random.Random(6)
    letters = "0123456789" * 2 + "  --..++@@ab_%()\n:é😀&"
    given = ["".join(pick.choices(letters, k=pick.randint(0, 60))) for _ in range(3000)]
    given += ["a@b.c_x@y.z", "4111 1111 1111 1111", "4111111111111111 4111-1111-1111-1111", "1.2.3.4.5.6.7.8", "0300.1.1.1 000001.2.3.4"]
    found = {row["doc_id"]: base(row) for row in pii.with_spans(texts(spark, list(enumerate(given)))).collect()}
    for key, text in enumerate(given):
        assert found[key] == brute_force(text), text


def test_long_runs_end(spark):
    rows = [(1, "x" * 200_000), (2, "1" * 100_000), (3, "a." * 50_000), (4, "+1" + " " * 50_000), (5, "@" * 50_000), (6, None), (7, "")]
    assert all(base(row) == [] for row in pii.with_spans(texts(spark, rows)).collect())


def test_trees_add_what_looks_like_what_passed(spark):
    good = [(n, f"please call +1 (555) 010-{1000 + n} or pay by card 4111 1111 1111 1111 today") for n in range(40)]
    bad = [(100 + n, f"order +1 {n}2 and invoice 1234 5678 9012 3456 done") for n in range(40)]
    asked = [(200, "please call 555-010-1234 or write"), (201, "invoice 555-010-1234"), (202, "4111 1111 1111 1111 555 010 1234")]
    found = {row["doc_id"]: row for row in pii.with_spans(clashing(spark, good + bad + asked)).collect()}
    assert [(s["start"], s["stop"], s["base"]) for s in found[200]["pii_spans"]] == [(12, 24, False)]
    for key, text in good + bad + asked:
        assert base(found[key]) == brute_force(text)


def test_nothing_to_learn_from(spark):
    assert pii.with_spans(texts(spark, [])).count() == 0
    assert pii.Trees([]).forests == {}
    only = pii.with_spans(texts(spark, [(1, "call 555-010-1234")])).first()
    assert only["pii_spans"] == []


@pytest.mark.parametrize("spans, shown", [([], "mail a@b.cd now"), ([(5, 11, 0)], "mail [EMAIL] now"), ([(0, 6, 2), (5, 11, 0), (12, 15, 1)], "[CARD] [IP]")])
def test_redaction(spark, spans, shown):
    made = spark.createDataFrame([("mail a@b.cd now", [(a, k, b, True) for a, b, k in spans])], "text string, s array<struct<start:int,kind:int,stop:int,base:boolean>>")
    assert made.select(pii.redacted(F.col("text"), F.col("s"))).first()[0] == shown
