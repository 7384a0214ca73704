import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lotwise.llm import merkle
from lotwise.llm.queries import followed
from tests.llm.cases import LONG, TEXTS, clashing, texts


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(text):
    """Sections of paragraphs of (leaf text, digest), read from the text alone."""
    result, current = [], []
    for line in re.findall(r"[^\n]+\n*|\n+", text or ""):
        own = [(leaf, sha(leaf)[:16]) for leaf in re.findall(r"[^.!?\n]{1,64}[.!?]*\n*|[.!?\n]+", line)]
        current.append(own)
        if sha("".join(d for _, d in own))[0] in "0123":
            result.append(current)
            current = []
    return result + [current] if current else result


def brute_force(text):
    made = tree(text)
    ids = [[sha("".join(d for _, d in own))[:16] for own in section] for section in made] or [[""]]
    root = sha(",".join(sha(",".join(section))[:16] for section in ids))
    return root + ":" + ";".join(",".join("".join(d[:8] for _, d in own) for own in section) for section in made)


def alike(one, two):
    sets = [{d[:8] for section in tree(text) for own in section for _, d in own} for text in (one, two)]
    return 1.0 if one == two else 2 * len(sets[0] & sets[1]) / (len(sets[0]) + len(sets[1]))


def sample(seed, count=40):
    pick = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "naïve", "中文", "😀"]
    return ["".join(pick.choice(words) + pick.choice([" "] * 8 + [". ", "!\n", "\n", "\n\n", "?!"]) for _ in range(pick.randint(0, 120))) for _ in range(count)]


def test_fingerprints_equal_brute_force(spark):
    rows = list(enumerate(sample(1) + ["\n", "a", "no end " * 40, LONG]))
    found = texts(spark, rows).select("doc_id", merkle.fingerprint(F.col("text")).alias("print")).collect()
    assert {r["doc_id"]: r["print"] for r in found} == {key: brute_force(text) for key, text in rows}


def test_likeness_and_added_leaves(spark):
    pick, rows = random.Random(2), []
    for text in sample(3):
        at = pick.randint(0, len(text))
        rows.append((text, text[:at] + "changed" + text[at:]))
    rows += [("a. b.", "a. b."), ("", ""), ("", "a"), ("a", ""), ("x. y. z.", "z. y. x."), ("x.\n" * 50, "x.\n" * 49 + "y.\n")]
    df = spark.createDataFrame(rows, "one string, two string").withColumns({n + "p": merkle.fingerprint(F.col(n)) for n in ("one", "two")})
    for row in df.select("*", merkle.likeness(F.col("onep"), F.col("twop")).alias("near"), merkle.added(F.col("onep"), F.col("twop")).alias("new")).collect():
        assert row["near"] == alike(row["one"], row["two"])
        assert (row["near"] == 1.0) == ({*re.findall(".{8}", row["onep"][65:])} == {*re.findall(".{8}", row["twop"][65:])})
        sides = [{d[:8] for section in tree(row[n]) for own in section for _, d in own} for n in ("one", "two")]
        assert set(row["new"]) == sides[0] - sides[1] and len(set(row["new"])) == len(row["new"])


def test_first_edit_is_where_texts_part(spark):
    pick, rows = random.Random(5), []
    for text in sample(6, 60):
        at = pick.randint(0, len(text))
        rows.append((text, text[:at] + "EDIT" + text[at + 4 :]))
    rows += [("a.\nb.\n", "a.\nb.\n"), ("a.", "a.\nb.\nc.\n"), ("", "a")]
    df = spark.createDataFrame(rows, "one string, two string")
    place = merkle.first_edit(merkle.fingerprint(F.col("one")), merkle.fingerprint(F.col("two")))
    checked = 0
    for one, two, found in df.select("one", "two", place.alias("place")).collect():
        assert (found is None) == (one == two)
        if found is None or not one:
            continue
        made = tree(one)
        leaves = [(s, p, n) for s, section in enumerate(made) for p, own in enumerate(section) for n, _ in enumerate(own)]
        starts, total = {}, 0
        for s, p, n in leaves:
            starts[s, p, n] = total
            total += len(made[s][p][n][0])
        common = next((i for i, (a, b) in enumerate(zip(one, two)) if a != b), min(len(one), len(two)))
        start = starts[tuple(found)]
        # A leaf ends with the breaks and marks that follow it, so an edit may change the leaf before it too.
        assert start <= common and two[:start] == one[:start]
        assert common <= start + len(made[found[0]][found[1]][found[2]][0])
        checked += 1
    assert checked > 50


def ring(rows):
    """(text, next text) by descending id, ties left out."""
    order = sorted(rows, key=lambda row: (row[0] is not None, -(row[0] or 0)))
    return {key: (text or "", (order[(i + 1) % len(order)][1]) or "") for i, (key, text) in enumerate(order)}


@pytest.mark.parametrize("rows", [[(key, text) for key, text in TEXTS if key != 7], [(5, "only one")], [(n, f"text {n}" * n) for n in range(300)]])
def test_next_documents(spark, many_slices, rows):
    found = followed(texts(spark, rows).selectExpr("doc_id", "coalesce(text, '') AS text")).collect()
    want = ring(rows)
    assert len(found) == len(rows)
    for row in found:
        mine, following = want[row["doc_id"]]
        assert (row["text"], row["prefix"]) == (mine, following[: len(mine) // 2])
        assert (row["fingerprint"], row["following"]) == (brute_force(mine), brute_force(following))


def test_repeated_rows_share_their_next(spark):
    rows = [(7, "same text")] * 500 + [(3, "before"), (9, "after")]
    found = followed(texts(spark, rows)).collect()
    assert sorted({(r["doc_id"], r["prefix"]) for r in found}) == [(3, "aft"), (7, "befo"), (9, "sa")]
    assert len(found) == 502


def test_odd_rows(spark):
    df = clashing(spark)
    found = df.withColumn("print", merkle.fingerprint(F.col("text"))).collect()
    assert len(found) == len(TEXTS) and all(r["score"] == "mine" for r in found)
    assert len({r["print"] for r in found if not r["text"]}) == 1
    assert followed(texts(spark, [])).count() == 0
