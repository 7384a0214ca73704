import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lotwise.llm import periodic
from lotwise.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.cases import LONG, TEXTS, clashing, texts


def brute_force(words):
    """Every maximal stretch of each period, then those whose period is the smallest."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            if words[start] != words[start + q]:
                start += 1
                continue
            stop = start
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            if stop + q - start >= max(6, 4 * q):
                found.setdefault((start, stop + q), q)
            start = stop
    return sorted((start, stop - start, q) for (start, stop), q in found.items())


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def check(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    got = periodic.compute(["x y x y", text, "tail tail"])
    runs = [(r["start"], r["length"], r["period"]) for r in got["runs"][1]]
    assert runs == brute_force(words)
    assert got["collapsed"][1] == collapsed(words, runs)
    return runs


def test_transform_is_a_convolution():
    pick = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        blocks = pick.integers(0, 3, (5, size), dtype=np.uint64)
        following = pick.integers(0, 3, (5, 2 * size), dtype=np.uint64)
        following[2, size // 2 : size // 2 + size] = blocks[2]
        want = [(row, size + d) for row in range(5) for d in range(size) if (blocks[row] == following[row, d : d + size]).all()]
        assert list(zip(*map(np.ndarray.tolist, periodic.occurrences(blocks, following)))) == want
        assert (periodic.backward(periodic.forward(following.copy())) == following).all()


def test_random_texts_equal_brute_force():
    pick = random.Random(3)
    seen = 0
    for _ in range(400):
        words = []
        while len(words) < pick.randint(0, 150):
            part = pick.choices("abc" if pick.random() < 0.7 else "ab", k=pick.randint(1, 12))
            words += (part * pick.randint(1, 9))[: pick.randint(1, 90)]
        seen += len(check(" ".join(words)))
    assert seen > 300


def test_long_periods():
    pick = random.Random(8)
    for period in (1, 2, 3, 63, 64, 65, 127, 128, 300):
        part = [f"w{pick.randrange(10**6)}" for _ in range(period)]
        words = ["before"] * pick.randint(0, 3) + part * 6 + part[: period // 2] + ["after"]
        runs = check(" ".join(words))
        assert max(length for _, length, _ in runs) >= 5 * period


def test_nested_runs():
    inner = ["a", "a", "a", "a", "a", "a", "b"]
    runs = check(" ".join(inner * 6))
    assert (0, 42, 7) in runs and (0, 6, 1) in runs
    check(" ".join(["a"] * 500 + ["b"] + ["a"] * 500))
    check("a b " * 40 + "b a " * 40)
    check("\x0b".join([" "] * 9) + "  x\x85y")


def test_sums_that_are_multiples_of_the_prime_are_no_runs():
    # Numbers that differ by the prime look equal to the transform.
    words = np.array([5, 6, periodic.PRIME + 5, 6, 5, 6, 5, periodic.PRIME + 6, 5, 6, 7])
    assert len(periodic.runs_of(words, 10)) == 0


def test_odd_rows(spark):
    found = periodic.with_runs(clashing(spark).selectExpr("*", "'mine' AS runs", "0 AS collapsed"))
    assert "score" in found.columns and found.columns[-2:] == ["runs", "collapsed"]
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", dict((repr(k), t) for k, t in TEXTS)[repr(row["doc_id"])] or "")
        runs = [tuple(run) for run in row["runs"]]
        assert row["collapsed"] == collapsed(words, runs)
        if row["doc_id"] == 6:
            assert runs == [(0, 100_000, 5)] and row["collapsed"] == LONG[:26]
        else:
            assert runs == brute_force(words)


def test_empty_table(spark):
    assert periodic.with_runs(texts(spark, [])).count() == 0


@pytest.mark.parametrize("folder", [SMALL])
def test_query_equals_brute_force(spark, folder):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op12_periodic_runs"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(docs)
    for row in found:
        words = re.findall(r"[^\x20\x09-\x0D]+", docs[row["doc_id"]] or "")
        h = zlib.crc32(str(row["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n > 0:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue
        runs = brute_force(words)
        top = min(runs, key=lambda run: (-run[1], run[0], run[2])) if runs else (None,) * 3
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"]) == top
        assert row["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
        assert row["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert row["collapsed_sha256"] == sha(collapsed(words, runs))
    assert sum(r["n_runs"] > 0 for r in found) > 10
