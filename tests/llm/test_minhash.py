import collections
import random
import re

import numpy as np
import pytest

from lotwise.llm import minhash
from lotwise.llm.components import components
from tests.llm.cases import LONG, TEXTS, texts

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute_force(rows, percent=85):
    root = {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(key, shingles(text)) for key, text in rows]
    for key, _ in sets:
        root[key] = key
    for i, (a, left) in enumerate(sets):
        for b, right in sets[:i]:
            both = len(left & right)
            if a is not None and b is not None and both and 100 * both >= percent * len(left | right):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((key, len(own), find(key)) for key, own in sets if key is not None)


def corpus():
    pick = random.Random(4)
    words = [f"w{n}" for n in range(400)]
    base = pick.choices(words, k=220)
    rows = []
    for key in range(60):  # near copies of one text, from hardly to heavily changed
        copy = list(base)
        for _ in range(pick.randint(0, 9)):
            copy[pick.randrange(len(copy))] = pick.choice(words)
        rows.append((key, " ".join(copy)))
    rows += [(100 + key, rows[0][1].upper()) for key in range(20)]
    rows += [(200 + key, " ".join(pick.choices(words, k=pick.randint(0, 60)))) for key in range(60)]
    chain = list(base[::-1])
    for key in range(300, 330):  # a chain whose ends are unlike
        chain[pick.randrange(len(chain))] = f"new{key}"
        rows.append((key, " ".join(chain)))
    return rows + [(400, "a b"), (401, "A  B"), (402, "a b c d"), (403, ""), (404, None), (405, "a\x0bb"), (406, "a\xa0b")]


def check(spark, rows, percent=85):
    found = minhash.near_duplicates(texts(spark, rows), percent=percent).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is not None) == brute_force(rows, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found if r["doc_id"] is not None)
    return found


def test_components_equal_brute_force(spark):
    check(spark, corpus())


def variants(count, length=300, changed=4, extra=0):
    """Texts that each change some words of one text and repeat some of their words, so that few pairs are similar enough."""
    pick, rows = random.Random(9), []
    base = [f"b{n}" for n in range(length)]
    for key in range(count):
        words = list(base)
        for at in pick.sample(range(length), changed):
            words[at] = f"n{key}_{at}"
        more = pick.randint(0, extra)
        rows.append((key, " ".join(words + [f"e{key}_{n}" for n in range(more)])))
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_families_equal_brute_force(spark, percent):
    rows = variants(90) + [(1000 + key, text) for key, text in variants(60, 60, 1, 8)] + [(2000 + key, text) for key, text in variants(50, 2500, 60)]
    check(spark, rows, percent)


def test_pairs_do_not_grow_with_the_square_of_a_family(spark, monkeypatch):
    counts = []
    real = minhash.confirmed

    def counted(pairs, *args):
        counts[-1] += pairs.count()
        return real(pairs, *args)

    monkeypatch.setattr(minhash, "confirmed", counted)
    for size in (150, 300, 600):
        counts.append(0)
        minhash.near_duplicates(texts(spark, variants(size)))
    assert counts[1] < 2.5 * counts[0] and counts[2] < 2.5 * counts[1]


def test_only_texts_in_buckets_are_read_again(spark, monkeypatch):
    """Steps that need whole texts get those of documents that share a bucket, not the whole table each time."""
    given = []
    confirmed, rarest = minhash.confirmed, minhash._rarest
    monkeypatch.setattr(minhash, "confirmed", lambda pairs, df, *args: given.append(df.count()) or confirmed(pairs, df, *args))
    monkeypatch.setattr(minhash, "_rarest", lambda open_, df, *args: given.append(df.count()) or rarest(open_, df, *args))
    alone = [(1000 + key, " ".join(f"{word}_{key}" for word in range(40))) for key in range(200)]
    check(spark, alone + variants(12) + [(500, variants(1)[0][1]), (3, "a second text of one id")])
    assert len(given) == 4 and max(given) <= 14


def test_sketches_never_overstate_a_difference():
    pick = np.random.default_rng(2)
    every = pick.integers(0, 1 << 63, 3000, dtype=np.uint64)
    sets = [np.unique(pick.choice(every, size)) for size in (1, 40, 900, 1500, 2000) for _ in range(3)]
    owner = np.repeat(np.arange(len(sets)), list(map(len, sets)))
    bits = minhash.sketches(np.concatenate(sets), owner, len(sets))
    for i, left in enumerate(sets):
        for j, right in enumerate(sets):
            unlike = len(set(left.tolist()) ^ set(right.tolist()))
            found = int(np.bitwise_count(bits[i] ^ bits[j]).sum())
            assert found <= unlike and (unlike - found) % 2 == 0 and (unlike > 200 or found >= 0.7 * unlike)


def test_odd_rows(spark):
    rows = TEXTS + [(9, LONG + "end"), (10, LONG)]
    found = check(spark, rows)
    assert [(r["component_id"], r["kept"]) for r in found if r["doc_id"] is None] == [(None, True)]


def test_ids_on_several_rows_join_their_groups(spark):
    one, two = "a b c d e f g", "p q r s t u v"
    rows = [(5, one), (5, two), (1, one), (9, two), (7, "z z z z z z")]
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(texts(spark, rows)).collect()}
    assert found == {5: 1, 1: 1, 9: 1, 7: 7}


def test_empty_table(spark):
    assert minhash.near_duplicates(texts(spark, [])).count() == 0


def test_estimate_follows_similarity(spark):
    pick = np.random.default_rng(5)
    for share in (0.5, 0.8, 0.95):
        common = pick.integers(0, 1 << 62, int(2000 * share), dtype=np.uint64)
        own = pick.integers(0, 1 << 62, (2, 2000 - len(common)), dtype=np.uint64)
        sets = [np.concatenate([common, part]) for part in own]
        low = minhash.minima(np.concatenate(sets), np.array([0, 2000]))
        bits = minhash.packed(low).view(np.int64).T.tolist()
        df = spark.createDataFrame([(bits[0], bits[1])], "a array<bigint>, b array<bigint>")
        similarity = len(common) / (4000 - len(common))
        assert abs(df.select(minhash.estimate(df["a"], df["b"])).first()[0] - similarity) < 0.12


def test_stars_of_long_paths(spark):
    links = [(n, n + 1) for n in range(0, 40)] + [(100, 50), (50, 75), (75, 75), (200, 200)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    groups = collections.Counter(found.values())
    assert groups == {0: 41, 50: 3, 200: 1}
