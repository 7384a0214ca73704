import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import ann, decontaminate, sharding
from tests.llm.cases import LONG, TEXTS, clashing, texts

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def exact(rows, k):
    fine = {key: np.array(v, np.float64) for key, v, _ in rows if key is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)}
    return {q: sorted(((-float(fine[q] @ v), key) for key, v in fine.items() if key != q))[:k] for q in fine if q % 5 == 0}


@pytest.fixture(scope="module")
def vectors():
    pick = np.random.default_rng(10)
    rows = [(n, np.float32(pick.normal(size=8) * pick.uniform(0.5, 3)).tolist(), n % 3) for n in range(300)]
    common = [4 * x for x in rows[0][1]]
    rows += [(1000 + n, common, 0) for n in range(60)]
    rows += [(1000, common, 0), (400, None, 0), (405, [0.0] * 8, 0), (410, [1.0] * 7, 0), (415, [None] + [1.0] * 7, 0)]
    rows += [(420, [float("nan")] + [1.0] * 7, 0), (425, [float("inf")] + [1.0] * 7, 0), (None, [1.0] * 8, 0)]
    return rows


@pytest.mark.parametrize("slice_, block", [(16_384, 4_096), (50, 20)])
def test_nearest_vectors(spark, vectors, monkeypatch, slice_, block):
    monkeypatch.setattr(ann, "SLICE", slice_)
    monkeypatch.setattr(ann, "BLOCK", block)
    df = spark.createDataFrame(vectors, SCHEMA).repartition(5)
    found = ann.nearest(df.withColumn("rank", F.lit("clash")), F.col("vec_id") % 5 == 0, 10).collect()
    want = exact(vectors, 10)
    by = {}
    for row in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
    assert set(by) == set(want)
    hits = sum(len({key for _, key in want[q]} & {key for key, _ in by[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, rows in by.items():
        assert len(rows) == 10 and rows == sorted(rows, key=lambda r: (-r[1], r[0])) and q not in {key for key, _ in rows}
    assert [key for key, _ in by[1005]] == [1000, 1001, 1002, 1003, 1004, 1006, 1007, 1008, 1009, 1010]


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (5, [1.0, 0.0], 1)], SCHEMA)
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.nearest(few, F.col("vec_id") % 5 == 0, 20).collect()}
    assert found == {(0, 1): (5, 1.0), (0, 2): (1, 0.0), (5, 1): (0, 1.0), (5, 2): (1, 0.0)}
    assert ann.nearest(few.where("vec_id < 0"), F.col("vec_id") == 0, 3).count() == 0
    assert ann.nearest(few, F.col("vec_id") == 7, 3).count() == 0


def test_every_code_within_the_radius_is_probed():
    pick = np.random.default_rng(11)
    vectors = pick.normal(size=(500, 8))
    hashing = ann.Hashing(float(np.sqrt((vectors**2).sum(axis=1).max())), np.zeros(9), pick.normal(size=(9, ann.BITS)), 90)
    query, one, score = ann.search(hashing, np.arange(500), vectors, np.arange(40), vectors[:40], 500)
    apart = ann.distances(hashing.codes(vectors[:40], True), hashing.codes(vectors))
    assert set(zip(query.tolist(), one.tolist())) >= set(zip(*map(np.ndarray.tolist, np.nonzero(apart <= 90))))


def test_probes_of_clustered_codes_are_selective():
    """The lists hold all codes within the radius, and on clustered codes little else."""
    pick = np.random.default_rng(4)
    centres = pick.integers(0, 2, (40, ann.BITS)).astype(np.uint8)
    bits = centres[pick.integers(0, 40, 4000)] ^ (pick.random((4000, ann.BITS)) < 0.03)
    codes = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<u2")
    indexes = [np.unique(codes[:, place], return_inverse=True) for place in range(ann.SUBSTRINGS)]
    row, one, apart = ann.probed(codes, indexes, codes[:50], 40)
    want = ann.distances(codes[:50], codes)
    assert set(zip(row.tolist(), one.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(want <= 40))))
    assert (apart == want[row, one]).all()
    listed = np.zeros((50, 4000), bool)
    for place, (values, where) in enumerate(indexes):
        listed |= (np.bitwise_count(values[None, :] ^ codes[:50, place][:, None]) <= 40 // ann.SUBSTRINGS)[:, where]
    assert listed.mean() < 0.25


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in df.collect()}
    ids = np.array(sorted(rows))
    every = np.stack([rows[key] for key in ids.tolist()])
    found = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, 20).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for key in ids[ids % 20 == 0].tolist():
        order = np.lexsort((ids, -(every @ rows[key])))
        want = {other for other in ids[order].tolist() if other != key}
        best = [other for other in ids[order].tolist() if other != key][:20]
        assert len(found[key]) == min(20, len(want))
        hits += len(found[key] & set(best))
        total += len(best)
    assert hits >= 0.9 * total


def naive_table(shards, slots):
    """Shards take turns; each walks its whole permutation from the start until a free slot comes."""
    start = {s: sharding._number(s, "start") % slots for s in shards}
    step = {s: sharding._number(s, "step") % (slots - 1) + 1 for s in shards}
    table = {}
    while len(table) < slots:
        for s in shards:
            free = next((slot for slot in ((start[s] + i * step[s]) % slots for i in range(slots)) if slot not in table), None)
            if free is not None:
                table[free] = s
    return [table[slot] for slot in range(slots)]


def test_table_equals_the_definition():
    shards = [f"s{n}" for n in range(7)]
    assert [shards[i] for i in sharding.filled(shards, 211)] == naive_table(shards, 211)
    counts = np.bincount(sharding.filled(shards, 65_537))
    assert counts.max() - counts.min() <= 1
    heavy = np.bincount(sharding.filled(shards, 65_537, [2, 1, 1, 1, 1, 1, 1]))
    assert abs(heavy[0] / heavy[1] - 2) < 0.01


def test_losing_a_shard_moves_few_others():
    shards = [f"s{n}" for n in range(20)]
    before, after = sharding.filled(shards), sharding.filled(shards[:-1])
    stayed = before < 19
    assert (before[stayed] == after[stayed]).mean() > 0.9


@pytest.mark.parametrize("shards, slots, weights", [(["a"], 4, None), ([], 7, None), (["a", "a"], 7, None), (["a"], 7, [0])])
def test_bad_tables(shards, slots, weights):
    with pytest.raises(ValueError):
        sharding.filled(shards, slots, weights)


def test_placement(spark, tmp_path):
    shards = ["a", "b", "c"]
    rows = sharding.placed(clashing(spark), "doc_id", shards, 211)
    table = sharding.filled(shards, 211)
    found = rows.collect()
    assert len(found) == len(TEXTS) and all(row["shard"] == shards[table[row["slot"]]] for row in found)
    assert len({row["shard"] for row in found if row["doc_id"] == 7}) == 1
    assert sharding.placed(texts(spark, []), "doc_id", shards, 211).count() == 0
    sharding.write_shards(rows, str(tmp_path / "out"))
    again = spark.read.parquet(str(tmp_path / "out"))
    assert again.count() == len(TEXTS) and set(again.columns) == set(rows.columns)


def words(n, seed=0):
    pick = np.random.default_rng(seed)
    return [f"w{x}" for x in pick.integers(0, 10_000, n)]


def test_contamination(spark):
    item, short, twin = words(40, 1), ["only", "three", "words"], words(24, 2)
    changed = [*item[:38], "new", *item[39:]]
    spoiled = [w if i % 6 else f"x{i}" for i, w in enumerate(item)]
    docs = [
        (1, " ".join(words(30, 3) + item + words(30, 4))),
        (2, " ".join(words(9, 5)) + ", " + " ".join(changed).upper()),
        (3, " ".join(words(30, 6) + spoiled)),
        (4, "Only three words!"),
        (5, " ".join(words(50, 7) + short + words(9, 8))),
        (6, " ".join(item[:20] + words(40, 9) + item[20:])),
        (7, " ".join(words(9, 1) + twin + twin)),
        (None, " ".join(item)),
        (8, None),
        (9, ""),
        (10, LONG + " ".join(item)),
        (10, LONG + " ".join(item)),
    ]
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short)), (3, " ".join(twin)), (4, None), (5, ""), (1, " ".join(item))], "item_id bigint, text string")
    found = decontaminate.contaminated(clashing(spark, docs), items).collect()
    got = {(r["doc_id"], r["item_id"]): (r["start"], round(r["similarity"], 3)) for r in found}
    assert len(found) == len(got)
    assert set(got) == {(1, 1), (2, 1), (4, 2), (7, 3), (None, 1), (10, 1)}
    assert got[1, 1] == (30, 1.0) and got[2, 1] == (9, round(34 / 38, 3))
    assert got[7, 3] == (9, 1.0) and got[10, 1][1] == 1.0
    assert decontaminate.contaminated(texts(spark, []), items).count() == 0
    assert decontaminate.contaminated(texts(spark, docs), items.where("item_id > 9")).count() == 0


def every_window(text, item, threshold=0.8):
    """Best similarity of any window of the item's size, and the starts that have it."""
    def shingles(words):
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else ([tuple(words)] if words else [])

    mine, wanted = shingles(text.split()), shingles(item.split())
    size, best = min(len(wanted), len(mine)), {}
    for start in range(len(mine) - size + 1):
        common = sum((Counter(mine[start : start + size]) & Counter(wanted)).values())
        best.setdefault(common / (size + len(wanted) - common), []).append(start)
    top = max(best, default=0)
    return (top, best[top]) if wanted and top >= threshold else None


def test_windows_between_diagonals(spark):
    item = [f"i{n}" for n in range(59)]
    changed = ["x", *item[1:30], "new", "words", *item[30:58], "y"]
    rows = [(1, " ".join([f"a{n}" for n in range(90)] + changed + [f"b{n}" for n in range(90)])), (2, " ".join(item[30:] + item[:30]))]
    items = spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")
    found = {r["doc_id"]: r for r in decontaminate.contaminated(texts(spark, rows), items).collect()}
    assert set(found) == {1, 2} and all(abs(found[key]["similarity"] - every_window(text, " ".join(item))[0]) < 1e-12 for key, text in rows)


def test_contamination_equals_all_windows(spark):
    pick = random.Random(3)
    vocabulary = [f"w{n}" for n in range(40)]
    items = [(n, " ".join(pick.choices(vocabulary, k=pick.choice([2, 4, 9, 30, 60, 80])))) for n in range(25)]
    items += [(100, items[3][1]), (101, "same words all over " * 8)]
    rows = [(-1, None), (-2, "same words all over " * 30)]
    for key in range(250):
        words = []
        for _ in range(pick.randint(0, 3)):
            part = pick.choice(items)[1].split()
            for _ in range(pick.choice([0, 0, 1, 1, 2, 3])):
                at = pick.randrange(len(part) + 1)
                change = pick.choice(["cut", "put", "swap", "turn"])
                if change == "cut":
                    del part[at : at + pick.randint(1, 3)]
                elif change == "put":
                    part[at:at] = pick.choices(vocabulary, k=pick.randint(1, 3))
                elif change == "swap" and at < len(part):
                    part[at] = "new"
                else:
                    part = part[at:] + part[:at]
            words += pick.choices(vocabulary, k=pick.choice([0, 0, 5, 40])) + part + pick.choices(vocabulary, k=pick.choice([0, 0, 5, 40]))
        rows.append((key, " ".join(words)))
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(texts(spark, rows), table).collect()}
    want = {(key, n): hit for key, text in rows for n, item in items if (hit := every_window(text or "", item))}
    assert set(found) == set(want) and len(want) > 100
    for pair, (similarity, starts) in want.items():
        assert abs(found[pair]["similarity"] - similarity) < 1e-12 and found[pair]["start"] in starts


def test_a_line_of_all_items_meets_few(spark):
    """A passage that all items and most documents hold pairs no document with an item by itself."""
    line = " ".join(f"c{n}" for n in range(12))
    items = spark.createDataFrame([(n, line + " " + " ".join(f"q{n}_{k}" for k in range(50))) for n in range(40)], "item_id bigint, text string")
    rows = [(n, f"u{n} " * 30 + line) for n in range(300)] + [(1000, "before " + line + " " + " ".join(f"q7_{k}" for k in range(50)))]
    found = decontaminate.contaminated(texts(spark, rows), items).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(1000, 7)]
