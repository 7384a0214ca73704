"""The fitted operators: held-out accuracy, and every odd row."""

import contextlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import language, quality, toxicity
from lotwise.llm.queries import QUERIES
from tests.llm.cases import TEXTS, clashing, texts

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    return {name: read(name).toPandas() for name in ("documents", "labels")}


def remainder(key, modulus):
    return zlib.crc32(str(key).encode()) % modulus


def test_language_is_found(spark, tables):
    found = QUERIES["op2_language"](spark, FOLDER).toPandas().merge(tables["documents"], on="doc_id")
    assert len(found) == len(tables["documents"])
    assert (found["held_out"] == [remainder(key, 3) == 1 for key in found["doc_id"]]).all()
    held = found[found["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert found["score"].between(0, 1).all()


@pytest.mark.parametrize("name, label, modulus, rest, least", [("op7_quality", "quality", 5, 0, 0.95), ("op10_toxicity", "toxic", 4, 2, 0.9)])
def test_labels_are_found(spark, tables, name, label, modulus, rest, least):
    found = QUERIES[name](spark, FOLDER).toPandas()
    assert len(found) == len(tables["documents"])
    assert (found["held_out"] == [remainder(key, modulus) == rest for key in found["doc_id"]]).all()
    assert (found["predicted"] == (found["score"] >= 0.3)).all() and found["score"].between(0, 1).all()
    held = found[found["held_out"]].merge(tables["labels"], on="doc_id")
    assert (held["predicted"] == held[label]).mean() > least


LANGS = [(n, "the and of word", "en") for n in range(9)] + [(20 + n, "der und die wort", "de") for n in range(9)] + [(50 + n, "слово и в не", "ru") for n in range(9)]


def test_spans_of_mixed_text(spark):
    model = language.trained(spark.createDataFrame(LANGS, "doc_id bigint, text string, lang string"))
    mixed = "the word and the word of the word. der und die wort und die wort. слово"
    row = language.identified(texts(spark, [(1, mixed)]), model).first()
    assert [(s["lang"], mixed[s["start"] : s["stop"]].split()[0]) for s in row["spans"]] == [("en", "the"), ("de", "der"), ("ru", "слово")]
    assert row["lang_pred"] in ("en", "de")


def test_language_of_odd_rows(spark):
    model = language.trained(spark.createDataFrame(LANGS + [(99, "none", None)], "doc_id bigint, text string, lang string"))
    found = language.identified(clashing(spark), model).collect()
    assert len(found) == len(TEXTS)
    for row in found:
        has = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] != "und") == has and (row["score"] == 0 or has) and bool(row["spans"]) == has
    nothing = language.trained(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert {row["lang_pred"] for row in language.identified(texts(spark), nothing).collect()} == {"und"}
    assert language.identified(texts(spark, []), model).count() == 0


def test_viterbi_equals_brute_force():
    pick = np.random.default_rng(7)
    model = language.Model(("a", "b", "c"), np.zeros((language.BUCKETS, 3)), np.ones((language.N_SCRIPTS, 3), bool))
    scores = pick.normal(0, 3, (40, 3))
    sizes = np.array([7, 0, 5, 12])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    which = pick.integers(0, 40, begin[-1])
    path = np.empty(begin[-1], np.int64)
    docs = np.argsort(-sizes, kind="stable")
    docs = docs[sizes[docs] > 0]
    model._paths(scores, which, begin, sizes, docs, path)

    def value(way, own):
        return sum(scores[w, s] for w, s in zip(own, way)) - language.SWITCH * sum(a != b for a, b in zip(way, way[1:]))

    for doc in docs:
        own = which[begin[doc] : begin[doc + 1]]
        table = scores[own[0]].copy()
        for word in own[1:]:
            table = np.array([max(table[old] - language.SWITCH * (old != new) for old in range(3)) for new in range(3)]) + scores[word]
        assert np.isclose(value(path[begin[doc] : begin[doc + 1]], own), table.max())


def test_pairs_rank_the_better_text_higher():
    pick = np.random.default_rng(8)
    rows = pick.normal(size=(400, quality.N_FEATURES))
    labels = (rows[:, 0] - rows[:, 1] > -0.8).astype(int)
    ranker = quality.fit(rows, labels)
    assert ((ranker.score(rows) >= quality.CUT).astype(int) == labels).mean() > 0.9
    assert ranker.weights[0] > 0 > ranker.weights[1]


def labelled(spark, *values):
    return spark.createDataFrame([(key, value) for key, value in zip((1, 3, 5, 6, 7, 8), values)], "doc_id bigint, mark int")


@pytest.mark.parametrize("values", [(1, 0, 1, 0, 1, 0), (1, 1, 1), (), (None, 1, 0)])
@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_of_odd_rows(spark, module, values):
    model = module.trained(texts(spark), labelled(spark, *values), label="mark")
    found = module.scored(clashing(spark), model).collect()
    assert len(found) == len(TEXTS)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.3) for row in found)
    assert len({row["score"] for row in found if row["doc_id"] in (1, 7)}) == 1
    assert module.scored(texts(spark, []), model).count() == 0


def test_windows_cover_every_word():
    given = ["", " ".join(f"w{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(131)), "one"]
    words = toxicity.Words(given)
    assert words.doc.tolist() == [0] + [1] * 6 + [2]
    seen = [set(words.windows[words.doc == d][words.real[words.doc == d]].tolist()) for d in range(3)]
    assert [len(s) for s in seen] == [0, 131, 1]


def test_gradient_of_the_network():
    pick = np.random.default_rng(9)
    network = toxicity.Network.fresh(pick)
    network.weights = {name: value.astype(np.float64) for name, value in network.weights.items()}
    inputs = pick.normal(size=(30, toxicity.INPUTS))
    windows, real = pick.integers(0, 30, (5, toxicity.WINDOW)), np.ones((5, toxicity.WINDOW), bool)
    real[0, 7:] = False
    label = np.array([0.0, 1, 0, 1, 1])

    def loss():
        logit = network._pooled(network._states(inputs, windows, False)[0], real)[1] @ network.weights["w"] + network.weights["b"][0]
        return np.mean(np.log1p(np.exp(logit)) - label * logit)

    slopes = network.gradient(inputs, windows, real, label, np.ones(5))
    for name, value in network.weights.items():
        at = (0,) * value.ndim
        kept = value[at]
        value[at] = kept + 1e-3
        up = loss()
        value[at] = kept - 1e-3
        down = loss()
        value[at] = kept
        assert np.isclose(slopes[name][at], (up - down) / 2e-3, rtol=1e-2, atol=1e-5), name


def test_every_language_is_learned(spark):
    """Seventy invented languages, each with letters of its own in other proportions."""
    pick = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    rows = []
    for number in range(70):
        words = ["".join(pick.choice(letters, size=pick.integers(2, 7))) for _ in range(40)]
        rows += [(number * 100 + n, " ".join(pick.choice(words, size=60)), f"l{number:02d}") for n in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.trained(df.where("doc_id % 100 < 4"))
    assert len(model.names) == 70
    found = language.identified(df.where("doc_id % 100 >= 4"), model)
    assert found.where("lang = lang_pred").count() > 0.95 * found.count()


def test_samples_of_a_language_are_bounded(spark):
    many = spark.range(20_000).selectExpr("id AS doc_id", "'some words ' || id AS text", "IF(id % 100 = 0, 'b', 'a') AS lang")
    model = language.trained(many, sample=50)
    assert model.names == ("a", "b") and np.isfinite(model.table).all()


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_repeated_rows_are_one_training_document(spark, monkeypatch, module, label):
    rows = [(n, f"good plain words number {n} and more of them" if n % 2 else f"bad bad!! {n} $$ ugly {n}") for n in range(40)]
    marks = spark.createDataFrame([(n, n % 2) for n in range(40)], f"doc_id bigint, {label} int")
    seen, real = [], module.fit
    monkeypatch.setattr(module, "fit", lambda rows, *rest: seen.append(np.array(rows)) or real(rows, *rest))
    module.trained(texts(spark, rows), marks, sample=20)
    module.trained(texts(spark, rows + [rows[3]] * 3000 + [rows[8]] * 500).repartition(7), marks, sample=20)
    assert 10 <= len(seen[0]) <= 20 and np.array_equal(seen[0], seen[1])


def test_all_labelled_documents_are_learned(spark, monkeypatch):
    """More documents than a block, the marks of most of them turned: a part would learn the opposite or find another cut."""
    monkeypatch.setattr(quality, "BLOCK", 64)
    rows = [(n, f"plain words and more of them {n}" if n % 4 else f"ugly $$ text!! {n} $$") for n in range(900)]
    marks = spark.createDataFrame([(n, int(n % 4 > 0)) for n in range(900)] + [(None, 1), (5000, 0)], "doc_id bigint, quality int")
    docs = texts(spark, rows + [rows[3]] * 400 + [(None, "ugly $$")])
    monkeypatch.setattr(quality, "fit", None)  # nothing is fitted to rows on the driver
    seen, real = [], quality._blocks
    monkeypatch.setattr(quality, "_blocks", lambda rows, counts: seen.append(real(rows, counts)) or seen[-1])
    monkeypatch.setattr(quality, "scratch", contextlib.nullcontext)
    model = quality.trained(docs, marks)
    sizes = [len(row["marks"]) for row in seen[0].collect()]
    assert sum(sizes) == 900 and len(sizes) == 15
    again = quality.trained(docs.repartition(11), marks)
    assert np.array_equal(model.weights, again.weights) and model.cut == again.cut
    found = quality.scored(texts(spark, rows), model).collect()
    assert all(row["predicted"] == int(row["doc_id"] % 4 > 0) for row in found)


def test_cut_is_the_share_of_zeros(spark):
    pick = np.random.default_rng(3)
    rows = pick.normal(size=(5000, quality.N_FEATURES)).astype(np.float32)
    labels = (rows[:, 0] + pick.normal(size=5000) > 0.7).astype(int)
    ranker = quality.fit(rows, labels)
    assert ranker.cut == pytest.approx(np.quantile(ranker.raw(rows), (labels == 0).mean(), method="midpoint"), abs=1e-9)
