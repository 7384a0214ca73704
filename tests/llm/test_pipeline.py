import re

import pytest

import __spark_entry__
import pyarrow as pa

import corpus_pipeline
from lotwise.llm import batches
from lotwise.llm import bpe
from lotwise.llm.queries import QUERIES, SQL
from lotwise.sources.tables import SCHEMAS
from lotwise.sources.workspace import stage
from tests.conftest import SMALL
from tests.llm.cases import TEXTS
from tests.llm.test_minhash import brute_force
from tests.oracle import connect, normal

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert set(__spark_entry__.queries()) >= {*QUERIES, "pipeline"}
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(SQL))
def test_twins(spark, name):
    df = QUERIES[name](spark, SMALL)
    cursor = connect(SMALL).execute(SQL[name])
    assert normal(df.columns, [tuple(row) for row in df.collect()]) == normal([item[0] for item in cursor.description], cursor.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sizes = [docs.count()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(step(spark, docs, SMALL), name)
        assert docs.columns == COLUMNS
        sizes.append(docs.count())
        if name == "near_duplicates":
            kept = [key for key, _, component in brute_force([tuple(r) for r in before.select("doc_id", "text").collect()], corpus_pipeline.NEAR) if key == component]
            assert sorted(r[0] for r in docs.select("doc_id").collect()) == kept
    assert sizes == sorted(sizes, reverse=True) and sizes[3] == sizes[4] and sizes[-1] > 0.6 * sizes[0]
    assert not [r for r in docs.select("text").collect() if re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r[0])]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    codec = bpe.codec_of("word_bpe_49k.json")
    want = {r["doc_id"]: codec.encode([r["text"]])[0].tobytes() for r in docs.collect()}
    assert {r["doc_id"]: bytes(r["token_ids"]) for r in last} == want


@pytest.mark.parametrize("rows", [[(key, text, None, None, None, "clash") for key, text in TEXTS], []])
def test_odd_rows(spark, tmp_path, rows):
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.createDataFrame(rows, SCHEMAS["documents"] + ", score string")
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, str(tmp_path)), name)
        assert docs.columns == COLUMNS
    left = sorted(str(r[0]) for r in docs.collect())
    # Without labels every text passes; of the repeated and the equal texts one row stays, and texts without words.
    assert left == (["1", "2", "3", "4", "5", "6", "8", "None"] if rows else [])
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(left)


def test_documents_are_told_apart_by_id_and_text(spark, tmp_path):
    item = " ".join(f"q{n}" for n in range(40))
    spark.createDataFrame([(1, item)], SCHEMAS["benchmark"]).write.parquet(f"{tmp_path}/benchmark.parquet")
    one, two = " ".join(f"a{n}" for n in range(30)), " ".join(f"b{n}" for n in range(30))
    rows = [(5, one), (5, two), (5, two), (None, item), (None, one), (3, f"x {item} y"), (3, two + " end"), (9, ""), (9, None), (8, one)]
    docs = spark.createDataFrame([(key, text, None, None, None) for key, text in rows], SCHEMAS["documents"])
    steps = dict(corpus_pipeline.STAGES)
    kept = sorted((str(r["doc_id"]), r["text"]) for r in steps["near_duplicates"](spark, docs, str(tmp_path)).collect() if r["text"])
    # Of the copies of the first text the smallest id stays, of the second text 3 has a near copy; a null id comes last.
    assert kept == [("3", two + " end"), ("3", f"x {item} y"), ("5", one)]
    clean = sorted((str(r["doc_id"]), str(r["text"])) for r in steps["decontamination"](spark, docs, str(tmp_path)).collect())
    assert clean == sorted((str(key), str(text)) for key, text in rows if not text or item not in text)


def test_chunks_are_small():
    """What a task holds beside a batch follows the chunk: a few hundred kilobytes of text, or one longer text."""
    batch = pa.record_batch({"text": ["x" * 100_000] * 9 + ["y" * 600_000, None]})
    sizes = [sum(len(text or "") for text in piece.column(0).to_pylist()) for piece in batches.chunks(batch, 0)]
    assert sum(sizes) == 1_500_000 and max(sizes) == 600_000 and sorted(sizes)[-2] <= 250_000
