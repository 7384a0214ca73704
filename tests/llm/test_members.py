import pytest

import corpus_pipeline
from lotwise.llm import members
from lotwise.sources.tables import SCHEMAS


@pytest.mark.parametrize("maps", [4_096, 1])
def test_listed_rows_are_never_missed(spark, monkeypatch, maps):
    monkeypatch.setattr(members, "BITMAPS", maps)
    keys = [(key * 7919 - 10**12,) for key in range(5_000)]
    rows = [(key,) for key in range(20_000, 40_000)] + keys + keys[:10] + [(None,)]
    df = spark.createDataFrame(rows, "doc_id bigint")
    found = members.with_listed(df, "doc_id", spark.createDataFrame(keys + [(None,)], "k bigint"))
    assert found.columns == ["doc_id", "listed"] and found.count() == len(rows)
    listed = [row[0] for row in found.where("listed").collect()]
    others = len(listed) - len(keys) - 11
    assert set(listed) >= {key for (key,) in keys} | {None} and 0 <= others < (0.1 if maps > 1 else 0.2) * 20_000


def test_nothing_listed(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    assert members.with_listed(df, "doc_id", spark.createDataFrame([], "k bigint")).collect() == [(1, "x", False)]
    empty = spark.createDataFrame([], "doc_id bigint")
    assert members.with_listed(empty, "doc_id", spark.createDataFrame([(1,)], "k bigint")).collect() == []


def test_documents_that_stay_are_not_moved(spark, monkeypatch, tmp_path):
    """Only rows that may be copies are joined, however the tables grow."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    real = members.with_listed
    told = []

    def listed(df, key, keys):
        found = real(df, key, keys)
        told.append((keys.count(), found.where("listed").count(), df.count()))
        return found

    monkeypatch.setattr(corpus_pipeline, "with_listed", listed)
    monkeypatch.setattr(corpus_pipeline.minhash, "with_listed", listed)
    rows = [(key, " ".join(f"{key}_{n}" for n in range(30)), None, None, None) for key in range(400)]
    rows += [(1000 + key, rows[key][1] + " end", None, None, None) for key in range(10)]
    try:
        docs = spark.createDataFrame(rows, SCHEMAS["documents"])
        found = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
        assert sorted(row["doc_id"] for row in found.collect()) == list(range(400))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    # Texts in buckets, then copies that go.
    assert [(keys, rows) for keys, _, rows in told] == [(20, 410), (10, 410)]
    assert all(keys <= likely < 0.2 * every for keys, likely, every in told)
    assert "BroadcastHashJoin" in plan
