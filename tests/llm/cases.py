"""Rows that every operator over texts has to bear: nulls, empty and very long texts, ties, repeats, clashing columns."""

from __future__ import annotations

LONG = "lorem ipsum dolor sit amet " * 20_000
TEXTS = [
    (1, "A plain sentence with a few ordinary words in it, nothing more."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "x"),
    (6, LONG),
    (7, "A plain sentence with a few ordinary words in it, nothing more."),
    (7, "A plain sentence with a few ordinary words in it, nothing more."),
    (None, "no id"),
    (8, "Ünïcödé ΣΑΣ İstanbul 中文 😀 \x00 end"),
]
CLASHES = "'mine' AS score, 1 AS predicted, 'x' AS token_ids, 2 AS decoded, 'y' AS spans, 3 AS pii_spans, 'z' AS lang_pred, 4 AS slot, 'w' AS shard"


def texts(spark, rows=TEXTS):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def clashing(spark, rows=TEXTS):
    return texts(spark, rows).selectExpr("*", *CLASHES.split(", "))
