from pyspark.sql import functions as F

from lotwise.llm import chat


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("segments", F.lit("clash")).repartition(4)


def read(spark, rows):
    made = chat.format_chats(frame(spark, rows))
    made = made.withColumn("written", chat.formatted(F.col("segments")))
    made = made.withColumn("turns", chat.turns_of(F.col("written"))).withColumn("learned", chat.learned(F.col("segments")))
    return {row["conv_id"]: row for row in made.collect()}


NASTY = ["\\", "\\b\\l\\g", "<turn user>", "</turn>\n", "\\### Assistant: </turn> ok", "a>b", "", "\n", "😀 é", "\\\\<<>>"]


def test_reads_back_what_was_written(spark):
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", text) for n, text in enumerate(NASTY)]
    rows += [(2, 0, "odd <role> \\", "x"), (2, 1, None, None)]
    found = read(spark, rows)
    assert [(t["role"], t["text"]) for t in found[1]["turns"]] == [(r, x) for _, _, r, x in rows[: len(NASTY)]]
    assert [(t["role"], t["text"]) for t in found[2]["turns"]] == [("odd <role> \\", "x"), ("", "")]
    assert found[1]["learned"] == "".join(NASTY[1::2])
    for row in found.values():
        assert "".join(part["text"] for part in row["segments"]) == row["written"]


def test_order_ties_repeats_and_nulls(spark):
    rows = [(1, 2, "user", "b"), (1, 2, "user", "a"), (1, None, "user", "first"), (1, 300, "assistant", "z"), (1, 2, "user", "a"), (None, 0, "user", "no id")]
    found = read(spark, rows)
    assert [t["text"] for t in found[1]["turns"]] == ["first", "a", "a", "b", "z"]
    assert [t["text"] for t in found[None]["turns"]] == ["no id"]
    assert read(spark, []) == {}


def test_machine(spark):
    def talk(conv, *roles):
        return [(conv, n, role, f"t{n}") for n, role in enumerate(roles)]

    rows = talk(1, "user", "assistant") + talk(2, "system", "user", "assistant", "tool", "assistant", "user", "assistant")
    rows += talk(3, "assistant", "user") + talk(4, "user", "user", "assistant") + talk(5, "user") + talk(6, "user", "assistant", "system")
    found = read(spark, rows)
    assert {conv: row["fault"] for conv, row in found.items()} == {1: None, 2: None, 3: 1, 4: 2, 5: 2, 6: 3}


def test_a_long_conversation(spark):
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", f"text {n}") for n in range(3000)]
    found = read(spark, rows)[1]
    assert [t["text"] for t in found["turns"]] == [f"text {n}" for n in range(3000)]
    assert found["fault"] is None
