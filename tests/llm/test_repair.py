import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lotwise.llm import repair
from lotwise.llm.queries import damaged

WHITE = " \t\n\x0b\x0c\r"


def brute_force(rows):
    """Rows (turn, role, text) of one conversation: counts, and the least weight by trying all edits row by row."""
    rows = [(turn, " " if role is None else role, " " if text is None else text) for turn, role, text in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        left = text.rstrip(WHITE)
        faults.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    # All audits of each string of initials so far, cheapest only; inserts of at most three in a row.
    front = {"": (0, "", [])}

    def keep(into, initials, weight):
        # A pair that stands before another pair says nothing about what may follow.
        key = initials.replace("uau", "u")
        if re.fullmatch(r"s?(ua)*u?", initials) and (key not in into or weight[:2] < into[key][:2]):
            into[key] = weight

    def inserted(front):
        for _ in range(3):
            for initials, (cost, audit, lines) in list(front.items()):
                for role in ("user", "assistant"):
                    keep(front, initials + role[0], (cost + 3, audit + "I", lines + [role + ":"]))
        return front

    front = inserted(front)
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for initials, (cost, audit, lines) in front.items():
            keep(after, initials, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            keep(after, initials + role[:1] if role else "x", (cost + more, audit + "K", lines + [f"{role}:{text}"]))
            for name in ("user", "assistant"):
                keep(after, initials + name[0], (cost + 3 + more, audit + "R", lines + [f"{name}:{text}"]))
        front = inserted(after)
    ends = [weight for initials, weight in front.items() if re.fullmatch(r"(s?(ua)+)?", initials)]
    cost, audit, lines = min(ends, key=lambda w: w[:2])
    turns = {turn for turn, _, _ in rows if turn is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, "\n".join(lines))


def conversations(seed, count, longest=9):
    pick, rows = random.Random(seed), []
    for conv in range(count):
        for n in range(pick.randint(1, longest)):
            turn = pick.choice([n, n, n, n + 1, 2 * n, None]) if pick.random() < 0.3 else n
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "until"])
            text = pick.choice(["one.", "two!", "three", "four? ", "  ", "", None, f"text {n}.", f"text {conv} {n}!\n"])
            rows += [(conv, turn, role, text)] * pick.choice([1, 1, 1, 1, 2, 3])
    return rows


def check(spark, rows, slices=3):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(slices)
    found = {r["conv_id"]: tuple(r)[1:] for r in repair.repaired(df).collect()}
    assert set(found) == {row[0] for row in rows}
    for conv, got in found.items():
        assert got == brute_force([row[1:] for row in rows if row[0] == conv]), conv
    return found


def test_small_conversations_equal_brute_force(spark):
    found = check(spark, conversations(1, 300))
    assert len({row[6] for row in found.values()}) > 150


def test_blocks_and_borders_equal_brute_force(spark, many_slices, monkeypatch):
    # A few rows to a block, two blocks to a span, conversations over several tasks.
    monkeypatch.setattr(repair, "BLOCK_ROWS", 4)
    monkeypatch.setattr(repair, "FAN", 2)
    check(spark, conversations(2, 12, longest=120), slices=8)


def test_one_conversation_of_many_rows(spark, many_slices):
    pick = random.Random(7)
    rows = [(5, n, pick.choice(["user", "assistant"]), f"text {n}{pick.choice(['.', '', '!'])}") for n in range(5000)]
    check(spark, rows + [(4, 0, "user", "a."), (4, 1, "assistant", "b.")] + [(5, 17, "user", "same.")] * 300)


def test_spans_join_like_whole_blocks():
    pick = random.Random(3)
    for _ in range(60):
        rows = [
            {"role": pick.choice(["user", "assistant", "system", "x"]), "fault": pick.choice([None, None, "truncated", "blank", "duplicate"]), "copies": pick.choice([1, 1, 2]), "text": ""}
            for _ in range(pick.randint(0, 14))
        ]
        at = sorted(pick.choices(range(len(rows) + 1), k=2))
        blocks = [repair.spans_of(part) for part in (rows[: at[0]], rows[at[0] : at[1]], rows[at[1] :])]
        together = {key: weight[:2] for key, weight in repair.joined(blocks).items()}
        assert together == repair.spans_of(rows)
        ends = [together[0, q] for q in repair.ENDS if (0, q) in together]
        assert min(ends) == repair.best_of(rows)


def test_agenda_is_knuths():
    # An and-or graph: c needs a and b, d needs c twice; a shortcut to d is dearer.
    rules = {"c": (("a", "b"), 1), "d": (("c", "c"), 1)}

    def deduce(item, weight, done):
        for head, (body, cost) in rules.items():
            if item in body and all(part in done for part in body):
                yield sum(done[part] for part in body) + cost, head, item

    done, came = repair.lightest([(1, "a"), (5, "b"), (20, "d")], deduce, {"d"})
    assert done == {"a": 1, "b": 5, "c": 7, "d": 15} and came["d"] == "c"


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, 1), (None, 3, "user", "x.", 1), (1, 9_000_000_000, "user", "y.", 2), (1, -5, "assistant", "z" * 300_000 + ".", 3)],
        "conv_id bigint, turn bigint, role string, text string, cost int",
    )
    found = {r["conv_id"]: r for r in repair.repaired(df).collect()}
    assert (found[None]["audit"], found[None]["cost"], found[None]["blank"], found[None]["illegal"]) == ("DKI", 7, 1, 1)
    assert found[1]["gaps"] == 9_000_000_004 and found[1]["audit"] == "IKKI" and found[1]["repaired"] == f"user:\nassistant:{'z' * 300_000}.\nuser:y.\nassistant:"
    gone = repair.repaired(df, gone=F.lit(True)).collect()
    assert sorted(str(r[0]) for r in gone) == ["1", "None"] and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", "") for r in gone)
    assert repair.repaired(df.where("false")).count() == 0
    same = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], "conv_id string, turn int, role string, text string")
    assert [tuple(r) for r in repair.repaired(same).collect()] == [("1", 0, 0, 0, 0, 0, 0, "KK", "user:a.\nassistant:b.")]


@pytest.mark.parametrize("turn", [None, 4])
def test_damage_keeps_every_conversation(spark, turn):
    rows = [(conv, turn, None, None) for conv in range(200)] + [(None, turn, "user", "a.")]
    df = damaged(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    found = repair.repaired(df, gone=F.col("gone")).collect()
    assert sorted(str(r[0]) for r in found) == sorted(str(row[0]) for row in rows)
    assert {r["audit"] for r in found if r[0] is not None} == {"", "D", "DD"} or turn is None
