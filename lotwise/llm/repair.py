"""Cheapest repair of conversations by Knuth's lightest derivations.

The rows of a conversation go by turn, null turns first, ties by role and the SHA-256 of role and text. Null roles and
texts are one space. Each row has at most one fault, the first of: blank (nothing but ASCII white space), duplicate (role
and text stood in the conversation before), truncated (the last character that is not white space is none of ``.!?``).

An audit is a string of edits: K keeps a row (0), R gives it the role user or assistant (3), D deletes it (4; blank and
duplicate rows must go), I inserts an empty turn of user or assistant (3). A truncated row that stays costs 3 more. The
first letters of the roles that remain must read ``(s?(ua)+)?``; of the cheapest audits the least in ASCII is taken.

Repair as deduction. States are those of the automaton: empty, after s, after u, after a. An item (i, q) says that the
first i rows of a block are edited and the state is q, an item (k, p, q) that block k leads from p to q; a prefix item and
the block item that begins where it ends are the two antecedents of the next prefix. Weights are (cost, audit), ordered
by cost, then audit. All deductions add cost and append letters, so they never lighten, and they keep the order of two
audits: of two of equal cost for the same item none begins with the other, as its further letters could only be
inserts, which cost. The agenda therefore pops every item at its least weight, and the goal is final once popped.

Rows are sorted by range, so a conversation with a third of all rows spans many tasks. Conversations inside a task are
repaired there; others are cut into blocks of bounded size, blocks become items for all pairs of states, and items are
joined 64 by 64 until one block is left. The audit and the repaired text of a conversation are one cell each in the end.

Equal rows are counted first. A conversation whose rows are all marked as gone has zeros, an empty audit and an empty
text. An empty table gives an empty result; further columns are ignored; a null id is a conversation like others.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lotwise.llm.batches import chunks, rows_per_batch
from lotwise.operators.ordered import joined_null_safe
from lotwise.sources.workspace import stage

SPACE = " \t\n\x0b\x0c\r"
STATES = EMPTY, AFTER_S, AFTER_U, AFTER_A = range(4)
#: Where the automaton goes by the first letter of a role, the only role that may be inserted in a state, and its end states.
STEP = {(EMPTY, "s"): AFTER_S, (EMPTY, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
WANTED = {EMPTY: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
ENDS = {EMPTY, AFTER_A}
LEGAL = {"su", "ua", "au"}
RENAMED, DELETED, INSERTED, TRUNCATED = 3, 4, 3, 3
BLOCK_ROWS, BLOCK_CHARS, FAN = 256, 4_000_000, 64
BATCH = 1_000  # rows sent to Python at once

Weight = tuple[int, str]


def lightest(axioms: Iterable[tuple], deduce: Callable, goals: set) -> tuple[dict, dict]:
    """The least weight of every item that is finalised before the last goal, and the antecedent that it came from.

    ``axioms`` are (weight, item); ``deduce`` gives (weight, conclusion, antecedent) for a popped item, its weight and all
    items finalised so far. Deductions must be superior functions: monotone, and never lighter than an antecedent.
    """
    agenda = [(weight, item, None) for weight, item in axioms]
    heapq.heapify(agenda)
    done, came, open_ = {}, {}, set(goals)
    while agenda and open_:
        weight, item, antecedent = heapq.heappop(agenda)
        if item in done:
            continue
        done[item], came[item] = weight, antecedent
        open_.discard(item)
        if not open_:
            break
        for heavier, conclusion, of in deduce(item, weight, done):
            if conclusion not in done:
                heapq.heappush(agenda, (heavier, conclusion, of))
    return done, came


def _edits(rows: list[dict]) -> Callable:
    """Deductions over the rows of a block: dicts with role, fault and copies, the first of which may stay."""

    def deduce(item: tuple[int, int], weight: Weight, done: dict) -> Iterator[tuple]:
        at, state = item
        cost, audit = weight
        wanted = WANTED[state]
        target = STEP[state, wanted[0]]
        yield (cost + INSERTED, audit + "I"), (at, target), item
        if at == len(rows):
            return
        row = rows[at]
        more = "D" * (row["copies"] - 1)
        rest = cost + DELETED * (row["copies"] - 1)
        yield (rest + DELETED, audit + "D" + more), (at + 1, state), item
        if row["fault"] in ("blank", "duplicate"):
            return
        rest += TRUNCATED * (row["fault"] == "truncated")
        yield (rest + RENAMED, audit + "R" + more), (at + 1, target), item
        kept = STEP.get((state, row["role"][:1]))
        if kept is not None:
            yield (rest, audit + "K" + more), (at + 1, kept), item

    return deduce


def spans_of(rows: list[dict], starts: Iterable[int] = STATES) -> dict[tuple[int, int], Weight]:
    """The lightest audit of a block from each of the states to every state."""
    found = {}
    for start in starts:
        done, _ = lightest([((0, ""), (0, start))], _edits(rows), {(len(rows), state) for state in STATES})
        found |= {(start, state): done[len(rows), state] for state in STATES if (len(rows), state) in done}
    return found


def best_of(rows: list[dict]) -> Weight:
    """The lightest audit of a whole conversation; its goal follows from every end state after the last row."""
    edits, goal = _edits(rows), (len(rows) + 1, EMPTY)

    def deduce(item: tuple[int, int], weight: Weight, done: dict) -> Iterator[tuple]:
        yield from edits(item, weight, done)
        if item[0] == len(rows) and item[1] in ENDS:
            yield weight, goal, item

    return lightest([((0, ""), (0, EMPTY))], deduce, {goal})[0][goal]


def joined(blocks: list[dict]) -> dict[tuple[int, int], tuple[int, str, list[int]]]:
    """Spans over neighbouring blocks, each a dict of (p, q): weight; with the state in which each block begins.

    A span of block k is the item (1, k, p, q), a prefix before block k that ends in state p the item (0, k, p, p).
    """
    spans = [(weight, (1, k, p, q)) for k, block in enumerate(blocks) for (p, q), weight in block.items()]
    after = {}
    for weight, item in spans:
        after.setdefault(item[1:3], []).append(item)

    def deduce(item, weight, done):
        kind, k, p, q = item
        if kind == 0:
            pairs = [(item, span) for span in after.get((k, p), ()) if span in done]
        else:
            pairs = [((0, k, p, p), item)] if (0, k, p, p) in done else []
        for prefix, span in pairs:
            (cost, audit), (more, letters) = done[prefix], done[span]
            yield (cost + more, audit + letters), (0, k + 1, span[3], span[3]), prefix

    found = {}
    for start in {p for p, _ in blocks[0]}:
        ends = {(0, len(blocks), state, state) for state in STATES}
        done, came = lightest([*spans, ((0, ""), (0, 0, start, start))], deduce, ends)
        for end in ends & done.keys():
            entries, item = [], came[end]
            while item is not None:
                entries.append(item[2])
                item = came[item]
            found[start, end[2]] = (*done[end], entries[::-1])
    return found


def lines_of(rows: list[dict], audit: str, state: int) -> list[str]:
    """The repaired turns of a block, written ``role:text``."""
    lines, letters = [], iter(audit)

    def insert() -> None:
        nonlocal state
        lines.append(WANTED[state] + ":")
        state = STEP[state, WANTED[state][0]]

    for row in rows:
        for letter in letters:
            if letter != "I":
                break
            insert()
        if letter != "D":
            role = row["role"] if letter == "K" else WANTED[state]
            lines.append(f"{role}:{row['text']}")
            state = STEP[state, role[0]]
        for _ in range(row["copies"] - 1):
            next(letters)
    for _ in letters:
        insert()
    return lines


def facts_of(rows: list[dict]) -> dict:
    """What is counted of a block, such that neighbouring blocks can be added up."""
    turns = [row["turn"] for row in rows if row["turn"] is not None]
    roles = [row["role"][:1] for row in rows]
    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
    for row in rows:
        if row["fault"]:
            faults[row["fault"]] += row["copies"] if row["fault"] in ("blank", "duplicate") else 1
        if row["fault"] not in ("blank", "duplicate"):
            faults["duplicate"] += row["copies"] - 1
    illegal = sum(a + b not in LEGAL for a, b in zip(roles, roles[1:])) + sum(row["copies"] - 1 for row in rows)
    ends = {"first": roles[0], "last": roles[-1]} if rows else {"first": None, "last": None}
    return {**faults, "illegal": illegal, **ends, "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns))}


def added(left: dict, right: dict) -> dict:
    total = {name: left[name] + right[name] for name in ("blank", "duplicate", "truncated", "illegal", "turns")}
    if left["last"] is not None and right["first"] is not None:
        total["illegal"] += left["last"] + right["first"] not in LEGAL
    if left["high"] is not None and left["high"] == right["low"]:
        total["turns"] -= 1
    total["first"] = right["first"] if left["first"] is None else left["first"]
    total["last"] = left["last"] if right["last"] is None else right["last"]
    total["low"] = right["low"] if left["low"] is None else left["low"]
    total["high"] = left["high"] if right["high"] is None else right["high"]
    return total


FACTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, turns bigint"
SPANS = "spans array<struct<start:int,end:int,cost:bigint,audit:string,entries:array<int>,sizes:array<bigint>>>"
ROWS = "rows array<struct<role:string,text:string,copies:bigint>>"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def _span_rows(spans: dict) -> list[dict]:
    """Spans as they are written; the audit of a span is made of one piece, of the given size, for each block in it."""
    return [
        {"start": p, "end": q, "cost": cost, "audit": audit, "entries": rest[0] if rest else [p], "sizes": rest[1] if rest else [len(audit)]}
        for (p, q), (cost, audit, *rest) in spans.items()
    ]


def _blocks(schema: pa.Schema) -> Callable:
    """Sorted rows into conversations that are wholly inside the task, repaired, and blocks of the others."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(last: bool) -> dict:
            nonlocal number
            made = {"id": conv, **facts_of(rows)}
            if last and whole:
                cost, audit = best_of(rows)
                return made | {"cost": cost, "audit": audit, "repaired": "\n".join(lines_of(rows, audit, EMPTY))}
            number += 1
            kept = [{"role": row["role"], "text": row["text"], "copies": row["copies"]} for row in rows]
            return made | {"number": number - 1, "spans": _span_rows(spans_of(rows)), "rows": kept}

        def written() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(out, schema=schema)

        conv, rows, out, number, chars = None, [], [], 0, 0
        seen = 0  # conversations of this task before the present one, which may have begun in another task
        whole = started = False
        for batch in batches:
            for piece in chunks(batch, batch.schema.get_field_index("text")):
                for row in piece.to_pylist():
                    if not started or row["id"] != conv:
                        if started:
                            out.append(block(last=True))
                            seen += 1
                        conv, rows, chars, started, whole = row["id"], [], 0, True, seen > 0
                    elif len(rows) >= BLOCK_ROWS or chars > BLOCK_CHARS:
                        whole = False
                        out.append(block(last=False))
                        rows, chars = [], 0
                    if row.pop("gone"):
                        continue
                    text = row["text"].rstrip(SPACE)
                    row["fault"] = "blank" if not text else "duplicate" if row["later"] else "truncated" if text[-1] not in ".!?" else None
                    rows.append(row)
                    chars += len(row["text"])
                if out:
                    yield written()
                    out = []
        if started:
            whole = False  # it may go on in the next task
            out = [block(last=True)]
            yield written()

    return each


def _merged(schema: pa.Schema) -> Callable:
    def each(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda part: part["place"])
        facts = parts[0]
        for part in parts[1:]:
            facts = added(facts, part)
        known = [{(span["start"], span["end"]): span for span in part["spans"]} for part in parts]
        spans = {}
        for (p, q), (cost, audit, states) in joined([{key: (span["cost"], span["audit"]) for key, span in block.items()} for block in known]).items():
            used = [block[state, after] for block, state, after in zip(known, states, [*states[1:], q])]
            spans[p, q] = cost, audit, [n for span in used for n in span["entries"]], [n for span in used for n in span["sizes"]]
        row = {name: facts[name] for name in schema.names if name in facts}
        row |= {"id": parts[0]["id"], "place": parts[0]["place"] // FAN, "spans": _span_rows(spans)}
        return pa.Table.from_pylist([row], schema=schema)

    return each


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits, cut into the pieces of their blocks."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            audit, states, sizes = (row.column(name)[0].as_py() for name in ("audit", "entries", "sizes"))
            ends = [0, *itertools.accumulate(sizes)]
            columns = [
                pa.repeat(row.column("id")[0], len(states)),
                pa.array(range(len(states)), pa.int64()),
                pa.array(states, pa.int32()),
                pa.array([audit[a:b] for a, b in zip(ends, ends[1:])], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "place", "state", "piece"])


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their state and their piece of the audit, into their lines."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            rows, piece, state = (row.column(name)[0].as_py() for name in ("rows", "piece", "state"))
            lines = pa.array(["\n".join(lines_of(rows, piece, state))], pa.string())
            yield pa.RecordBatch.from_arrays([row.column("id"), row.column("place"), lines], names=["id", "place", "lines"])


def _arrow(df: DataFrame, ddl: str) -> pa.Schema:
    """The Arrow schema of an id of ``df`` and the columns of ``ddl``."""
    return to_arrow_schema(StructType([df.schema["id"], *StructType.fromDDL(ddl)]))


def _ddl(df: DataFrame, ddl: str) -> str:
    return f"id {df.schema['id'].dataType.simpleString()}, {ddl}"


def repaired(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: Column | None = None) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired), a row for each conversation.

    ``gaps`` are the turn numbers missing between the first and the last, ``illegal`` the neighbours among the rows whose
    roles do not begin with su, ua or au, ``repaired`` the lines ``role:text``. Rows that are ``gone`` name a conversation.
    """
    gone = F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)
    rows = df.select(
        F.col(conv).alias("id"),
        gone.alias("gone"),
        F.when(~gone, F.col(turn).cast("bigint")).alias("turn"),
        F.when(gone, "").otherwise(F.coalesce(F.col(role).cast("string"), F.lit(" "))).alias("role"),
        F.when(gone, "").otherwise(F.coalesce(F.col(text).cast("string"), F.lit(" "))).alias("text"),
    )
    rows = rows.groupBy("id", "gone", "turn", "role", "text").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("same", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    # Where a role and text that comes back stands first; nulls are the first turns.
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    again = rows.where("NOT gone").groupBy("id", "same").agg(first, F.count("*").alias("often")).where("often > 1")
    again = again.select(F.col("id").alias("of"), F.col("same").alias("of_same"), "first")
    rows = rows.join(again, F.col("id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("of_same")), "left")
    later = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    order = ["id", F.col("turn").asc_nulls_first(), "role", "same"]
    rows = rows.select("id", "gone", "turn", "role", "same", "text", "copies", later.alias("later"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("same")

    ddl = f"{FACTS}, cost bigint, audit string, repaired string, number bigint, {SPANS}, {ROWS}"
    with rows_per_batch(df.sparkSession, BATCH):
        cut = rows.mapInArrow(_blocks(_arrow(rows, ddl)), _ddl(rows, ddl))
        cut = stage(cut.withColumn("task", F.spark_partition_id()), "blocks")
    gaps = F.when(F.col("low").isNotNull(), F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(F.lit(0).cast("bigint")).alias("gaps")
    shown = [F.col("id").alias(conv), gaps, *COUNTS[1:], "cost", "audit", "repaired"]
    return cut.where("spans IS NULL").select(*shown).unionByName(_from_blocks(cut.where("spans IS NOT NULL")).select(*shown))


def _from_blocks(cut: DataFrame) -> DataFrame:
    """Conversations in several blocks, or at the border of a task. All blocks of one stand one after the other."""
    # One row per task is broadcast: how many blocks come before its own.
    sizes = cut.groupBy("task").agg((F.max("number") + 1).alias("size"))
    before = F.sum("size").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("task", F.coalesce(before, F.lit(0)).alias("before"))
    placed = cut.join(F.broadcast(offsets), "task").withColumn("at", F.col("before") + F.col("number")).drop("task", "before", "number")
    begin = placed.groupBy("id").agg(F.min("at").alias("begin"))
    parts = joined_null_safe(placed, begin, ["id"]).withColumn("place", F.col("at") - F.col("begin"))
    parts = stage(parts.drop("at", "begin", "cost", "audit", "repaired"), "parts")

    ddl = f"place bigint, {FACTS}, {SPANS}"
    level = parts.drop("rows")
    while level.where("place > 0").limit(1).count():
        groups = level.groupBy(F.col("id").alias("_id"), F.expr(f"place DIV {FAN}").alias("_group"))
        level = stage(groups.applyInArrow(_merged(_arrow(parts, ddl)), _ddl(parts, ddl)), "level")
    ways = F.filter("spans", lambda span: (span["start"] == EMPTY) & span["end"].isin(*ENDS))
    ways = F.transform(ways, lambda span: F.struct(span["cost"], span["audit"], span["entries"], span["sizes"]))
    goal = level.withColumn("goal", F.array_min(ways)).select("*", "goal.*").drop("spans", "goal")

    pieces = goal.select("id", "audit", "entries", "sizes").mapInArrow(_pieces, _ddl(parts, "place bigint, state int, piece string"))
    found = joined_null_safe(parts.select("id", "place", "rows"), pieces, ["id", "place"])
    lines = found.select("id", "place", "rows", "state", "piece").mapInArrow(_applied, _ddl(parts, "place bigint, lines string"))
    rows = F.sort_array(F.collect_list(F.struct("place", "lines")))
    text = F.array_join(F.transform(F.filter(rows, lambda row: row["lines"] != ""), lambda row: row["lines"]), "\n").alias("repaired")
    return joined_null_safe(goal, lines.groupBy("id").agg(text), ["id"])
