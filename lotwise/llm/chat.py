"""Chat formatting: a finite-state machine over roles, and text segments with a loss flag from a declarative template.

DataFrame functions only. The state of the machine is the role last read, so a turn is legal if the pair of roles is in
the transition table; every conversation is formatted, and the first illegal turn is reported. Rows are ordered by turn,
ties by role and text, null turns first; a null role or text counts as empty; repeated rows are turns of their own; an
empty table gives an empty result; further columns are ignored.

Markers start with ``<``, and the characters ``\\``, ``<`` and ``>`` inside roles and texts are written ``\\b``, ``\\l`` and
``\\g``: no marker can occur inside a text, and ``turns_of`` reads back exactly what was put in.

A conversation is one string at the end and has to fit into one cell. Until then it is handled in blocks of turns, so a
conversation with a third of all rows is sorted and escaped by many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
TURNS_PER_BLOCK = 128


@dataclass(frozen=True)
class Template:
    opening: tuple[str, str] = ("<turn ", ">")  # around the role
    closing: str = "</turn>\n"
    learned: tuple[str, ...] = ("assistant",)
    start: tuple[str, ...] = ("system", "user")
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant", "tool"),
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if not (self.opening[0].startswith("<") and self.closing.startswith("<") and self.opening[1].startswith(">")):
            raise ValueError("markers must begin with the characters that texts escape")


def escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def format_chats(df: DataFrame, template: Template = Template(), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, segments, fault): segments are (text, loss) in order, their texts joined are the formatted conversation.

    ``fault`` is the place (from 1) of the first turn that the machine refuses, one past the last turn if the
    conversation ends in a state that is not final, null if it is well-formed.
    """
    of_row = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    block = F.floor(F.col(turn) / TURNS_PER_BLOCK)
    rows = df.select(F.col(conv).alias("_conv"), block.alias("_block"), of_row.alias("_row"))
    blocks = rows.groupBy("_conv", "_block").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    begin, end = template.opening

    def segments(row: Column) -> Column:
        opening = F.concat(F.lit(begin), escaped(row["role"]), F.lit(end))
        parts = ((opening, F.lit(False)), (escaped(row["text"]), row["role"].isin(*template.learned)), (F.lit(template.closing), F.lit(False)))
        return F.array(*(F.struct(part.alias("text"), loss.alias("loss")) for part, loss in parts))

    blocks = blocks.select(
        "_conv",
        F.struct(
            F.col("_block").alias("block"),
            F.transform("_rows", lambda row: row["role"]).alias("roles"),
            F.flatten(F.transform("_rows", segments)).alias("segments"),
        ).alias("_part"),
    )
    whole = blocks.groupBy("_conv").agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
    whole = whole.select("_conv", F.flatten("_parts.segments").alias("segments"), F.flatten("_parts.roles").alias("_roles"))
    legal = [f"{a}>{b}" for a, after in template.follows.items() for b in after]
    # The machine reads every role after the one before it, and a mark for the end after the last.
    read = F.concat("_roles", F.array(F.lit(None)))
    state = F.concat(F.array(F.lit(None)), "_roles")
    accepted = F.zip_with(
        state,
        read,
        lambda old, new: F.when(new.isNull(), old.isin(*template.final))
        .when(old.isNull(), new.isin(*template.start))
        .otherwise(F.concat(old, F.lit(">"), new).isin(*legal)),
    )
    fault = F.nullif(F.array_position(accepted, False), F.lit(0))
    return whole.select(F.col("_conv").alias(conv), "segments", fault.alias("fault"))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda part: part["text"]), "")


def turns_of(written: Column, template: Template = Template()) -> Column:
    """The (role, text) turns of a formatted conversation."""
    pieces = F.split(written, "\\Q" + template.closing + "\\E", -1)
    begin, end = template.opening

    def turn(piece: Column) -> Column:
        parts = F.split(F.substr(piece, F.lit(len(begin) + 1)), "\\Q" + end + "\\E", 2)
        return F.struct(unescaped(parts[0]).alias("role"), unescaped(parts[1]).alias("text"))

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def learned(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda part: part["loss"]), lambda part: unescaped(part["text"])), "")
