"""Merkle trees over the paragraphs and sections of a text, in DataFrame functions only.

A paragraph is a line with the line breaks after it. Its leaves are sentences with their punctuation and breaks, longer
ones in pieces of 64 characters. A section is a row of paragraphs, ended by one whose digest begins with 0 to 3, so that
an edit moves no borders but its own. The digest of a leaf is that of its characters, the digest of a paragraph, section
or root that of the digests below it, all SHA-256.

A fingerprint is written ``root:section;section...``, a section ``paragraph,paragraph...``, a paragraph as the first
eight digits of the digests of its leaves. Equal texts have equal fingerprints, and equal branches are equal strings.

Null and empty texts have the fingerprint of the empty text. The functions are column expressions: rows are neither
moved nor dropped, repeated rows repeat, other columns do not matter, an empty table stays empty. All of them take time
in proportion to the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PARAGRAPHS = r"[^\n]+\n*|\n+"
LEAVES = r"[^.!?\n]{1,64}[.!?]*\n*|[.!?\n]+"
#: Digits of a digest kept inside the tree, and of a leaf in the fingerprint; sections end below this first digit.
INNER, SHOWN, ENDS = 16, 8, "4"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digest(text: Column) -> Column:
    return F.substr(F.sha2(text, 256), F.lit(1), F.lit(INNER))


def fingerprint(text: Column) -> Column:
    def leaves(paragraph: Column) -> Column:
        return F.transform(F.regexp_extract_all(paragraph, F.lit(LEAVES), F.lit(0)), digest)

    def after(id_: Column) -> Column:
        return F.when(id_ < ENDS, ";").otherwise(",")

    def grouped(parts: Column) -> Column:
        """The parts with their separators, but for the last."""
        return let(F.array_join(parts, ""), lambda row: F.substr(row, F.lit(1), F.length(row) - 1))

    def written(paragraphs: Column, ids: Column) -> Column:
        shown = F.transform(paragraphs, lambda own: F.array_join(F.transform(own, lambda leaf: F.substr(leaf, F.lit(1), F.lit(SHOWN))), ""))
        tree = grouped(F.zip_with(shown, ids, lambda own, id_: F.concat(own, after(id_))))
        sections = F.transform(F.split(grouped(F.transform(ids, lambda id_: F.concat(id_, after(id_)))), ";"), digest)
        return F.concat(F.sha2(F.array_join(sections, ","), 256), F.lit(":"), tree)

    paragraphs = F.transform(F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(PARAGRAPHS), F.lit(0)), leaves)
    return let(paragraphs, lambda own: let(F.transform(own, lambda row: digest(F.array_join(row, ""))), lambda ids: written(own, ids)))


def sections(print_: Column) -> Column:
    return F.split(F.substring_index(print_, ":", -1), ";")


def paragraphs(parts: Column) -> Column:
    """The paragraphs of an array of sections."""
    return F.filter(F.flatten(F.transform(parts, lambda part: F.split(part, ","))), lambda own: own != "")


def leaves(own: Column) -> Column:
    """The leaves of an array of paragraphs."""
    return F.flatten(F.transform(own, lambda one: F.regexp_extract_all(one, F.lit(f".{{{SHOWN}}}"), F.lit(0))))


def added(left: Column, right: Column) -> Column:
    """The distinct leaves of ``left`` that ``right`` has not: only branches that differ are gone into."""

    def below(parts: Column) -> Column:
        theirs = paragraphs(sections(right))
        return let(theirs, lambda known: F.array_except(leaves(F.array_except(paragraphs(parts), known)), leaves(known)))

    none = F.array().cast("array<string>")
    return F.when(left == right, none).otherwise(let(F.array_except(sections(left), sections(right)), below))


def likeness(left: Column, right: Column) -> Column:
    """Twice the number of common distinct leaves over the numbers of both; 1 for equal roots."""

    def share(mine: Column, theirs: Column) -> Column:
        return F.lit(2) * (mine - F.size(added(left, right))) / (mine + theirs)

    def count(print_: Column) -> Column:
        return F.size(F.array_distinct(leaves(paragraphs(sections(print_)))))

    # Nested, as Spark keeps no order among the operands of a division.
    unlike = let(count(left), lambda mine: let(count(right), lambda theirs: share(mine, theirs)))
    return F.when(root(left) == root(right), F.lit(1.0)).otherwise(unlike)


def root(print_: Column) -> Column:
    return F.substring_index(print_, ":", 1)


def first_edit(left: Column, right: Column) -> Column:
    """(section, paragraph, leaf), from 0, of the first leaf of ``left`` that is not at the same place in ``right``; null
    for equal roots. Where ``left`` is a beginning of ``right``, its last section, paragraph and leaf, as far as equal."""
    place, mine, theirs = {}, sections(left), sections(right)
    for level, below in (("section", ","), ("paragraph", f"(?<=\\G.{{{SHOWN}}})"), ("leaf", None)):
        same = F.zip_with(mine, theirs, lambda a, b: F.coalesce(a == b, F.lit(False)))
        place[level] = F.least(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.size(mine).cast("bigint") - 1).cast("int")
        if below is not None:
            mine, theirs = (F.split(F.coalesce(F.get(side, place[level]), F.lit("")), below) for side in (mine, theirs))
    return F.when(root(left) != root(right), F.struct(*(number.alias(level) for level, number in place.items())))
