"""Text as column expressions: normalising, word sets, trigram similarity."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def words(*columns) -> Column:
    """Lower-cased words of the columns in order, repeats included, nulls skipped."""
    return F.regexp_extract_all(F.lower(F.concat_ws(" ", *[_col(item) for item in columns])), F.lit(WORD), 0)


def tokens(*columns) -> Column:
    """The set of words, as a full-text column without stemming and stop words."""
    return F.array_distinct(words(*columns))


def has_all(token_set: Column, terms: Sequence[str]) -> Column:
    result = F.lit(True)
    for term in terms:
        result = result & F.array_contains(token_set, term.lower())
    return result


def has_any(token_set: Column, terms: Sequence[str]) -> Column:
    return F.arrays_overlap(token_set, F.array(*[F.lit(term.lower()) for term in terms]))


def trigrams(value) -> Column:
    """The set of three-letter pieces of each lower-cased word, padded with two blanks before and one after."""

    def pieces(word: Column) -> Column:
        padded = F.concat(F.lit("  "), word, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.length(word) + 1), lambda at: F.substr(padded, at, F.lit(3)))

    return F.array_distinct(F.flatten(F.transform(words(value), pieces)))


def trigram_similarity(left, right) -> Column:
    """Shared pieces over all pieces, 0 when there are none."""

    # The list of one pair is a name for the two sets, so that each is made once per row.
    def of_pair(pair: Column) -> Column:
        shared = F.size(F.array_intersect(pair["a"], pair["b"]))
        together = F.size(pair["a"]) + F.size(pair["b"]) - shared
        return F.when(together == 0, 0.0).otherwise(shared.cast("double") / together)

    pairs = F.array(F.struct(trigrams(left).alias("a"), trigrams(right).alias("b")))
    return F.transform(pairs, of_pair)[0]


def named(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def term_counts(value) -> Column:
    """The words of a text with how often each occurs, by word: the sorted words are cut where the next one begins."""

    def counted(sorted_: Column) -> Column:
        size = F.size(sorted_)
        first = F.filter(F.sequence(F.lit(0), size - 1), lambda at: (at == 0) | (F.get(sorted_, at) != F.get(sorted_, at - 1)))
        return named(first, lambda starts: F.transform(starts, lambda at, i: F.struct(F.get(sorted_, at).alias("term"), (F.coalesce(F.get(starts, i + 1), size) - at).alias("tf"))))

    none = F.array().cast("array<struct<term:string,tf:int>>")
    return named(F.sort_array(words(value)), lambda sorted_: F.when(F.size(sorted_) > 0, counted(sorted_)).otherwise(none))


def one_space(value) -> Column:
    return F.regexp_replace(F.trim(_col(value)), " {2,}", " ")


def sentence_case(value) -> Column:
    text = _col(value)
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 2147483647)))


def header(value) -> Column:
    """Trimmed, single-spaced, first letter upper and the rest lower."""
    return sentence_case(one_space(value))


def vin(value) -> Column:
    return F.upper(F.trim(_col(value)))
