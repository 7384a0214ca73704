"""Containment of JSON documents kept as variants."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains(value: Column, pattern) -> Column:
    """Does a variant hold ``pattern``, a JSON value in Python's types?

    An object holds another if it has each of its keys with a value that holds the other's; an array holds another if each
    of the other's elements is held by some element, whatever their order and number; numbers are equal by value; all else
    is equal. As a whole document, an array also holds a single string, number or boolean among its elements. Null (no
    document) holds nothing; JSON null holds itself.
    """
    found = _holds(value, pattern)
    if isinstance(pattern, (str, int, float, Decimal)):
        found = found | _some(value, pattern)
    return found


def _kind(value: Column, *names: str) -> Column:
    kind = F.schema_of_variant(value)
    test = F.lit(False)
    for name in names:
        test = test | kind.startswith(name)
    return F.coalesce(test, F.lit(False))


def _some(value: Column, pattern) -> Column:
    """Is the value an array of which some element holds the pattern?"""
    elements = F.when(_kind(value, "ARRAY"), F.try_variant_get(value, "$", "array<variant>"))
    return F.coalesce(F.exists(elements, lambda one: _holds(one, pattern)), F.lit(False))


def _holds(value: Column, pattern) -> Column:
    if isinstance(pattern, dict):
        found = _kind(value, "OBJECT")
        for key, inner in pattern.items():
            if '"' in key or "\\" in key:
                raise ValueError(f"a path cannot name the key {key!r}")
            found = found & _holds(F.try_variant_get(value, f'$["{key}"]', "variant"), inner)
        return found
    if isinstance(pattern, (list, tuple)):
        found = _kind(value, "ARRAY")
        for inner in pattern:
            found = found & _some(value, inner)
        return found
    if pattern is None:
        return F.coalesce(F.is_variant_null(value), F.lit(False))
    if isinstance(pattern, bool):
        kinds, of, same = ("BOOLEAN",), "boolean", F.lit(pattern)
    elif isinstance(pattern, str):
        kinds, of, same = ("STRING",), "string", F.lit(pattern)
    elif isinstance(pattern, float):
        kinds, of, same = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "double", F.lit(pattern)
    else:
        kinds, of, same = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "decimal(38,9)", F.lit(Decimal(pattern)).cast("decimal(38,9)")
    return _kind(value, *kinds) & F.coalesce(F.try_variant_get(value, "$", of) == same, F.lit(False))
