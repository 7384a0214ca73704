"""Ranges as structs (lo, hi, lo_inc, hi_inc); a null bound is open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def make_range(lo: Column, hi: Column, bounds: str = "[]") -> Column:
    return F.struct(
        lo.alias("lo"),
        hi.alias("hi"),
        F.lit(bounds[0] == "[").alias("lo_inc"),
        F.lit(bounds[1] == "]").alias("hi_inc"),
    )


def is_empty(r: Column) -> Column:
    equal = (r["lo"] == r["hi"]) & ~(r["lo_inc"] & r["hi_inc"])
    return F.coalesce((r["lo"] > r["hi"]) | equal, F.lit(False))


def _starts_before_end(a: Column, b: Column) -> Column:
    touching = (a["lo"] == b["hi"]) & a["lo_inc"] & b["hi_inc"]
    return F.coalesce((a["lo"] < b["hi"]) | touching, F.lit(True))


def overlaps(a: Column, b: Column) -> Column:
    """The ranges share a point."""
    return _starts_before_end(a, b) & _starts_before_end(b, a) & ~is_empty(a) & ~is_empty(b)


def contains(r: Column, value: Column) -> Column:
    above = (value > r["lo"]) | ((value == r["lo"]) & r["lo_inc"])
    below = (value < r["hi"]) | ((value == r["hi"]) & r["hi_inc"])
    return F.coalesce(above, F.lit(True)) & F.coalesce(below, F.lit(True)) & value.isNotNull()


def around_highest(highest: Column, margin: int, default_hi: int) -> Column:
    """[highest - margin, highest + margin] cut at zero; [0, default_hi] when there is no reading."""
    known = make_range(F.greatest(F.lit(0), highest - margin), highest + margin)
    return F.when(highest.isNotNull(), known).otherwise(make_range(F.lit(0), F.lit(default_hi)))
