"""Rows whose key is probably in a list: told by bitmaps small enough for every task, so that no other row is moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap of Spark's, bits spent on a key, and bitmaps at most: 16 MB. Beyond, more rows are taken for listed.
BITMAP, BITS_A_KEY, BITMAPS = 32_768, 16, 4_096


def with_listed(df: DataFrame, key: str, keys: DataFrame, name: str = "listed") -> DataFrame:
    """``df`` with a column that is true where its key is among the ``keys`` (one column), and at few other rows.

    Each key sets one bit, found by its hash. A join with the rows marked true gives the exact answer; those marked false
    have no part in it, so they need not be shuffled.
    """
    (own,) = keys.columns
    maps = min(BITMAPS, max(1, -(-keys.count() * BITS_A_KEY // BITMAP)))
    bits = keys.groupBy(_map(F.col(own), maps).alias("_map")).agg(F.bitmap_construct_agg(_place(F.col(own))).alias("_bits"))
    # Of the byte that has the bit, eight bits in hexadecimal; without a bitmap no key of its part is listed.
    place = _place(F.col(key))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    found = F.coalesce(F.expr("shiftright(_byte, _bit) & 1") == 1, F.lit(False))
    joined = df.withColumn("_map", _map(F.col(key), maps)).join(F.broadcast(bits), "_map", "left")
    joined = joined.withColumn("_byte", byte).withColumn("_bit", place.bitwiseAND(F.lit(7)).cast("int"))
    return joined.withColumn(name, found).drop("_map", "_bits", "_byte", "_bit")


def _map(key: Column, maps: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(maps)).cast("int")


def _place(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 40).bitwiseAND(F.lit(BITMAP - 1))
