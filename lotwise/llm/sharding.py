"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size: a start and a step of its own make a
permutation. Shards take turns; each claims the first slot of its order that is still free (a shard of weight w claims w
slots a turn). Rows find their shard by the slot of their key's hash. Taking a shard away moves its rows and few others.

The table has one row per slot, a size set by a parameter and not by the data, so it is broadcast. Placement is a function
of the key alone: equal keys share a shard, a null key counts as a value of its own. Repeated rows, empty tables and
further columns need no care; columns named ``slot`` and ``shard`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def filled(shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> np.ndarray:
    """For every slot the position of its shard in ``shards``."""
    if slots < 2 or any(slots % n == 0 for n in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime, or an order of preference would not reach every slot")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must have names of their own, and there must be a slot for each")
    weights = [1] * len(shards) if weights is None else list(weights)
    if len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("each shard needs a weight of at least 1")
    table = np.full(slots, -1, np.int32)
    start = [_number(name, "start") % slots for name in shards]
    step = [_number(name, "step") % (slots - 1) + 1 for name in shards]
    left = slots
    while left:
        for shard, weight in enumerate(weights):
            for _ in range(min(weight, left)):
                while table[start[shard]] >= 0:
                    start[shard] = (start[shard] + step[shard]) % slots
                table[start[shard]] = shard
                left -= 1
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The first 60 bits of the key's MD5, modulo the number of slots; a null key hashes as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(slots))


def lookup(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> DataFrame:
    """The table as rows (slot, shard)."""
    table = filled(shards, slots, weights)
    names = pa.array(list(shards)).take(pa.array(table))
    return spark.createDataFrame(pa.table({"slot": np.arange(slots, dtype=np.int64), "shard": names}))


def placed(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> DataFrame:
    """``df`` with the ``slot`` and ``shard`` of every row."""
    rows = df.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), slots))
    table = lookup(df.sparkSession, shards, slots, weights)
    return rows.join(F.broadcast(table), "slot").select(*[c for c in rows.columns if c != "slot"], "slot", "shard")


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard; a shard too large for one task becomes several files."""
    df.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
