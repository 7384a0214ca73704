"""Whole texts inside tasks: Arrow batches cut into bounded chunks, words found and hashed with numpy.

A chunk holds as many whole texts as fit into ``CHUNK_BYTES``; a longer text is a chunk of its own, so the memory of a
task follows the longest text, never the table. Null texts count as empty.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

CHUNK_BYTES = 250_000
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses modulo 2**64
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def appended(df: DataFrame, text: str, compute: Callable[[list[str]], dict], schema: str) -> DataFrame:
    """``df`` with the columns that ``compute`` makes of the texts; columns of ``df`` with such names are replaced."""
    new = StructType.fromDDL(schema)
    names = {field.name.lower() for field in new}
    kept = df.select(*[quoted(name) for name in df.columns if name.lower() not in names or name == text])
    source = kept.columns.index(text)
    shown = [i for i, name in enumerate(kept.columns) if name.lower() not in names]
    out = [kept.columns[i] for i in shown] + new.names
    types = [to_arrow_type(field.dataType) for field in new]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, source):
                made = compute(texts_of(piece.column(source)))
                arrays = [piece.column(i) for i in shown]
                arrays += [pa.array(made[name], type=kind) for name, kind in zip(out[len(shown) :], types)]
                yield pa.RecordBatch.from_arrays(arrays, names=out)

    result = StructType([kept.schema.fields[i] for i in shown] + new.fields)
    return kept.mapInArrow(each, result)


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int):
    """While it lasts, Arrow batches hold at most so many rows: for steps that send several texts in a row."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def chunks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with at most ``CHUNK_BYTES`` of text each, a longer text alone."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > CHUNK_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    yield batch.slice(start)


def texts_of(column: pa.Array) -> list[str]:
    try:
        return [text or "" for text in column.to_pylist()]
    except UnicodeDecodeError:
        return [(item or b"").decode("utf-8", "replace") for item in column.cast(pa.binary()).to_pylist()]


def utf8_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each followed by a newline, and where each text starts (one entry more at the end)."""
    parts = [text.encode("utf-8", "surrogatepass") for text in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    return data, _starts(map(len, parts), len(parts))


def points_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, each followed by a newline, and where each text starts."""
    data = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return data, _starts(map(len, texts), len(texts))


def _starts(lengths, count: int) -> np.ndarray:
    return np.fromiter(itertools.accumulate(lengths, lambda at, size: at + size + 1, initial=0), np.int64, count + 1)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; the last value must be false."""
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    return edges[0::2], edges[1::2]


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < size:
            with np.errstate(over="ignore"):
                cls.up = np.cumprod(np.r_[np.uint64(1), np.full(size, BASE)], dtype=np.uint64)
                cls.down = np.cumprod(np.r_[np.uint64(1), np.full(size, BASE_INVERSE)], dtype=np.uint64)
        return cls.up, cls.down


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def weighted(symbols: np.ndarray) -> np.ndarray:
    """Running sums of symbol times power of the base, with a leading zero: the hashes of all ranges are differences."""
    up, _ = _Powers.get(len(symbols) + 1)
    with np.errstate(over="ignore"):
        values = (symbols.astype(np.uint64) + np.uint64(1)) * up[: len(symbols)]
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ranges; equal symbols give equal hashes wherever they stand."""
    _, down = _Powers.get(len(sums))
    with np.errstate(over="ignore"):
        return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * BASE)


@cache
def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), np.bool_, 0x110000)


def letter_words(texts: list[str]):
    """Runs of letters, lower-cased: code points, starts, ends, number of the text, hash."""
    points, first = points_of([text.replace("Σ", "σ").lower() for text in texts])
    starts, ends = runs(letters()[points])
    owner = np.searchsorted(first, starts, side="right") - 1
    return points, starts, ends, owner, range_hashes(weighted(points), starts, ends)
