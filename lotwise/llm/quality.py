"""Quality classifier by Bradley-Terry pairwise ranking.

Every text gets a vector of surface features. A preference pair is a document marked 1 and one marked 0; logistic loss on
the difference of their features learns one weight per feature, so that the better document of a pair scores higher.
The cut is the quantile of the training documents' scores that their share of zeros calls for, and the score from 0 to 1
is the logistic curve through it: the cut is 0.3, as is the threshold of ``predicted``.

Training takes every labelled document. They are dealt by the hashes of their ids to blocks of about ``BLOCK``, and inside a
block each document marked 1 is compared with each marked 0; mean, scale, loss and cut are sums over all blocks. Null and empty texts have the features of an empty text and get a
score. Repeated rows repeat their score; further columns pass through, columns with the names of the outputs are
replaced. Without both labels there is nothing to rank and every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.batches import appended, range_hashes, runs, utf8_of, weighted
from lotwise.sources.workspace import scratch, stage

#: About so many documents are compared with each other, all marked 1 with all marked 0.
BLOCK = 2_048
#: Weight of the squared weights in the loss; passes over all blocks at most.
DAMPING, PASSES = 1e-4, 30
#: Ranks among scores are found on whole numbers with so many binary places, by so many bits a pass.
FRACTION, BIN_BITS = 36, 12
CUT = 0.3
LEVEL = np.log(CUT / (1 - CUT))
SIGNS = tuple(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
UPPER = np.isin(np.arange(256), np.arange(65, 91))
LOWER = np.isin(np.arange(256), np.arange(97, 123))
DIGIT = np.isin(np.arange(256), np.arange(48, 58))
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
SIGN = np.isin(np.arange(256), SIGNS)
HIGH = np.arange(256) >= 128
N_FEATURES = 2 * (len(SIGNS) + 14) + 4


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values over each text; every text has at least its closing newline."""
    return np.add.reduceat(values, first[:-1]).astype(np.float64)


def features(texts: list[str]) -> np.ndarray:
    """One row per text: shares of byte classes, words and lines, their square roots, and sizes."""
    if not texts:
        return np.zeros((0, N_FEATURES), np.float32)
    data, first = utf8_of(texts)
    size = np.maximum(np.diff(first) - 1, 1).astype(np.float64)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    table = np.bincount(owner * 256 + data, minlength=256 * len(texts)).reshape(len(texts), 256)
    shares = [table[:, sign] / size for sign in SIGNS]
    shares += [table[:, kind].sum(axis=1) / size for kind in (UPPER, LOWER, DIGIT, HIGH, SPACE, SIGN)]
    repeats = np.zeros(len(data), np.int64)
    repeats[1:] = (data[1:] == data[:-1]) & ~SPACE[data[1:]]
    shares.append(_per_text(repeats, first) / size)
    starts, ends = runs(~SPACE[data])
    of = np.searchsorted(first, starts, side="right") - 1
    words = np.maximum(np.bincount(of, minlength=len(texts)), 1).astype(np.float64)

    def share_of_words(which: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=which, minlength=len(texts)) / words

    shares.append(share_of_words(SIGN[data[ends - 1]]) if len(starts) else np.zeros(len(texts)))
    last_two = (ends - starts > 2) & SIGN[data[ends - 1]] & SIGN[data[np.maximum(ends - 2, 0)]]
    shares.append(share_of_words(last_two))
    shares.append(share_of_words(UPPER[data[starts]]))
    shares.append(share_of_words(ends - starts == 1))
    shares.append(share_of_words(ends - starts > 14))
    hashes = range_hashes(weighted(data), starts, ends)
    shares.append(1 - _distinct(of, hashes, len(texts)) / words)
    line_starts, line_ends = runs(data != 10)
    line_of = np.searchsorted(first, line_starts, side="right") - 1
    lines = np.maximum(np.bincount(line_of, minlength=len(texts)), 1).astype(np.float64)
    line_hashes = range_hashes(weighted(data), line_starts, line_ends)
    shares.append(1 - _distinct(line_of, line_hashes, len(texts)) / lines)
    shares = np.stack(shares, axis=1)
    sizes = np.stack([np.log1p(size), np.log1p(words), np.log1p(lines), size / words / 10], axis=1)
    return np.concatenate([shares, np.sqrt(np.maximum(shares, 0)), sizes], axis=1).astype(np.float32)


def _distinct(owner: np.ndarray, hashes: np.ndarray, count: int) -> np.ndarray:
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(owner[new], minlength=count)


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def table(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        # Not a matrix product: its last bits depend on the place of a row in the batch, and equal texts must score alike.
        return (self.table(rows) * self.weights).sum(axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.raw(rows) - self.cut) + LEVEL, -40, 40)))


Summed = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray]], np.ndarray]


def _moments(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Numbers of rows and of rows with label 1, sums of the features and of their squares."""
    rows = rows.astype(np.float64)
    return np.concatenate([[len(rows), (labels == 1).sum()], rows.sum(axis=0), (rows**2).sum(axis=0)])


def _pair_sums(table: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Over all pairs of a row marked 1 and one marked 0: their number, losses, slopes and (upper) curvature."""
    good, bad = table[labels == 1], table[labels == 0]
    margin = (good @ weights)[:, None] - (bad @ weights)[None, :]
    wrong = 1 / (1 + np.exp(np.clip(margin, -40, 40)))
    loss = np.logaddexp(0, -margin).sum()
    slope = bad.T @ wrong.sum(axis=0) - good.T @ wrong.sum(axis=1)
    bend = wrong * (1 - wrong)
    mixed = good.T @ bend @ bad
    curve = (good.T * bend.sum(axis=1)) @ good + (bad.T * bend.sum(axis=0)) @ bad - mixed - mixed.T
    return np.concatenate([[margin.size, loss], slope, curve[np.triu_indices(N_FEATURES)]])


def _fitted(summed: Summed) -> Ranker:
    """The ranker of rows that only show sums over their blocks: the lowest mean loss of the pairs by Newton's steps."""
    moments = summed(_moments)
    count, ones = (int(moments[0]), int(moments[1])) if len(moments) else (0, 0)
    if not count:
        return Ranker(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), LEVEL, 1.0)
    mean, square = moments[2 : 2 + N_FEATURES] / count, moments[2 + N_FEATURES :] / count
    scale = np.sqrt(np.maximum(square - mean**2, 0)) + 1e-3
    weights, last, best = np.zeros(N_FEATURES), np.zeros(N_FEATURES), np.inf
    ranker = Ranker(mean, scale, weights, LEVEL, 1.0)
    if ones in (0, count):
        return ranker
    for _ in range(PASSES):
        found = summed(lambda rows, labels: _pair_sums(ranker.table(rows), labels, weights))
        pairs, loss = found[0], found[1] / found[0] + DAMPING / 2 * weights @ weights
        if loss > best:  # the step went too far
            weights = (weights + last) / 2
            continue
        slope = found[2 : 2 + N_FEATURES] / pairs + DAMPING * weights
        curve = np.zeros((N_FEATURES, N_FEATURES))
        curve[np.triu_indices(N_FEATURES)] = found[2 + N_FEATURES :] / pairs
        curve = curve + np.triu(curve, 1).T + DAMPING * np.eye(N_FEATURES)
        step = np.linalg.solve(curve, slope)
        last, best, weights = weights, loss, weights - step
        if slope @ step < 1e-9:
            break
    else:
        weights = last
    ranker = Ranker(mean, scale, weights, LEVEL, 1.0)
    below, above = _at_ranks(summed, ranker, [count - ones - 1, count - ones])
    return Ranker(mean, scale, weights, (below + above) / 2, 1.0)


def _at_ranks(summed: Summed, ranker: Ranker, ranks: list[int]) -> list[float]:
    """The raw scores at these places in their order, found by counting in ever narrower bins of whole numbers."""
    reach = int(8 * np.abs(ranker.weights).sum() * 2**FRACTION) + 1
    shift = max((2 * reach).bit_length() - BIN_BITS, 0)
    lows, left = [-reach] * len(ranks), list(ranks)
    while True:

        def counted(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
            raw = np.rint(ranker.raw(rows) * 2**FRACTION).astype(np.int64)
            bins = [(raw - low) >> shift for low in lows]
            return np.concatenate([np.bincount(one[(one >= 0) & (one < 2**BIN_BITS)], minlength=2**BIN_BITS) for one in bins]).astype(np.float64)

        for i, counts in enumerate(np.rint(summed(counted)).astype(np.int64).reshape(len(ranks), -1)):
            upto = np.cumsum(counts)
            place = int(np.searchsorted(upto, left[i], side="right"))
            left[i] -= int(upto[place] - counts[place])
            lows[i] += place << shift
        if not shift:
            return [low / 2**FRACTION for low in lows]
        shift = max(shift - BIN_BITS, 0)


def fit(rows: np.ndarray, labels: np.ndarray) -> Ranker:
    """The ranker of rows at hand; ``trained`` fits the same to rows that stay where they are."""
    pieces = max(1, -(-len(rows) // BLOCK))
    dealt = np.random.default_rng(7).permutation(len(rows))
    blocks = [(rows[dealt[i::pieces]], labels[dealt[i::pieces]]) for i in range(pieces)]
    return _fitted(lambda compute: sum(compute(*block) for block in blocks))


def sampled(labelled: DataFrame, key: str, label: str, limit: int) -> DataFrame:
    """At most ``limit`` of the rows whose label is 0 or 1, each label apart: those with the smallest hashes of their ids."""
    picks = [labelled.where(F.col(label) == value).orderBy(F.xxhash64(key), key).limit(limit // 2) for value in (0, 1)]
    return picks[0].unionByName(picks[1])


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int | None = None) -> Ranker:
    """A ranker from all labelled documents; only sums over them come to the driver.

    With ``sample`` it is fitted on the driver to at most so many of them: those with the smallest hashes of their ids.
    """
    # An id with its text is one document, however many rows repeat it.
    marks = labels.where(F.col(label).isin(0, 1)).select(key, F.col(label).cast("int").alias("mark")).distinct()
    marked = docs.where(F.col(key).isNotNull()).select(key, F.xxhash64(text).alias("_own"), F.col(text).alias("features"))
    with scratch(docs.sparkSession):
        if sample is not None:
            picked = sampled(marked.select(key, "_own").join(marks, key).distinct(), key, "mark", sample).select(key, "_own").distinct()
            marked = marked.join(picked, [key, "_own"], "left_semi")
        rows = appended(marked, "features", lambda texts: {"features": [one.tobytes() for one in features(texts)]}, "features binary")
        rows = rows.groupBy(key, "_own").agg(F.first("features").alias("features")).join(marks, key)
        rows = stage(rows.select(F.xxhash64(key, "_own").alias("place"), "mark", "features"), "features")
        counts = {row["mark"]: row["count"] for row in rows.groupBy("mark").count().collect()}
        if sample is not None:
            return fit(*_read_block(rows.toArrow()))
        return _fitted(_sums_of(_blocks(rows, counts)))


def _read_block(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a block; the order of its rows must not matter."""
    place, mark = (table.column(name).to_numpy() for name in ("place", "mark"))
    rows = np.frombuffer(b"".join(table.column("features").to_pylist()), np.float32).reshape(-1, N_FEATURES)
    order = np.lexsort((mark, place))
    return rows[order], mark[order]


def _blocks(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """The rows dealt by their hashes to blocks of about ``BLOCK``, one block a row.

    Rows of a label so rare that blocks would be left without it are in several of them.
    """
    blocks = max(1, -(-sum(counts.values()) // BLOCK))
    copies = [min(blocks, max(1, -(-8 * blocks // max(counts.get(mark, 0), 1)))) for mark in (0, 1)]
    often = F.when(F.col("mark") == 0, copies[0]).otherwise(copies[1])
    dealt = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), often - 1)))
    dealt = dealt.withColumn("_block", F.pmod(F.col("place") + F.col("_copy"), F.lit(blocks)))

    def packed(table: pa.Table) -> pa.Table:
        rows, mark = _read_block(table)
        return pa.table({"rows": pa.array([rows.tobytes()], pa.binary()), "marks": pa.array([mark.astype(np.int8).tobytes()], pa.binary())})

    return stage(dealt.drop("_copy").groupBy("_block").applyInArrow(packed, "rows binary, marks binary"), "blocks")


def _sums_of(blocks: DataFrame) -> Summed:
    """Sums over the blocks, added in Spark as decimals, so that no order of blocks changes them."""

    def summed(compute: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, marks in zip(batch.column(0), batch.column(1)):
                    table = np.frombuffer(rows.as_buffer(), np.float32).reshape(-1, N_FEATURES)
                    sums = compute(table, np.frombuffer(marks.as_buffer(), np.int8))
                    yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64()))], names=["sums"])

        one = blocks.mapInArrow(each, "sums array<double>").select(F.posexplode("sums").alias("at", "value"))
        found = one.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,8)")).cast("double").alias("sum"))
        return np.array([row["sum"] for row in sorted(found.collect(), key=lambda row: row["at"])], np.float64)

    return summed


def scored(df: DataFrame, ranker: Ranker, text: str = "text") -> DataFrame:
    """``df`` with ``score`` and ``predicted``."""

    def compute(texts: list[str]) -> dict:
        score = ranker.score(features(texts))
        return {"score": score, "predicted": (score >= CUT).astype(np.int32)}

    return appended(df, text, compute, "score double, predicted int")
