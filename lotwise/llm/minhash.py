"""Near-duplicates by b-bit MinHash: bands propose pairs, packed low bits estimate, full sets confirm.

A document is the set of its distinct runs of five words (``A-Z`` lower-cased, words parted by ASCII white space); with
fewer words the whole sequence is its only element; without words it is empty and linked with nothing. Two documents are
linked at a Jaccard similarity of at least ``percent`` / 100, and a component is everything reachable by links.

1. Equal sets are one class, told apart by 128 bits; only its smallest id goes on.
2. Of 256 minima, band keys of five are made: 26 keys for a threshold of 0.85, 39 for 0.80. A pair at the threshold shares
   no key with a probability of at most 2.4e-7. Thresholds below 0.77 need more minima than there are and are refused.
3. The low four bits of all minima are packed into sixteen numbers. The share of equal lanes, corrected for chance
   collisions of 1/16, estimates the similarity; pairs 4.5 deviations below the threshold are dropped.
4. Pairs are not all pairs of a bucket. First every document meets the hub (smallest id) it shares most keys with, then
   the other hubs outside its component. What then still shares a bucket with another component is paired where two
   documents share one of their rarest shingles: of m shingles the rarest 15 % and one at most, fewer for larger partners;
   linked pairs cannot miss it. A sketch of 2,048 parities, which never overstates a difference, drops what is too unlike
   (sets of more shingles go by the estimate), so a family of texts that are nearly but not quite similar makes few pairs.
5. Each pair is confirmed on both whole sets, made again from the texts.

Null ids belong to no component. Rows that repeat an id are one document whose links are those of all its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.batches import chunks, mixed, range_hashes, rows_per_batch, runs, texts_of, utf8_of, weighted
from lotwise.llm.components import components
from lotwise.llm.members import with_listed
from lotwise.sources.workspace import scratch, stage

WIDTH = 5
ROWS, LANES, BITS = 5, 256, 4
#: At least so many bands, so much slack and so rare a miss by the bands, as a threshold of 0.85 calls for.
BANDS, SLACK, MISS = 26, 0.105, 2.4e-7
BATCH = 1_000  # rows sent to Python at once
BLOCK = 32_768  # elements hashed at once, so that they stay in the processor's cache
#: Bits of a sketch, and up to how many shingles a set gets one.
SKETCH, SKETCHED = 2_048, 2_048
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_random = np.random.default_rng(20_240_601)
FACTORS = _random.integers(0, 1 << 63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, LANES, dtype=np.uint64)
PLACES = _random.integers(0, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands_for(percent: int) -> int:
    """Bands of which a pair at the threshold shares one but for a probability of ``MISS``."""
    unlike = 1 - (percent / 100) ** ROWS
    bands = max(BANDS, math.ceil(math.log(MISS) / math.log(unlike))) if unlike > 0 else BANDS
    if percent > 100 or bands * ROWS > LANES:
        raise ValueError(f"a threshold of {percent} percent needs {bands * ROWS} minima; there are {LANES}, which reach from 77 to 100")
    return bands


def slack_for(percent: int) -> float:
    """Four and a half standard deviations of the estimate at the threshold, in thousandths."""
    chance = 1 / (1 << BITS)
    equal = chance + (1 - chance) * percent / 100
    return max(SLACK, math.ceil(4_500 * math.sqrt(equal * (1 - equal) / LANES) / (1 - chance)) / 1000)


def shingle_sets(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and the text each belongs to."""
    data, first = utf8_of(texts)
    data = FOLD[data]
    starts, ends = runs(~SPACE[data])
    words = range_hashes(weighted(data), starts, ends)
    owner = np.searchsorted(first, starts, side="right") - 1
    counts = np.bincount(owner, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(counts)])
    short = np.flatnonzero((counts > 0) & (counts < width))
    with np.errstate(over="ignore"):
        sums = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for place, factor in enumerate(PLACES[:width]):
            sums += words[place : place + len(sums)] * factor
        fits = np.flatnonzero(owner[: len(sums)] == owner[width - 1 :][: len(sums)])
        hashes, owners = mixed(sums[fits]), owner[fits]
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for place in range(width - 1):
                has = counts[short] > place
                whole[has] += words[begin[short[has]] + place] * PLACES[place]
            hashes = np.concatenate([hashes, mixed(whole ^ counts[short].astype(np.uint64))])
            owners = np.concatenate([owners, short])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], owners[new]


def minima(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The minimum of each permutation (row) over each set; ``begin`` has the start of each set, none is empty."""
    result = np.empty((len(FACTORS), len(begin)), np.uint32)
    ends = np.append(begin[1:], len(hashes))
    at = 0
    while at < len(begin):
        stop = max(at + 1, int(np.searchsorted(ends, begin[at] + BLOCK, side="right")))
        part = hashes[begin[at] : ends[stop - 1]]
        inner = begin[at:stop] - begin[at]
        with np.errstate(over="ignore"):
            for k, (factor, shift) in enumerate(zip(FACTORS, SHIFTS)):
                high = (part * factor + shift).view(np.uint32)[1::2]  # little-endian: the upper halves
                result[k, at:stop] = np.minimum.reduceat(high, inner)
        at = stop
    return result


def band_keys(low: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit key of each band (row) of each set, unlike for unlike bands."""
    keys = np.empty((bands, low.shape[1]), np.uint64)
    with np.errstate(over="ignore"):
        for band in range(bands):
            key = np.full(low.shape[1], band + 1, np.uint64)
            for row in low[band * ROWS : (band + 1) * ROWS]:
                key = mixed(key * PLACES[0] + row.astype(np.uint64))
            keys[band] = key
    return keys


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima: for each of the bits a plane of ``LANES`` / 64 numbers (rows) of each set."""
    planes = []
    for bit in range(BITS):
        lanes = (low >> np.uint32(bit) & np.uint32(1)).astype(np.uint64).reshape(LANES // 64, 64, -1)
        planes.append(np.bitwise_or.reduce(lanes << np.arange(64, dtype=np.uint64)[None, :, None], axis=1))
    return np.concatenate(planes)


def sketches(hashes: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """For each set (row) the parities of its elements dealt to ``SKETCH`` places, as numbers of 64 bits.

    An element in one of two sets changes one bit, so two sketches differ in at most as many bits as the sets in elements.
    """
    packed_ = np.empty((count, SKETCH // 64), np.uint64)
    places = (hashes >> np.uint64(64 - (SKETCH - 1).bit_length())).astype(np.int64)
    for at in range(0, count, 256):
        stop = min(count, at + 256)
        low, high = np.searchsorted(owner, [at, stop])
        odd = np.bincount((owner[low:high] - at) * SKETCH + places[low:high], minlength=(stop - at) * SKETCH) & 1
        packed_[at:stop] = np.packbits(odd.astype(np.uint8).reshape(stop - at, SKETCH), axis=1, bitorder="little").view(np.uint64)
    return packed_


FEATURES = "doc_id bigint, n_shingles bigint, high bigint, low bigint, bits array<bigint>, bands array<bigint>"


def features(df: DataFrame, key: str, text: str, n_bands: int = BANDS) -> DataFrame:
    """Set size, two hashes of the whole set, packed low bits and band keys of every document; null where it is empty."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, 1):
                texts = texts_of(piece.column(1))
                hashes, owner = shingle_sets(texts)
                sizes = np.bincount(owner, minlength=len(texts))
                full = np.flatnonzero(sizes)
                begin = np.concatenate([[0], np.cumsum(sizes[full])])[:-1]
                marks = np.zeros((2, len(texts)), np.uint64)
                bits = bands = None
                if len(full):
                    with np.errstate(over="ignore"):
                        marks[0, full] = np.add.reduceat(mixed(hashes ^ PLACES[1]), begin)
                        marks[1, full] = np.add.reduceat(mixed(hashes ^ PLACES[2]), begin)
                    low = minima(hashes, begin)
                    bits, bands = packed(low), band_keys(low, n_bands)
                columns = [piece.column(0), pa.array(sizes.astype(np.int64)), *(pa.array(m.view(np.int64)) for m in marks)]
                columns += [_lists(bits, full, len(texts)), _lists(bands, full, len(texts))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "high", "low", "bits", "bands"])

    return df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(each, FEATURES)


def _lists(values: np.ndarray | None, rows: np.ndarray, count: int) -> pa.Array:
    sizes = np.zeros(count, np.int32)
    flat = np.empty(0, np.int64)
    if values is not None:
        sizes[rows] = len(values)
        flat = np.ascontiguousarray(values.T).view(np.int64).ravel()
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))


def estimate(left: Column, right: Column) -> Column:
    """Jaccard similarity from packed low bits, corrected for lanes that are equal by chance."""
    words = LANES // 64
    different = F.lit(0)
    for i in range(words):
        unlike = left[i].bitwiseXOR(right[i])
        for plane in range(1, BITS):
            unlike = unlike.bitwiseOR(left[i + plane * words].bitwiseXOR(right[i + plane * words]))
        different = different + F.bit_count(unlike)
    chance = 1.0 / (1 << BITS)
    return (F.lit(1.0) - different / LANES - chance) / (1 - chance)


def may_be_near(left: Column, right: Column, total: Column, percent: int) -> Column:
    """False only for two sets, of ``total`` elements together, whose sketches differ in more bits than linked sets could."""
    unlike = F.lit(0)
    for i in range(SKETCH // 64):
        unlike = unlike + F.bit_count(left[i].bitwiseXOR(right[i]))
    return (F.size(left) == 0) | (F.size(right) == 0) | (unlike * (100 + percent) <= total * (100 - percent))


def confirmed(pairs: DataFrame, df: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, as a written table."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, 2):
                sets, owner = shingle_sets(texts_of(piece.column(2)))
                others, their = shingle_sets(texts_of(piece.column(3)))
                count = piece.num_rows
                every, of = np.concatenate([sets, others]), np.concatenate([owner, their])
                order = np.lexsort((every, of))
                every, of = every[order], of[order]
                both = np.bincount(of[1:][(every[1:] == every[:-1]) & (of[1:] == of[:-1])], minlength=count)
                total = np.bincount(owner, minlength=count) + np.bincount(their, minlength=count) - both
                yield piece.filter(pa.array((total > 0) & (100 * both >= percent * total))).select([0, 1])

    wanted = pairs.select("a").union(pairs.select("b")).distinct()
    texts = df.select(F.col(key).cast("bigint").alias("a"), F.col(text).cast("string").alias("left"))
    with scratch(df.sparkSession) as keep, rows_per_batch(df.sparkSession, BATCH):
        texts = stage(texts.join(wanted, "a"), "contested")
        others = texts.select(F.col("a").alias("b"), F.col("left").alias("right"))
        joined = pairs.join(texts, "a").join(others, "b").select("a", "b", "left", "right")
        return keep(stage(joined.mapInArrow(each, "a bigint, b bigint"), "confirmed"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; ``kept`` marks the smallest id of each component."""
    spark = df.sparkSession
    with scratch(spark) as keep:
        with rows_per_batch(spark, BATCH):
            made = stage(features(df, key, text, bands_for(percent)), "minhash")
        full = made.where("n_shingles > 0 AND doc_id IS NOT NULL")
        classes = full.groupBy("high", "low", "n_shingles").agg(F.min("doc_id").alias("class"))
        members = full.select("doc_id", "n_shingles", "high", "low").join(classes, ["high", "low", "n_shingles"]).select("doc_id", "class")
        members = stage(members, "classes")
        first = full.join(members.where("doc_id = class").select("doc_id").distinct(), "doc_id").drop("high", "low", "n_shingles")
        # An id on several rows may belong to several classes; its rows are linked through it.
        same = members.where("doc_id <> class").select(F.col("doc_id").alias("a"), F.col("class").alias("b"))
        found = components(same.unionByName(_links(first, df, key, text, percent)))
        found, sizes = keep(stage(found, "found")), keep(stage(made.select("doc_id", "n_shingles"), "sizes"))
    result = sizes.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _links(first: DataFrame, df: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    keyed = first.select("doc_id", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last")
    buckets = stage(keyed.join(hubs.select("key", "hub"), "key"), "buckets")
    first = stage(first.drop("bands"), "representatives")
    marks = first.select("doc_id", "bits")
    # All pairs below lie in buckets. Their texts are picked once; no step moves all texts.
    bucketed = stage(buckets.select("doc_id").distinct(), "bucketed")
    texts = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = with_listed(texts, "doc_id", bucketed).where("listed").drop("listed")
    texts = stage(texts.join(bucketed, "doc_id"), "texts")

    def alike(left: str, right: str) -> Column:
        return estimate(F.col(left), F.col(right)) >= percent / 100 - slack_for(percent)

    # Each document with the hub that it shares most keys with, then with the other hubs outside its component.
    met = buckets.where("doc_id <> hub").groupBy(F.col("doc_id").alias("a"), F.col("hub").alias("b")).agg(F.count("*").alias("shared"))
    left = marks.select(F.col("doc_id").alias("a"), F.col("bits").alias("left"))
    right = marks.select(F.col("doc_id").alias("b"), F.col("bits").alias("right"))
    met = stage(met.join(left, "a").join(right, "b").where(alike("left", "right")).select("a", "b", "shared").distinct(), "hubs")
    best = met.groupBy("a").agg(F.max(F.struct("shared", (-F.col("b")).alias("low"))).alias("best"))
    best = best.select("a", (-F.col("best.low")).alias("b"))
    links = confirmed(best, texts, "doc_id", "text", percent)
    place = stage(components(links), "components")
    rest = _across(met.select("a", "b"), place).join(best, ["a", "b"], "left_anti")
    links = links.unionByName(confirmed(rest, texts, "doc_id", "text", percent))

    # What still shares a bucket with another component: pairs that share one of their rarest shingles.
    place = stage(components(links), "components")
    placed = _placed(buckets.select("doc_id", "key"), "doc_id", place, "component")
    keys = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    open_ = placed.join(keys.select("key"), "key").select("doc_id", "component").distinct()
    open_ = stage(open_.join(marks, "doc_id"), "open")
    with scratch(df.sparkSession) as keep:
        rarest = keep(stage(_rarest(open_, texts, percent), "rarest"))
    rare = _partnered(rarest, percent)
    one, two = (rare.select(*(F.col(name).alias(name + side) for name in rare.columns)) for side in "12")
    sizes = (F.col("n1") <= F.col("reach2")) & (F.col("n2") <= F.col("reach1"))
    apart = (F.col("component1") != F.col("component2")) & (F.col("doc_id1") > F.col("doc_id2")) & sizes
    apart = apart & may_be_near(F.col("sketch1"), F.col("sketch2"), F.col("n1") + F.col("n2"), percent)
    # A pair that shares several of them is made at the first.
    again = F.arrays_overlap("before1", "before2")
    pairs = one.join(two, (F.col("hash1") == F.col("hash2")) & apart & alike("bits1", "bits2") & ~again)
    pairs = pairs.select(F.col("doc_id1").alias("a"), F.col("doc_id2").alias("b")).distinct()
    pairs = stage(pairs.join(met.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    return links.unionByName(confirmed(pairs, texts, "doc_id", "text", percent))


def _rarest(open_: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The open documents with their rarest shingles in ``prefix``: n - ceil(n * percent / 100) + 1 of n, of which a
    linked pair shares one. Shingles that no other open document has come first and need no entry.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, 1):
                hashes, owner = shingle_sets(texts_of(piece.column(1)))
                n = np.bincount(owner, minlength=piece.num_rows)
                # The sketch of a set stands beside its first shingle.
                short = np.flatnonzero((n > 0) & (n <= SKETCHED))
                beside = np.searchsorted(owner, short)
                sketch = _lists(sketches(hashes, owner, len(n))[short].T, beside, len(owner))
                columns = [piece.column(0).take(pa.array(owner)), pa.array(n[owner]), pa.array(hashes.view(np.int64)), sketch]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "hash", "sketch"])

    with rows_per_batch(texts.sparkSession, BATCH):
        rows = stage(texts.join(open_.select("doc_id"), "doc_id").mapInArrow(each, "doc_id bigint, n bigint, hash bigint, sketch array<bigint>"), "shingles")
    common = rows.groupBy("hash").agg(F.count("*").alias("often")).where("often > 1")
    order = Window.partitionBy("doc_id", "n").orderBy("often", "hash")
    shared = rows.drop("sketch").join(common, "hash").withColumn("place", F.row_number().over(order))
    shared = shared.withColumn("shared", F.count("*").over(Window.partitionBy("doc_id", "n")))
    bound = F.expr(f"n - CAST(ceil(n * {percent} / 100) AS BIGINT) + 1 - (n - shared)")
    prefix = F.transform(F.sort_array(F.collect_list(F.struct("place", "hash"))), lambda one: one["hash"])
    rarest = shared.where(F.col("place") <= bound).groupBy("doc_id", "n", "shared").agg(prefix.alias("prefix"))
    sketched = rows.where("size(sketch) > 0").select("doc_id", "n", "sketch")
    rarest = rarest.join(sketched, ["doc_id", "n"], "left").withColumn("sketch", F.coalesce("sketch", F.array().cast("array<bigint>")))
    return rarest.join(open_, "doc_id")


def _partnered(rarest: DataFrame, percent: int) -> DataFrame:
    """The entries of the prefixes that can have a partner, one a row: ``hash``, the entries ``before`` it, and ``reach``.

    Two linked documents of n and m shingles have at least (n + m) * p / (1 + p) in common, so the first that they share
    has at least so many, less one, behind it in both. An entry at rank r of n can thus only join a document of at most
    ``reach`` shingles, and an entry that no other of its hash can join is dropped: a document with enough shingles of its
    own, which come first, joins none of its size, however many others share the rest with it.
    """
    rows = rarest.select("*", F.posexplode("prefix").alias("at", "hash"))
    # Of n shingles, the unshared come first: so many less than ``shared`` stand behind.
    rows = rows.withColumn("reach", F.expr(f"(shared - at) * {100 + percent} DIV {percent} - n"))
    rows = rows.where(F.expr(f"100 * reach >= {percent} * n")).withColumn("before", F.expr("slice(prefix, 1, at)")).drop("prefix", "shared", "at")
    ends = rows.groupBy("hash").agg(F.min("n").alias("least"), F.max("reach").alias("furthest"), F.min("component").alias("x"), F.max("component").alias("y"))
    return rows.join(ends.where("x < y").drop("x", "y"), "hash").where("least <= reach AND furthest >= n").drop("least", "furthest")


def _placed(df: DataFrame, node: str, place: DataFrame, name: str) -> DataFrame:
    known = place.select(F.col("node").alias(node), F.col("component").alias(name))
    return df.join(known, node, "left").withColumn(name, F.coalesce(name, node))


def _across(pairs: DataFrame, place: DataFrame) -> DataFrame:
    """The pairs that lie in two components."""
    both = _placed(_placed(pairs, "a", place, "_a"), "b", place, "_b")
    return both.where("_a <> _b").select("a", "b")
