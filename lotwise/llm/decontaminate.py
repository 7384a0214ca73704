"""Benchmark decontamination by SimHash over item-sized windows, in DataFrame functions only.

Words are runs of letters and digits, lower-cased; a text is the sequence of its hashed runs of five words, or with fewer
words one hash of them all. A window of an item's size is as many shingles in a row as the item has (the whole text, if
it has fewer). The similarity of window and item is the weighted Jaccard of their shingles, the weight of a shingle
being how often it occurs: sum of the smaller over sum of the larger weights.

1. Screening, which loses nothing: a window that similar contains shingles of at least that share of the item's weight, so
   one of the item's rarest shingles that weigh more than the rest of it. Documents that have one meet the item; those
   that hold too little of it anywhere drop out; the others keep where its shingles stand.
2. Windows begin at shared shingles: moved on to the next of them, a window loses none and may gain some. A window that
   gains none over the one that begins a shared shingle earlier is left out, as it holds a part of what that one holds,
   and so is one with too few places of shared shingles. So the best window of all is among them.
3. Windows and items get 64-bit SimHash fingerprints, each bit the sign of a sum weighted by occurrence.
4. Fingerprints are cut into eight blocks of eight bits. Within a Hamming radius of 24 some block differs in at most
   three bits, so items are listed under all values that near of each block, and windows look up their own eight.
5. Candidates within the radius are confirmed by the exact similarity.

Null and empty texts match nothing, on either side. Repeated documents repeat in the result only once per id and item;
null ids keep a row of their own; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.sources.workspace import stage

WIDTH, THRESHOLD, RADIUS = 5, 0.8, 24
BLOCKS, BLOCK_BITS = 8, 8
#: Distinct benchmark shingles that are broadcast at most; beyond it the screening join is an ordinary one.
BROADCAST = 500_000
NEAR = sorted(sum(1 << bit for bit in bits) for size in range(RADIUS // BLOCKS + 1) for bits in combinations(range(BLOCK_BITS), size))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def with_shingles(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the hashes of the text's shingles in order, instead of the text."""
    split = df.withColumn("_words", words(F.col(text))).drop(text)
    last = F.size("_words") - WIDTH
    whole = F.when(F.size("_words") > 0, F.array(F.xxhash64("_words"))).otherwise(F.array().cast("array<bigint>"))
    rows = F.transform(F.sequence(F.lit(0), last), lambda at: F.xxhash64(*(F.get("_words", at + place) for place in range(WIDTH))))
    return split.withColumn(name, F.when(last >= 0, rows).otherwise(whole)).drop("_words")


def fingerprint(shingles: Column) -> Column:
    """The 64 signs of sums over the shingles: +1 where a hash has the bit, -1 where it has not."""

    def sign(bit: Column) -> Column:
        total = F.aggregate(shingles, F.lit(0), lambda total, hash_: total + F.getbit(hash_, bit).cast("int"))
        return F.when(total * 2 > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).otherwise(F.lit(0).cast("bigint"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), lambda bits, bit: bits.bitwiseOR(sign(bit)))


def similarity(left: Column, right: Column) -> Column:
    """Weighted Jaccard of two sequences of hashes."""

    def often(hashes: Column, wanted: Column) -> Column:
        return F.size(F.filter(hashes, lambda hash_: hash_ == wanted))

    smaller = F.aggregate(F.array_distinct(left), F.lit(0), lambda total, hash_: total + F.least(often(left, hash_), often(right, hash_)))
    return smaller / (F.size(left) + F.size(right) - smaller)


def block_keys(bits: Column) -> Column:
    return F.array(*(F.struct(F.lit(block).alias("block"), F.shiftrightunsigned(bits, block * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("value")) for block in range(BLOCKS)))


def contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", threshold: float = THRESHOLD, own: str | None = None
) -> DataFrame:
    """(key, item, start, similarity): the best window of every document for every item that it contains.

    ``start`` is the place of the window's first shingle, which is that of its first word; a window that begins where the
    document has no shingle of the item is never better, so the first shingle is one of the item's wherever the text goes on
    for the item's length. With ``own``, rows that repeat an id are told apart by that further column, xxhash64 of the text.
    """
    tests = with_shingles(items.select(F.col(item).alias("item"), F.col(text).alias("text")), "text", "shingles")
    tests = stage(tests.where(F.size("shingles") > 0).distinct().withColumn("size", F.size("shingles")), "items")
    # By shingle: the items that have it, and how much of the item it is.
    listed = tests.select("item", "size", F.explode("shingles").alias("hash")).groupBy("hash", "item", "size").agg(F.count("*").alias("weight"))
    wanted = listed.select("hash").distinct()
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST else wanted

    # An id in a struct joins also where it is null; the hash of the text keeps repeats of an id apart.
    plain = docs.select(F.struct(F.col(key).alias("id"), F.xxhash64(text).alias("own")).alias("doc"), F.col(text).alias("text"))
    # The outer form: for the other, Spark infers a filter on the array's size that computes it anew for every element.
    spread = with_shingles(plain, "text", "shingles").select("doc", F.posexplode_outer("shingles").alias("at", "hash"))
    shared = stage(spread.join(wanted, "hash"), "shared")
    present = shared.select("doc", "hash").distinct()
    # A document that holds an item has one of the item's rarest shingles, all but as many as it may lack.
    often = present.groupBy("hash").agg(F.count("*").alias("often"))
    rarest = Window.partitionBy("item", "size").orderBy("often", "hash").rowsBetween(Window.unboundedPreceding, -1)
    rare = listed.join(often, "hash", "left").withColumn("often", F.coalesce("often", F.lit(0))).withColumn("before", F.coalesce(F.sum("weight").over(rarest), F.lit(0)))
    rare = rare.where(F.col("before") <= (1 - F.lit(threshold)) * F.col("size")).select("hash", "item", "size")
    met = present.join(rare, "hash").select("doc", "item", "size").distinct()
    # Screening: the item's weight that the document holds somewhere.
    held = met.join(listed, ["item", "size"]).join(present, ["doc", "hash"])
    has = held.groupBy("doc", "item", "size").agg(F.sum("weight").alias("weight")).where(F.col("weight") >= F.lit(threshold) * F.col("size"))
    has = has.select("doc", "item", "size")
    places = has.join(listed, ["item", "size"]).join(shared, ["doc", "hash"]).select("doc", "item", "size", "at")
    starts = _starts(places, threshold).groupBy("doc").agg(F.collect_list(F.struct("size", "start")).alias("places"))
    starts = stage(starts, "starts")

    held = with_shingles(plain.join(starts, "doc"), "text", "shingles").select("doc", "shingles", F.explode("places").alias("place"))
    size, last = F.col("place.size"), F.size("shingles") - F.col("place.size")
    start = F.greatest(F.least(F.col("place.start").cast("int"), last), F.lit(0))
    windows = held.select("doc", size.alias("size"), start.alias("start"), F.slice("shingles", start + 1, size).alias("window")).distinct()
    windows = stage(windows.withColumn("print", fingerprint(F.col("window"))), "windows")

    near = F.array(*map(F.lit, NEAR))
    index = tests.withColumn("item_print", fingerprint(F.col("shingles"))).withColumn("entry", F.explode(block_keys(F.col("item_print"))))
    index = index.withColumn("flip", F.explode(near)).select("item", "size", "item_print", F.col("entry.block").alias("block"), F.col("entry.value").bitwiseXOR(F.col("flip")).alias("value"))
    probes = windows.select("doc", "size", "start", "print", F.explode(block_keys(F.col("print"))).alias("entry")).select("*", "entry.block", "entry.value").drop("entry")
    close = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS
    pairs = probes.join(index, ["size", "block", "value"]).where(close).select("doc", "size", "start", "item").distinct()
    pairs = pairs.join(windows.select("doc", "size", "start", "window"), ["doc", "size", "start"])
    pairs = pairs.join(tests.select("item", "shingles"), "item").withColumn("similarity", similarity(F.col("window"), F.col("shingles")))
    of = ["doc.id", "item"] if own is None else ["doc.id", "doc.own", "item"]
    best = pairs.where(F.col("similarity") >= threshold).groupBy(*of).agg(F.max(F.struct("similarity", (-F.col("start")).alias("low"))).alias("best"))
    shown = [F.col("id").alias(key), F.col("item").alias(item), (-F.col("best.low")).alias("start"), F.col("best.similarity").alias("similarity")]
    return best.select(*shown) if own is None else best.select(*shown, F.col("own").alias(own))


def _starts(places: DataFrame, threshold: float) -> DataFrame:
    """(doc, size, start) of the windows to look at, from the places ``at`` of the item's shingles in the document."""
    group = "doc", "item", "size"
    begin = places.select(*group, F.col("at").cast("bigint").alias("x"), F.lit(0).alias("end"))
    ends = begin.unionByName(places.select(*group, (F.col("at") + F.col("size") - 1).cast("bigint").alias("x"), F.lit(1).alias("end")))
    so_far = Window.partitionBy(*group).orderBy("x", "end").rowsBetween(Window.unboundedPreceding, 0)
    reach = ends.withColumn("reach", F.sum(1 - F.col("end")).over(so_far)).where("end = 1").withColumn("start", F.expr("x - size + 1"))
    order = Window.partitionBy(*group).orderBy("start")
    reach = reach.withColumns({"before": F.lag("reach").over(order), "earlier": F.row_number().over(order) - 1})
    enough = F.col("reach") - F.col("earlier") >= F.lit(threshold) * F.col("size")
    gains = F.col("before").isNull() | (F.col("reach") > F.col("before"))
    return reach.where(enough & gains).select("doc", "size", "start").distinct()
