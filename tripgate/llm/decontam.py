"""Benchmark decontamination by SimHash windows of the items' sizes.

Shingles are five lower-cased words (with fewer words, the whole sequence), weighted by
how often they come in their window. A document is cut into windows as wide as the items are, and every
window meets all items of its width: windows and items have 64-bit SimHashes, and a multi-index of
four blocks of 16 bits finds all pairs within the radius. Of two fingerprints that differ in 19 bits or less, one block differs
in 4 bits at most, so each item is filed, block by block, under all 2,517 values within 4 bits of its own, and
each window asks for its four values. Candidates within the radius are verified by the exact
weighted Jaccard similarity of window and item.

Which windows are made follows from a bound. With the same number of shingles in each, the first of the best windows of an
item starts the text or ends at a shingle of the item (else the window one place before would be as good), and one that
reaches the similarity holds a least number of places whose shingle the item has. So windows
are made that end at a shared shingle, wherever that lies in the item, and hold enough of them; no
other start can give a better result for any item.

Only DataFrame functions run. Documents are read twice: once to find places, once, for the
few documents with places, to build the windows; shingles of all documents are never shuffled
while the benchmark's shingle table is within ``BROADCAST_BYTES`` (counted; beyond that
Spark shuffles both sides). Defined cases: null and empty texts and items match nothing;
items of fewer than five words match only documents that are those words; a text shorter than an item is one
window of its own width, which meets the items of up to 1 / similarity of it. Windows belong to a
text (its SHA-256), not to an id: equal texts are judged alike. Repeated ids give one
row for each item, with the best window of any of the texts, and so do null ids, as one id;
``contaminated_texts`` gives the texts themselves; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgate.llm.common import materialize, small, words

SHINGLE = 5
SIMILARITY = 0.8
BITS = 64
#: Weighted Jaccard 0.8 is a cosine of 0.89 or so, 9.5 of 64 bits on average; 3.5 standard deviations more.
RADIUS = 19
#: Blocks of a fingerprint. More than 16 bits each would file an item under too many values, fewer would tell too little apart.
BLOCKS = 4
BLOCK_BITS = BITS // BLOCKS


def shingles(text: Column) -> Column:
    """Hashes of each place's shingle, in order."""
    return F.transform(F.array(F.transform(words(F.lower(text.cast("string"))), lambda w: F.xxhash64(w))), lambda h: F.when(
        F.size(h) >= SHINGLE,
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - SHINGLE, F.lit(0))), lambda i: F.xxhash64(*[h[i + k] for k in range(SHINGLE)]))
    ).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")))[0]


#: Bits 0, 16, 32 and 48: four counters of 16 bits in a long.
_LANES = 1 << 48 | 1 << 32 | 1 << 16 | 1
#: Shingles whose votes four such counters hold, the highest in a signed long.
_LANE_VOTES = (1 << 15) - 1


def simhash(hashes: Column) -> Column:
    """64 votes over the shingles' bits; each occurrence votes, which weighs a shingle by its count."""
    def ones(some: Column, k: int) -> Column:
        lanes = F.aggregate(some, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LANES)))
        return F.array(*[F.shiftrightunsigned(lanes, 16 * j).bitwiseAND(F.lit(0xFFFF)) for j in range(4)])

    def counts(some: Column) -> Column:
        return F.flatten(F.array(*[ones(some, k) for k in range(16)]))

    none = F.array(*[F.lit(0).cast("long")] * BITS)
    starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(hashes), F.lit(1)) - 1) / _LANE_VOTES).cast("int"))
    votes = F.aggregate(starts, none, lambda t, i: F.zip_with(t, counts(F.slice(hashes, i * _LANE_VOTES + 1, F.lit(_LANE_VOTES))), lambda x, y: x + y))
    # counter 4 k + j is that of bit 16 j + k
    places = F.array(*[F.lit(16 * j + k) for k in range(16) for j in range(4)])
    bits = F.zip_with(votes, places, lambda v, place: F.call_function("shiftleft", (2 * v > F.size(hashes)).cast("long"), place))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two lists of hashes, weights being the counts: runs of one sorted list of both."""
    tagged = F.array_sort(F.concat(F.transform(a, lambda h: F.struct(h.alias("h"), F.lit(0).alias("of"))),
                                   F.transform(b, lambda h: F.struct(h.alias("h"), F.lit(1).alias("of")))))
    zero = F.lit(0)
    start = F.struct(F.lit(None).cast("long").alias("h"), zero.alias("a"), zero.alias("b"), zero.alias("both"))

    def run(s: Column, x: Column) -> Column:
        same = s["h"].eqNullSafe(x["h"])
        mine = lambda side, n: F.when(same, s[n]).otherwise(0) + (x["of"] == side).cast("int")
        return F.struct(x["h"].alias("h"), mine(0, "a").alias("a"), mine(1, "b").alias("b"),
                        (s["both"] + F.when(same, 0).otherwise(F.least(s["a"], s["b"]))).alias("both"))

    both = F.aggregate(tagged, start, run, lambda s: s["both"] + F.least(s["a"], s["b"])).cast("double")
    return F.transform(F.array(both), lambda n: n / (F.size(a) + F.size(b) - n))[0]


def _blocks(fingerprint: Column) -> list[Column]:
    return [F.shiftrightunsigned(fingerprint, BLOCK_BITS * n).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int") for n in range(BLOCKS)]


def _keys(fingerprint: Column) -> Column:
    """What a window asks for: its value of each block."""
    return F.array(*[F.struct(F.lit(n).alias("block"), v.alias("value")) for n, v in enumerate(_blocks(fingerprint))])


def _filed(items: DataFrame, radius: int) -> DataFrame:
    """``items`` under every value that a block within the radius can have: radius // blocks bits of one differ at most."""
    near = radius // BLOCKS
    masks = F.filter(F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1)), lambda m: F.bit_count(m) <= near)
    own = items.select("*", F.explode(_keys(F.col("item_print"))).alias("k"))
    return own.select("item_id", "item_print", "least", "most", F.col("k.block"), F.explode(F.transform(masks, lambda m: F.col("k.value").bitwiseXOR(m))).alias("value"))


def text_key(text: Column) -> Column:
    """What stands for a text in joins; null for null."""
    return F.unhex(F.sha2(text.cast("string").cast("binary"), 256))


def contamination(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, window_start, window_words): the best window of each pair that reaches ``least``.

    ``window_start`` counts words from 0; of equally similar windows the first counts.
    """
    best = _windows(docs, benchmark, least, radius).groupBy("doc_id", "item_id").agg(F.max(F.struct(
        "similarity", (-F.col("start")).alias("s"), F.size("window").alias("n"))).alias("b"))
    return best.select("doc_id", "item_id", "b.similarity", (-F.col("b.s")).alias("window_start"),
                       (F.col("b.n") + SHINGLE - 1).alias("window_words"))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(key): the ``text_key`` of each text that holds an item."""
    return _windows(docs, benchmark, least, radius).select("key").distinct()


def _windows(docs: DataFrame, benchmark: DataFrame, least: float, radius: int) -> DataFrame:
    """(doc_id, key, item_id, start, window, similarity) of the windows that reach ``least``."""
    items = benchmark.select("item_id", shingles(F.col("text")).alias("item")).where("size(item) > 0 and item_id is not null").withColumn("item_print", simhash(F.col("item")))
    items = materialize(items, "decontam-items")
    places = materialize(items.select("item_id", F.size("item").alias("n"), F.explode(F.array_distinct("item")).alias("h")), "decontam-index")
    size = places.count()
    found = (docs.select(text_key(F.col("text")).alias("key"), shingles(F.col("text")).alias("all")).where("size(all) > 0")
             .select("key", F.size("all").alias("m"), F.posexplode("all").alias("pos", "h")).join(small(places, size, 40), "h"))
    # a text with fewer shingles than the item is one window
    width = F.least("n", "m")
    need = F.greatest(F.lit(1), F.ceil(F.lit(least) * (F.col("n") + width) / F.lit(1 + least) - 1e-9).cast("int"))
    shared = found.groupBy("key", "item_id", "n", "m").agg(F.array_sort(F.collect_set("pos")).alias("at")).where(F.size("at") >= need)
    ends = F.filter("at", lambda p, i: F.get(F.col("at"), i - need + 1) > p - width)
    # a window belongs to its width, not to the item that asked for it
    starts = shared.select("key", width.alias("width"), (F.col("n") >= F.col("m")).alias("whole"), F.explode(F.array_distinct(
        F.transform(ends, lambda p: F.greatest(F.lit(0), p - width + 1)))).alias("start")).distinct()
    starts = materialize(starts, "decontam-places")
    count = starts.count()
    keys = starts.select("key").distinct()
    touched = docs.select("doc_id", "text", text_key(F.col("text")).alias("key")).join(small(keys, count, 48), "key", "left_semi")
    windows = (touched.select("doc_id", "key", shingles(F.col("text")).alias("all")).join(starts, "key")
               .select("doc_id", "key", "whole", "start", "width", F.slice("all", F.col("start") + 1, F.col("width")).alias("window")))
    windows = materialize(windows.withColumns({"print": simhash(F.col("window")), "w": F.monotonically_increasing_id()}), "decontam-windows")
    asked = windows.select("w", "print", "width", "whole", F.explode(_keys(F.col("print"))).alias("k")).select("w", "print", "width", "whole", "k.block", "k.value")
    probes = small(asked, BLOCKS * windows.count(), 64)
    # an item is met by windows of its own width, and by texts that are shorter as a whole
    reach = items.withColumns({"most": F.size("item"), "least": F.ceil(F.size("item") * least - 1e-9).cast("int")})
    filed = _filed(reach, radius).hint("merge")  # Spark takes it for as small as the items; it only yields to probes that are broadcast
    difference = F.col("print").bitwiseXOR(F.col("item_print"))
    near = (filed.join(probes, ["block", "value"])
            .where((F.col("width") == F.col("most")) | (F.col("whole") & F.col("width").between(F.col("least"), F.col("most"))))
            .where(F.bit_count(difference) <= radius)
            # of the blocks that agree so far only the first reports the pair
            .where(_first_block(difference, radius) == F.col("block")))
    near = materialize(near.select("w", "item_id", "item_print"), "decontam-candidates")
    met = near.join(windows.select("w", "doc_id", "key", "start", "window"), "w").join(items.select("item_id", "item", "item_print"), ["item_id", "item_print"])
    return met.withColumn("similarity", similarity(F.col("window"), F.col("item"))).where(F.col("similarity") >= least)


def _first_block(difference: Column, radius: int) -> Column:
    out = F.lit(None).cast("int")
    for n, value in reversed(list(enumerate(_blocks(difference)))):
        out = F.when(F.bit_count(value) <= radius // BLOCKS, n).otherwise(out)
    return out
