"""Mixing sources to target weights.

The documents of a source, in a fixed order, are one stream of words, packed into blocks of
``block_words``. The mix is a number of output shards with a fixed number of slots each.
Every shard draws how many of its slots go to each source from a multinomial with the
target shares; so that the totals meet the targets exactly, the few slots drawn beyond a
source's quota go to the sources that were drawn short. The i-th slot of a source reads
the block that a keyed pseudorandom permutation of the source's block numbers assigns to i
(again from the start for a further pass), so no block comes a third time before all have
come twice. Slots then join blocks by (source, block).

Sizes are sums over all documents. Only one number for each source reaches the driver
(the mixing recipe is per source); streams, blocks and slots stay on the executors. A hot
source is one of many (source, bucket) groups when sizes are summed, and its blocks are
keys of their own when joined. Joins with the numbers of sources send those numbers; no
other side is sent through the driver, whatever Spark estimates it at.

Defined cases: null and empty texts have size 0 and are taken 0 times; null sources are one
source, last in order; a null id is an id like others; repeated rows are documents each,
with their own place in the stream; an empty table gives no rows. Other columns are kept
out of the plan, so clashing names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripgate.llm.common import BROADCAST_BYTES, materialize, prefix_sums, root_buckets, ship, shuffled, word_count, words

BLOCK_WORDS = 256
SHARD_SLOTS = 1024
#: Slots that a task makes, about.
TASK_SLOTS = 1 << 18
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
SEED = 20240


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Shares of ``share`` x all words by weight; none above ``most`` x its size, the excess reshared by weight."""
    rest, out = share * sum(sizes), [0.0] * len(sizes)
    # sources reach their cap in the order of cap to weight, so one pass settles all
    order = sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i])
    left = float(sum(weights))
    for at, i in enumerate(order):
        if most * sizes[i] <= rest / left * weights[i]:
            out[i] = most * sizes[i]
            rest -= out[i]
            left -= weights[i]
        else:
            for j in order[at:]:
                out[j] = rest / left * weights[j]
            break
    return out


@dataclass
class Mix:
    """``documents``: every input row with size, source_size, target, source_no and start (its place in the source's stream).
    ``slots``: shard, slot, source_no, block, words (how many of the block, the last slot of a source may be cut)."""

    documents: DataFrame
    slots: DataFrame
    block_words: int

    def pieces(self) -> DataFrame:
        """The mix as (shard, slot, source_no, start, from_word, n_words) and the documents' columns: which words
        of which document fill each slot, in the order of ``from_word`` and ``start``."""
        size = self.block_words
        ends = F.floor((F.col("start") + F.col("size") - 1) / size)
        parts = (self.documents.where("size > 0")
                 .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / size), ends)))
                 .withColumn("_first", F.greatest(F.lit(0).cast("long"), F.col("block") * size - F.col("start")))
                 .withColumn("_last", F.least(F.col("size"), (F.col("block") + 1) * size - F.col("start"))))
        joined = parts.join(shuffled(self.slots), ["source_no", "block"])
        # a cut slot ends before the block does
        stop = F.least(F.col("_last"), F.col("block") * size + F.col("words") - F.col("start"))
        return (joined.withColumn("n_words", stop - F.col("_first")).where("n_words > 0")
                .withColumnRenamed("_first", "from_word").drop("_last", "words"))

    def taken(self) -> DataFrame:
        """``documents`` with ``taken``: the words that the mix takes, repeats counted."""
        sums = self.pieces().groupBy("source_no", "start").agg(F.sum("n_words").cast("long").alias("taken"))
        # documents of size 0 share the place of the next one, and take nothing
        return self.documents.join(
            shuffled(sums.withColumnRenamed("source_no", "_s").withColumnRenamed("start", "_t")),
            (F.col("source_no") == F.col("_s")) & (F.col("start") == F.col("_t")) & (F.col("size") > 0), "left",
        ).drop("_s", "_t").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))

    def texts(self) -> DataFrame:
        """The filled slots: shard, slot, n_words and the text, its words joined by single blanks.

        Needs the documents planned with ``keep=["text"]``. A slot has at most ``block_words`` words.
        """
        piece = F.array_join(F.slice(words(F.col("text")), (F.col("from_word") + 1).cast("int"), F.col("n_words").cast("int")), " ")
        rows = self.pieces().select("shard", "slot", "start", "n_words", piece.alias("piece"))
        return rows.groupBy("shard", "slot").agg(
            F.sum("n_words").alias("n_words"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "piece"))), lambda p: p["piece"]), " ").alias("text"))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed pseudorandom permutation of 0..size-1 for each row: a Feistel network on the next power of four, walked until inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.ones(len(index), dtype=bool)
    limit = np.maximum(size, 1).astype(np.uint64)
    with np.errstate(over="ignore"):
        while todo.any():
            left, right = out[todo] >> half[todo], out[todo] & mask[todo]
            for r in range(6):
                f = (right + key[todo] + np.uint64(r * 0x51ED27 + 1)) * np.uint64(0x9E3779B97F4A7C15)
                f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & mask[todo])
            out[todo] = left << half[todo] | right
            todo &= out >= limit
    return out.astype(np.int64)


def plan_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
             block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED, keep: list[str] = ()) -> Mix:
    """Plans the mix of all documents; ``weights`` repeat over the sources in code point order, null last.

    ``keep`` names further columns of ``docs`` that ``documents`` and ``pieces`` shall carry.
    """
    spark = docs.sparkSession
    ship(spark)
    kept = [c for c in keep if c not in ("doc_id", "source")]
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size"),
                        *[F.col(f"`{c}`").alias(f"_keep_{c}") for c in kept])
    if "text" not in kept:
        sized = materialize(sized, "mix-sizes")
    found = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("docs")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes, rows = [r["n"] for r in found], sum(r["docs"] for r in found)
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share, most)
    bytes_of_sources = sum(128 + 4 * len(r["source"] or "") for r in found)

    def of_sources(df: DataFrame) -> DataFrame:
        """``df``, which has a row for each source, marked for broadcast if the sources fit the bound."""
        return F.broadcast(df) if bytes_of_sources <= BROADCAST_BYTES else shuffled(df)

    # slots of each source: whole passes over its blocks, then as many blocks of one more pass as the rest needs
    blocks = [ceil(n / block_words) for n in sizes]
    want = [int(g + 0.5) for g in goals]
    passes = [w // n if n else 0 for w, n in zip(want, sizes, strict=True)]
    over = [w - p * n for w, p, n in zip(want, passes, sizes, strict=True)]
    quota = [p * b + ceil(o / block_words) for p, b, o in zip(passes, blocks, over, strict=True)]

    plan = spark.createDataFrame(
        [(i, r["source"], n, g, b, q, p, o) for i, (r, n, g, b, q, p, o) in enumerate(
            zip(found, sizes, goals, blocks, quota, passes, over, strict=True))],
        "source_no long, source string, source_size long, target double, n_blocks long, quota long, passes long, extra long")
    bucket = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(root_buckets(rows)))
    documents = (sized.join(of_sources(plan.select("source_no", F.col("source").alias("_source"), "source_size", "target")),
                            F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("_bucket", bucket))
    order = [F.xxhash64("doc_id", F.lit(seed + 1)), F.col("doc_id"), F.col("size"),
             *[F.col(f"_keep_{c}") for c in kept if docs.schema[c].dataType.simpleString() in ("int", "bigint", "string")]]
    documents = prefix_sums(documents, "source_no", "_bucket", order, "size", "start").drop("_bucket")
    for c in kept:
        documents = documents.withColumnRenamed(f"_keep_{c}", c)

    n_slots = sum(quota)
    shard_slots = max(shard_slots, len(found))
    shares = np.array(quota, dtype=float) / max(1, n_slots)

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for shard in b["id"]:
                slots = min(shard_slots, n_slots - shard * shard_slots)
                n = np.random.default_rng([seed, shard]).multinomial(slots, shares)
                at = np.flatnonzero(n)
                yield pd.DataFrame({"shard": shard, "source_no": at, "n": n[at], "first": np.cumsum(n)[at] - n[at]})

    shards = ceil(n_slots / shard_slots)
    draws = spark.range(shards).mapInPandas(drawn, "shard long, source_no long, n long, first long")
    draws = prefix_sums(draws.withColumn("_bucket", F.floor(F.col("shard") / root_buckets(shards))),
                        "source_no", "_bucket", [F.col("shard")], "n", "before").drop("_bucket")
    draws = materialize(draws, "mix-draws")

    # what was drawn beyond a quota goes, in order, to what was drawn short
    got = {r["source_no"]: r["n"] for r in draws.groupBy("source_no").agg(F.sum("n").alias("n")).collect()}
    gap = [q - got.get(i, 0) for i, q in enumerate(quota)]
    first_over = np.concatenate([[0], np.cumsum([max(0, -g) for g in gap])])
    first_short = np.concatenate([[0], np.cumsum([max(0, g) for g in gap])])
    balance = spark.createDataFrame(
        [(i, q, int(first_over[i]), int(first_short[i]), g) for i, (q, g) in enumerate(zip(quota, gap, strict=True))],
        "source_no long, quota long, over_at long, short_at long, gap long")
    short = (balance.where("gap > 0").select(F.col("source_no").alias("to_source"), F.col("quota"), "short_at", "gap")
             .withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("gap") - 1)))
             .select("to_source", (F.col("short_at") + F.col("k")).alias("moved"), (F.col("quota") - F.col("gap") + F.col("k")).alias("to_index")))
    # the counts are few bytes for many slots, so the work is dealt by slots
    dealt = draws.repartition(max(1, ceil(n_slots / TASK_SLOTS)), "shard")
    slots = (dealt.join(of_sources(balance.select("source_no", "quota", "over_at")), "source_no")
             .withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
             .select("shard", (F.col("first") + F.col("k")).alias("slot"), "source_no", (F.col("before") + F.col("k")).alias("index"), "quota", "over_at"))
    stay = slots.where("index < quota").select("shard", "slot", "source_no", "index")
    moved = (slots.where("index >= quota").select("shard", "slot", (F.col("over_at") + F.col("index") - F.col("quota")).alias("moved"))
             .join(shuffled(short), "moved").select("shard", "slot", F.col("to_source").alias("source_no"), F.col("to_index").alias("index")))
    slots = stay.unionByName(moved).join(of_sources(plan.select("source_no", "source_size", "n_blocks", "passes", "extra")), "source_no")

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, size = b["n_blocks"].to_numpy(), b["source_size"].to_numpy()
            turn, at = np.divmod(b["index"].to_numpy(), n)
            # the last block of a source may be short; it closes each pass, the full ones are permuted
            full = size // block_words
            key = (b["source_no"].to_numpy() * 1_000_003 + turn * 7919 + seed).astype(np.uint64)
            block = np.where(at < full, permuted(np.minimum(at, np.maximum(full - 1, 0)), full, key), at)
            whole = np.minimum(block_words, size - block * block_words)
            left = b["extra"].to_numpy() - at * block_words
            taken = np.where(turn < b["passes"].to_numpy(), whole, np.minimum(whole, left))
            yield pd.DataFrame({"shard": b["shard"], "slot": b["slot"], "source_no": b["source_no"], "block": block, "words": taken})

    slots = slots.mapInPandas(mapped, "shard long, slot long, source_no long, block long, words long")
    return Mix(documents, slots, block_words)
