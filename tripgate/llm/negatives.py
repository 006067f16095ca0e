"""Hard negatives by exact integer scores from a residue number system.

Vectors become integers, and a score is the inner product of a row with an anchor. Matrices of components are
multiplied modulo several small primes in float32: residues lie around zero and the depth of a product is bounded, so
every sum stays below 2^24 and float32 holds it exactly. Chinese remaindering (Garner's mixed radix) puts the exact
signed score together again. There are as many primes as twice the largest squared norm needs, which bounds every
score by Cauchy and Schwarz.

Anchors are a stated query set against all rows, in blocks: a block of anchors (``BLOCK_BYTES`` at most) is sent to
the executors and every task streams its rows past it, keeping only the best few of each anchor. Two passes:
first the positives of each anchor (rows of its label), then, within the window of scores that each positive allows,
the negatives (rows of other labels). Spark windows over (anchor) and (anchor, positive) choose among the tasks'
few; no rows are shuffled, and no label is ever one task's.

Order: higher scores first, then smaller ids (null ids last), then the row as numbered when it was read. Defined
cases: rows with a null label, null vector, null or non-finite component take no part; vectors of other lengths have
no score with an anchor; a row that repeats another, id included, is another row; an empty vector scores 0 with other
empty ones; components beyond +-``LIMIT`` after scaling are held there; columns other than those named aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgate.llm.common import materialize, ship

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
LIMIT = 1 << 20
BLOCK_BYTES = 8 << 20
#: Scores that are held at once.
TILE = 1 << 20
_NONE = np.iinfo(np.int64).min

#: Half the range of a residue, and the depth at which sums of products still fit float32's 24 bits.
_LARGEST_PRIME = 1024
DEPTH = (1 << 24) // (_LARGEST_PRIME // 2) ** 2


def primes_for(bound: int) -> list[int]:
    """The largest primes below 1,024 whose product exceeds twice ``bound``, two at least."""
    chosen, product, n = [], 1, _LARGEST_PRIME
    while len(chosen) < 2 or product <= 2 * bound:
        n -= 1
        if all(n % q for q in range(2, int(n ** 0.5) + 1)):
            chosen.append(n)
            product *= n
    return chosen


def residues(x: np.ndarray, p: int) -> np.ndarray:
    half = p // 2
    return ((x + half) % p - half).astype(np.float32)


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products [rows of a, rows of b] from the residues of both sides."""
    total, radix = None, 1
    for x, y, p in zip(a, b, primes, strict=True):
        r = np.zeros((x.shape[0], y.shape[0]), np.int32)
        for at in range(0, x.shape[1], DEPTH):
            r = (r + (x[:, at:at + DEPTH] @ y[:, at:at + DEPTH].T).astype(np.int32)) % p
        if total is None:
            total = r.astype(np.int64)
        else:
            total += radix * ((r - total) % p * pow(radix, -1, p) % p)
        radix *= p
    return np.where(total > radix // 2, total - radix, total)


class Best:
    """The best ``k`` rows met so far for each of ``n`` searches."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), _NONE)
        self.id = np.zeros((n, k), np.int64)
        self.no_id = np.zeros((n, k), bool)
        self.row = np.zeros((n, k), np.int64)

    def take(self, at: np.ndarray, s: np.ndarray, ids: np.ndarray, no_id: np.ndarray, rows: np.ndarray) -> None:
        """``s`` [searches ``at``, rows in order of id]: scores, ``_NONE`` where a row is out of question. Overwritten."""
        k = self.score.shape[1]
        lines = np.arange(len(at))
        best = [self.score[at], self.no_id[at], self.id[at], self.row[at]]
        for _ in range(min(k, s.shape[1])):
            j = s.argmax(axis=1)  # the first of equals
            new = [s[lines, j], no_id[j], ids[j], rows[j]]
            if (new[0] == _NONE).all():
                break
            best = [np.column_stack([x, y]) for x, y in zip(best, new, strict=True)]
            s[lines, j] = _NONE
        order = np.lexsort((best[3], best[2], best[1], -np.maximum(best[0], _NONE + 1)), axis=1)[:, :k]
        self.score[at], self.no_id[at], self.id[at], self.row[at] = (np.take_along_axis(x, order, 1) for x in best)

    def batch(self, anchor: np.ndarray, slot: np.ndarray) -> pa.RecordBatch:
        n, k = np.nonzero(self.score > _NONE)
        return pa.record_batch({"anchor": anchor[n], "slot": slot[n], "score": self.score[n, k],
                                "id": pa.array(self.id[n, k], mask=self.no_id[n, k]), "row": self.row[n, k]})


class Block:
    """Anchors of all lengths, ready to be multiplied."""

    def __init__(self, table: pa.Table, primes: list[int]):
        self.primes = primes
        self.row = table["_row"].to_numpy().astype(np.int64)
        self.labels = table["label"].combine_chunks().unique()
        self.label = self.codes(table["label"].combine_chunks())
        self.by_length = {n: (at, [residues(x, p) for p in primes]) for n, at, x in by_length(table["v"].combine_chunks())}

    def codes(self, label: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(label, value_set=self.labels), -1).to_numpy(zero_copy_only=False)


def by_length(v: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, matrix) of the vectors of each length."""
    lengths = pc.list_value_length(v).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield int(n), at, v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(at), int(n))


def _tiles(block: Block, batches: Iterator[pa.RecordBatch]):
    """(anchors, scores of these with the rows, rows, their labels): rows of a batch in order of id."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        order = pc.sort_indices(table, sort_keys=[("vec_id", "ascending"), ("_row", "ascending")], null_placement="at_end")
        for part in table.take(order).combine_chunks().to_batches():
            ids, rows = part["vec_id"], part["_row"].to_numpy()
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(ids, 0).to_numpy()
            label = block.codes(part["label"])
            for n, at, x in by_length(part["v"]):
                if n in block.by_length:
                    yield block.by_length[n], at, x, (ids[at], no_id[at], rows[at]), label[at]


def _positives(block: Block, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(block.row), k)
        for (anchors, a), _, x, who, label in _tiles(block, batches):
            own = block.label[anchors]
            for code in np.intersect1d(own, label):
                mine, of = np.flatnonzero(own == code), np.flatnonzero(label == code)
                b = [residues(x[of], p) for p in block.primes]
                step = max(1, TILE // len(of))
                for lo in range(0, len(mine), step):
                    some = mine[lo:lo + step]
                    s = scores([m[some] for m in a], b, block.primes)
                    at = anchors[some]
                    s[block.row[at][:, None] == who[2][of][None, :]] = _NONE  # the anchor itself
                    best.take(at, s, *[w[of] for w in who])
        yield best.batch(block.row, np.zeros(len(block.row), np.int32))

    return run


def _negatives(block: Block, anchor: np.ndarray, slot: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """Searches (anchor's place in the block, slot) for scores from ``low`` to ``high``; of each anchor in a row."""
    starts, ends = np.searchsorted(anchor, np.arange(len(block.row))), np.searchsorted(anchor, np.arange(len(block.row)), side="right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchor), k)
        for (anchors, a), _, x, who, label in _tiles(block, batches):
            b = [residues(x, p) for p in block.primes]
            step = max(1, TILE // max(1, len(x)))
            for lo in range(0, len(anchors), step):
                at = anchors[lo:lo + step]
                s = scores([m[lo:lo + step] for m in a], b, block.primes)
                s[block.label[at][:, None] == label[None, :]] = _NONE
                for i in range(int((ends[at] - starts[at]).max(initial=0))):
                    has = np.flatnonzero(starts[at] + i < ends[at])
                    search = starts[at][has] + i
                    t = s[has]
                    # a row worse than the last of the best so far can't come in
                    least = np.maximum(low[search], best.score[search, k - 1])
                    t[(t < least[:, None]) | (t > high[search][:, None])] = _NONE
                    open_ = np.flatnonzero((t > _NONE).any(axis=1))
                    if len(open_):
                        best.take(search[open_], t[open_], *who)
        yield best.batch(block.row[anchor], slot)

    return run


def integers(vector: Column, scale: int, limit: int = LIMIT) -> Column:
    """Each component as floor(scale * x), held within +-limit."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(limit))), F.lit(float(-limit)))).cast("int"))


def whole(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, *, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``rows(vec_id, embedding, label)``.

    Of each anchor (rows with ``is_anchor``) and each of its best ``positives``, the best ``negatives`` rows of other
    labels whose score is from ``low`` to ``high`` percent of the positive's.
    """
    spark = rows.sparkSession
    ship(spark)
    used = materialize(
        rows.where(F.col("label").isNotNull() & whole(F.col("embedding")))
        .select(F.monotonically_increasing_id().alias("_row"), F.col("vec_id").cast("long").alias("vec_id"), "label",
                integers(F.col("embedding"), scale).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("_anchor")), "scored-rows")
    square = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x)
    size = F.when(F.col("_anchor"), F.size("v") + 8)
    norm, room = used.agg(F.max(square), F.sum(size)).first()
    primes = primes_for(norm or 0)
    blocks = -(-(room or 0) * 4 * len(primes) // BLOCK_BYTES)
    block_of = F.pmod(F.xxhash64("_row"), F.lit(max(1, blocks)))
    anchors = materialize(used.where("_anchor").select("_row", "vec_id", "label", "v", block_of.alias("_block")), "anchors")
    schema = "anchor long, slot int, score long, id long, row long"
    searched = used.select("_row", "vec_id", "label", "v")

    def search(run: Callable) -> DataFrame:
        return searched.mapInArrow(run, schema)

    out = []
    for b in range(blocks):
        table = anchors.where(F.col("_block") == b).select("_row", "label", "v").orderBy("_row").toArrow()
        block = Block(table, primes)
        chosen = materialize(_best(search(_sent(spark, _positives, block, positives)), ["anchor"], positives)
                             .select("anchor", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
        s = chosen.select("anchor", "slot", "positive_score").orderBy("anchor", "slot").toArrow()
        score = s["positive_score"].to_numpy().astype(np.int64)
        place = np.searchsorted(block.row, s["anchor"].to_numpy())
        # floors of percents without leaving 64 bits
        percent = lambda x, c: c * (x // 100) + c * (x % 100) // 100
        run = _sent(spark, _negatives, block, place, s["slot"].to_numpy().astype(np.int32), -percent(-score, low), percent(score, high), negatives)
        found = _best(search(run), ["anchor", "slot"], negatives)
        out.append(materialize(found.join(chosen, ["anchor", "slot"]), "negatives"))
    result = out[0] if out else spark.createDataFrame([], "anchor long, slot int, rank int, id long, score long, positive_id long, positive_score long")
    for more in out[1:]:
        result = result.unionByName(more)
    names = anchors.select(F.col("_row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return result.join(names, "anchor").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                                               "positive_score", F.col("score").alias("negative_score"))


def _sent(spark, make: Callable, *args) -> Callable:
    """``make(*args)`` as the tasks' function, its arguments sent to the executors once."""
    held = spark.sparkContext.broadcast(args)
    return lambda batches: make(*held.value)(batches)
