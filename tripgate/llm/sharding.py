"""Sharding by extendible hashing.

A record's key is 60 bits: 40 of the md5 of its id, then 20 that also depend on its place
in the input, which only matter where one id repeats past a shard's size. The directory is
indexed by the first bits of the key; a bucket over the byte limit splits on its next bit,
and all others stay whole, so each shard is named by its own prefix (its local depth).

The directory is built from byte sums of fine prefixes, not from records: all prefixes of
all depths are summed at once, and a prefix is a bucket when it fits and the prefix above, which is the sum of two
siblings, doesn't. A bucket takes up all directory entries that begin with its bits. A cell that is
oversized even at the finest depth of a level is taken up by the next, deeper level.
Only DataFrame functions run, and nothing but level sizes reaches the driver. No key has more
than two rows to itself but the sums, which are added up before they are shuffled.

Up to 40 bits a key is a function of the id alone. Records that need more are written once with the
numbers that their last bits come from, so no later scan can deal them anew.

Defined cases: null and empty texts weigh 0 bytes and are placed; a null id is one more id;
repeated rows are placed each (they part on the last 20 bits if need be); a single record
over the limit can't be split and is a shard by itself; an empty table gives no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgate.llm.common import materialize, small

KEY_BITS, ID_BITS = 60, 40
SHARD_BYTES = 1 << 20
_FINER = 5


def _bits(hex_text: Column, first: int, digits: int) -> Column:
    return F.conv(F.substring(hex_text, first, digits), 16, 10).cast("long")


def hashed(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Adds ``_hi`` (40 bits of the id) and ``n_bytes``."""
    key = F.coalesce(F.col(id_column).cast("string"), F.lit("null"))
    return docs.withColumns({
        "_hi": _bits(F.md5(key.cast("binary")), 1, ID_BITS // 4),
        "n_bytes": F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")})


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``_lo``, 20 bits of the id and the row's place, written once."""
    place = F.md5(F.concat_ws(":", "_hi", F.monotonically_increasing_id()).cast("binary"))
    return materialize(rows.withColumn("_lo", _bits(place, 1, (KEY_BITS - ID_BITS) // 4)), "shard-repeated-ids")


def prefix(depth: int) -> Column:
    """The first ``depth`` bits of the key as a number."""
    if depth <= ID_BITS:
        return F.shiftright("_hi", ID_BITS - depth)
    return F.shiftleft("_hi", depth - ID_BITS).bitwiseOR(F.shiftright("_lo", KEY_BITS - depth))


def _level(cells: DataFrame, finest: int, coarsest: int, limit: int) -> DataFrame:
    """Directory entries (cell, depth, shard_bytes) of one level; depth is null where even the cell is oversized.

    ``cells`` has (cell, bytes, n): sums and records of the prefixes of ``finest`` bits. Whatever
    is above ``coarsest`` is known to be oversized.
    """
    up = cells.select(F.explode(F.sequence(F.lit(coarsest), F.lit(finest))).alias("depth"), "cell", "bytes", "n")
    sums = up.groupBy("depth", F.expr(f"shiftright(cell, {finest} - depth)").alias("bucket")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    fits = lambda c: (c["bytes"] <= limit) | (c["n"] == 1)
    siblings = sums.groupBy("depth", F.shiftright("bucket", 1).alias("above")).agg(
        F.collect_list(F.struct("bucket", "bytes", "n")).alias("children"), F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    above_is_over = (F.col("depth") == coarsest) | ~fits({"bytes": F.col("bytes"), "n": F.col("n")})
    judged = siblings.where(above_is_over).select("depth", F.explode("children").alias("c"))
    first = F.expr(f"shiftleft(c.bucket, {finest} - depth)")
    entries = judged.where(fits(F.col("c"))).select(
        F.explode(F.sequence(first, first + F.expr(f"shiftleft(1L, {finest} - depth) - 1"))).alias("cell"), "depth", F.col("c.bytes").alias("shard_bytes"))
    over = judged.where((F.col("depth") == finest) & ~fits(F.col("c"))).select(
        F.col("c.bucket").alias("cell"), F.lit(None).cast("int").alias("depth"), F.col("c.bytes").alias("shard_bytes"))
    return entries.unionByName(over)


def shard(docs: DataFrame, limit: int = SHARD_BYTES, id_column: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: the id) with n_bytes, shard, depth and shard_bytes, a row each.

    ``shard`` is the bucket's prefix as a string of 0s and 1s ("" while one bucket holds
    all). Columns of ``docs`` named like those added are replaced.
    """
    added = ("n_bytes", "shard", "depth", "shard_bytes")
    kept = [c for c in (keep or [id_column]) if c not in added]
    rows = hashed(docs, id_column).select(*[F.col(f"`{c}`") for c in kept], "n_bytes", "_hi")
    if keep is None:
        rows = materialize(rows, "shard-keys")
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    finest = min(ID_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + _FINER)
    coarsest, waiting, parts = 0, rows, []
    while True:
        at = prefix(finest)
        cells = waiting.groupBy(at.alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
        directory = materialize(_level(cells, finest, coarsest, limit), "shard-directory")
        size, over = directory.agg(F.count(F.lit(1)), F.count_if(F.col("depth").isNull())).first()
        last = finest >= KEY_BITS
        placed = waiting.withColumn("cell", at).join(small(directory, size, 32), "cell")
        depth = F.coalesce("depth", F.lit(finest))
        done = placed if last or not over else placed.where(F.col("depth").isNotNull())
        bits = F.lpad(F.conv(F.col("cell").cast("string"), 10, 2), finest, "0")
        parts.append(done.select(*kept, "n_bytes", bits.substr(F.lit(1), depth).alias("shard"),
                                 depth.cast("int").alias("depth"), "shard_bytes"))
        if last or not over:
            break
        deep = directory.where(F.col("depth").isNull()).select("cell")
        waiting = waiting.withColumn("cell", at).join(small(deep, over, 16), "cell", "left_semi").drop("cell")
        if finest == ID_BITS:
            waiting = _numbered(waiting)
        coarsest, finest = finest + 1, min(ID_BITS if finest < ID_BITS else KEY_BITS, finest + 8)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard; rows of a shard are dealt to one writer, whose bytes the limit bounds."""
    sharded.repartition("shard").write.mode("errorifexists").partitionBy("shard").parquet(path)
