"""Vector codes: product quantization whose Lloyd rounds rescan only what an update has touched.

Vectors become integers and are cut into equal consecutive parts; each part position has a codebook. A round assigns
every part to its codebook's nearest entry (squared Euclidean distance, ties to the lower index), then moves each
entry to the componentwise floor of its parts' mean; entries without parts stay. All of it is exact integer work.

Each part keeps its entry and the exact distance to it between rounds. Where that entry stayed as it was, no entry
that also stayed can have come before it, so only the moved entries are compared with the stored distance; on a tie
the lower index wins. Parts whose entry moved rescan the whole codebook.

A round is one pass over a written table: tasks write the rows with their new codes and distances and, as rows of
their own, their sums and counts by entry. Spark adds those up by (part, entry, position); only codebooks, which are
bounded by entries x length for each length of vectors, pass through the driver. Lost executors repeat tasks, not rounds.

Defined cases: vectors that are null or hold a null or non-finite component are dropped; vectors of another length
have codebooks of their own; a length that the parts don't divide gives the first parts one component more; an empty
vector has code 0 in every part and no error; fewer rows than entries give smaller codebooks; entries start in the
order of id, null ids last, then of components; components beyond +-``LIMIT`` after scaling are held there; columns
other than those named aren't read. Without rows there is no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tripgate.llm.common import materialize, ship, small
from tripgate.llm.negatives import by_length, integers, whole

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LIMIT = 1 << 24
#: Codebooks that are sent to the executors together; lengths beyond it go in further turns.
BOOK_BYTES = 32 << 20
_EXACT = 1 << 53

#: Of each length of vectors: its codebooks by part, [entries, components of the part].
Books = dict[int, list[np.ndarray]]


def cuts(length: int, parts: int) -> list[slice]:
    """Consecutive parts; the first ones get what doesn't divide."""
    ends = np.cumsum([0] + [length // parts + (i < length % parts) for i in range(parts)])
    return [slice(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances [rows, entries]; in double precision where its 53 bits hold them."""
    reach = 2 * int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    if reach * reach * max(1, x.shape[1]) < _EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, distance) of the nearest entry, the lowest of equals."""
    d = distances(x, entries)
    code = d.argmin(axis=1)
    return code, d[np.arange(len(x)), code]


def reassign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and distances after the entries in ``moved`` changed."""
    code, dist = code.copy(), dist.copy()
    loose = moved[code]
    if loose.any():
        code[loose], dist[loose] = nearest(x[loose], entries)
    which, held = np.flatnonzero(moved), np.flatnonzero(~loose)
    if len(which) and len(held):
        i, d = nearest(x[held], entries[which])
        i = which[i]
        better = (d < dist[held]) | ((d == dist[held]) & (i < code[held]))
        code[held[better]], dist[held[better]] = i[better], d[better]
    return code, dist


_LONGS = T.ArrayType(T.LongType())
#: What a round adds to the rows (code, dist), and the rows of sums.
_ADDED = T.StructType().add("code", T.BinaryType()).add("dist", _LONGS).add("_length", T.IntegerType()).add("_part", T.IntegerType()).add(
    "_entry", T.IntegerType()).add("_n", T.LongType()).add("_sums", _LONGS)


def _assign(books: Books, moved: dict[int, list[np.ndarray]] | None, parts: int, schema: pa.Schema):
    """Tasks of one round: rows with codes, then one row of sums for each entry that has parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {n: [np.zeros_like(b) for b in book] for n, book in books.items()}
        counts = {n: [np.zeros(len(b), np.int64) for b in book] for n, book in books.items()}
        for batch in batches:
            v = batch["v"]
            codes, dist = np.zeros((len(v), parts), np.int64), np.zeros((len(v), parts), np.int64)
            if moved is not None and len(v):
                codes[:] = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(len(v), parts)
                dist[:] = batch["dist"].flatten().to_numpy(zero_copy_only=False).reshape(len(v), parts)
            for n, at, x in by_length(v):
                for p, cut in enumerate(cuts(n, parts)):
                    part, entries = x[:, cut], books[n][p]
                    if moved is None:
                        c, d = nearest(part, entries)
                    else:
                        c, d = reassign(part, entries, moved[n][p], codes[at, p], dist[at, p])
                    codes[at, p], dist[at, p] = c, d
                    counts[n][p] += np.bincount(c, minlength=len(entries))
                    order = np.argsort(c, kind="stable")
                    found, first = np.unique(c[order], return_index=True)
                    if part.shape[1]:
                        sums[n][p][found] += np.add.reduceat(part[order], first, axis=0)
            yield _batch(batch.select(["vec_id", "label", "v"]), codes, dist)
        yield _sum_batch(sums, counts)

    def _batch(rows: pa.RecordBatch, codes: np.ndarray, dist: np.ndarray) -> pa.RecordBatch:
        n = len(rows["v"])
        code = pa.array([r.tobytes() for r in codes.astype(np.uint8)], pa.binary())
        ends = pa.array(np.arange(n + 1) * parts, pa.int32())
        return _like(n, vec_id=rows["vec_id"], label=rows["label"], v=rows["v"], code=code, dist=pa.ListArray.from_arrays(ends, pa.array(dist.ravel())))

    def _sum_batch(sums: Books, counts: Books) -> pa.RecordBatch:
        all_ = [(n, p, e, int(counts[n][p][e]), sums[n][p][e].tolist()) for n in sums for p in range(parts) for e in np.flatnonzero(counts[n][p])]
        length, part, entry, count, total = zip(*all_, strict=True) if all_ else ((),) * 5
        return _like(len(all_), _length=pa.array(length, pa.int32()), _part=pa.array(part, pa.int32()), _entry=pa.array(entry, pa.int32()),
                     _n=pa.array(count, pa.int64()), _sums=pa.array(total, pa.list_(pa.int64())))

    def _like(n: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.record_batch([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    return run


def _first_books(rows: DataFrame, parts: int, entries: int) -> Books:
    """The parts of the rows with the smallest ids, of each length."""
    by = Window.partitionBy(F.size("v")).orderBy(F.col("vec_id").asc_nulls_last(), F.col("v"))
    first = rows.withColumn("_at", F.row_number().over(by)).where(F.col("_at") <= entries).select("_at", "v").orderBy("_at").toArrow()
    return {n: [x[:, cut] for cut in cuts(n, parts)] for n, _, x in by_length(first["v"].combine_chunks())}


def _updated(state: DataFrame, books: Books) -> tuple[Books, dict[int, list[np.ndarray]]]:
    """Entries at the floored means of their parts, and which of them moved."""
    sums = (state.where("_part is not null").select("_length", "_part", "_entry", "_n", F.posexplode_outer("_sums").alias("_pos", "_x"))
            .groupBy("_length", "_part", "_entry", "_pos").agg(F.sum("_n").alias("n"), F.sum("_x").alias("total")))
    new = {n: [b.copy() for b in book] for n, book in books.items()}
    t = sums.where("_pos is not null").toArrow()
    n, p, e, pos, count, total = (t[c].to_numpy() for c in ("_length", "_part", "_entry", "_pos", "n", "total"))
    for length in books:
        for part in range(len(books[length])):
            at = (n == length) & (p == part)
            new[length][part][e[at], pos[at]] = total[at] // count[at]
    moved = {k: [(a != b).any(axis=1) for a, b in zip(new[k], books[k], strict=True)] for k in books}
    return new, moved


def _fitted(spark: SparkSession, rows: DataFrame, books: Books, parts: int, rounds: int) -> tuple[DataFrame, Books]:
    moved, state = None, rows
    schema = T.StructType([T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("label", rows.schema["label"].dataType), T.StructField("v", T.ArrayType(T.IntegerType())), *_ADDED])
    for turn in range(rounds + 1):
        held = spark.sparkContext.broadcast((books, moved, parts, to_arrow_schema(schema)))
        state = materialize(state.mapInArrow(lambda batches, held=held: _assign(*held.value)(batches), schema), "codes")
        if turn < rounds:
            books, moved = _updated(state, books)
            state = state.where("_part is null").select("vec_id", "label", "v", "code", "dist")
    return state.where("_part is null"), books


def digest(book: list[np.ndarray]) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for part in book for x in part.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, *, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, label, code (binary, an index for each part), error, label_error, length, codebooks_sha256`` of ``vectors(vec_id, embedding, label)``."""
    if not 1 <= entries <= 256:
        raise ValueError("an index must fit one byte")
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.where(whole(F.col("embedding"))).select("vec_id", "label", integers(F.col("embedding"), scale, LIMIT).alias("v"))
    books = _first_books(rows, parts, entries)
    turns: list[list[int]] = []
    room = 0
    for n in sorted(books):
        room += 8 * entries * max(n, 1)
        if not turns or room > BOOK_BYTES:
            turns.append([])
            room = 8 * entries * max(n, 1)
        turns[-1].append(n)
    done, digests = [], []
    for lengths in turns:
        mine = rows if len(turns) == 1 else rows.where(F.size("v").isin(lengths))
        coded, final = _fitted(spark, mine, {n: books[n] for n in lengths}, parts, rounds)
        done.append(coded)
        digests += [(n, digest(book)) for n, book in final.items()]
    error = F.aggregate("dist", F.lit(0).cast("long"), lambda s, x: s + x)
    empty = rows.limit(0).select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"), F.lit(0).alias("length"))
    out = empty
    for i, coded in enumerate(done):
        part = coded.select("vec_id", "label", "code", error.alias("error"), F.size("v").alias("length"))
        out = part if i == 0 else out.unionByName(part)
    by_label = materialize(out.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "_label")
    books_of = F.broadcast(spark.createDataFrame(digests, "length int, codebooks_sha256 string"))  # one row a length
    return (out.join(small(by_label, by_label.count(), 48), F.col("label").eqNullSafe(F.col("_label"))).drop("_label").join(books_of, "length")
            .select("vec_id", "label", "code", "error", "label_error", "length", "codebooks_sha256"))
