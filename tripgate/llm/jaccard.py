"""N-gram Jaccard join by T-occurrence search over inverted lists, DivideSkip style.

Two sets of n and m shingles reach similarity s only with T = s / (1 + s) x (n + m) common
ones. Under one global order of the shingles, a document searches the lists of its first
n - ceil(s n) + 1 shingles (its short lists); the rest are its long ones, which are never
merged. Merging short lists and counting occurrences is a grouped join on the shingle
(Spark's sorted merge); a pair whose count plus all that its long lists could add stays
below T is dropped, and the others are decided exactly by binary probes of one sorted
set in the other.

The order puts shingles with overly long lists last, so that lines and passages shared by
many documents aren't merged at all unless a document has little else. Groups of copies
are kept from squaring: equal sets are one class; each list first links its members to its
most typical one only (verified), and later only members of different components meet. Thus all
links between components are found, while links within one needn't be listed. Whether a common shingle
can be a pair's first one depends on sizes and places alone, so that is decided for cells of
equal size and place before any two documents meet: a passage that many documents share makes no pairs
of documents that couldn't link.

Full shingle sets are not stored or shuffled; they are made again from the texts of the documents that
are verified. Sides of joins are broadcast only under a counted size bound.

Defined cases: null and empty texts have 0 shingles and link with nothing; fewer than five
words make one shingle; a null id belongs to the component of its equal texts (null if
there are none with an id); rows that repeat an id count as one document whose links add
up; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgate.llm.common import materialize, ship, small
from tripgate.llm.components import components
from tripgate.llm.wordhash import mixed, stretches, word_hashes

SHINGLE = 5
PERCENT = 80
#: Shingles of more sets than this come last in the order.
LONG = 80
MOST_LONG = 4_000_000
#: Documents of a shingle that are verified together, on each side.
BLOCK_SIDE = 200
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (int64) of each text."""
    count, hashes = word_hashes(texts)
    h = hashes[:, 0]
    first = np.concatenate([[0], np.cumsum(count)])
    both = h.copy()
    for k in range(1, SHINGLE):
        both = (both[:max(0, len(h) - k)] ^ (both[:max(0, len(h) - k)] >> np.uint64(31))) * _MIX + h[k:]
    both = mixed(both)
    out = []
    for i, n in enumerate(count):
        a = first[i]
        if n >= SHINGLE:
            s = np.sort(both[a:a + n - SHINGLE + 1].view(np.int64))
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[a:a + n].tobytes(), seed=int(n))], dtype=np.uint64).view(np.int64))
        else:
            out.append(np.zeros(0, dtype=np.int64))
    return out


def _batches(b: pa.RecordBatch, rows: int = 256) -> Iterator[tuple[int, int]]:
    return ((i, min(i + rows, len(b))) for i in range(0, len(b), rows))


def needed(n: np.ndarray | int, percent: int):
    """Shingles of a set of n in its short lists."""
    return n - (-(-n * percent // 100)) + 1


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate([*arrays, np.zeros(0, dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int64()))


def frequent(docs: DataFrame, least: int, most: int = MOST_LONG) -> np.ndarray:
    """Shingles to put last in the order: those of more than ``least`` different sets, as far as their counts show it.

    Each task counts in stretches of some thousand documents and reports what occurs three times there,
    so the table is small. The order decides the cost of the search, never its result. Above ``most``
    shingles only the more frequent ones are put last, so that the list can be sent to all executors.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, met = [], 0, set()

        def report() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate([*held, np.zeros(0, dtype=np.int64)]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h[n > 2]), pa.array(n[n > 2].astype(np.int64))], ["h", "n"])

        for b in batches:
            for i, j in stretches(b.column("text")):
                for s in shingle_sets(b.column("text").slice(i, j - i)):
                    key = xxhash.xxh3_64_intdigest(s.tobytes())
                    if key not in met:
                        met.add(key)
                        held.append(s)
                        size += len(s)
                if size > 2_000_000:
                    yield report()
                    held, size, met = [], 0, set()
        yield report()

    table = materialize(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(counted, "h long, n long")
                        .groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > least), "jaccard-frequent")
    while table.where(F.col("n") > least).count() > most:
        least *= 2
    return np.sort(np.array([r["h"] for r in table.where(F.col("n") > least).select("h").toLocalIterator()], dtype=np.int64))


def signatures(docs: DataFrame, percent: int = PERCENT, last: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n, k1, k2, short, end): size and 128-bit identity of each whole text's set, its short lists in order, and the place of the last in the order."""
    late = docs.sparkSession.sparkContext.broadcast(np.zeros(0, dtype=np.int64) if last is None else last)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        long = late.value
        for b in batches:
            for i, j in stretches(b.column("text")):
                sets = shingle_sets(b.column("text").slice(i, j - i))
                keys = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
                short, marks = [], []
                for s in sets:
                    p = needed(len(s), percent) if len(s) else 0
                    is_long = long[np.minimum(np.searchsorted(long, s), len(long) - 1)] == s if len(long) else np.zeros(len(s), dtype=bool)
                    at = np.concatenate([np.flatnonzero(~is_long), np.flatnonzero(is_long)])[:p]
                    short.append(s[at])
                    marks.append(bool(p and is_long[at[-1]]))
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(i, j - i),
                    pa.array([len(s) for s in sets], type=pa.int32()),
                    pa.array(np.array([k >> 64 for k in keys], dtype=np.uint64).view(np.int64)),
                    pa.array(np.array([k & (1 << 64) - 1 for k in keys], dtype=np.uint64).view(np.int64)),
                    _lists(short), pa.array(marks)], ["doc_id", "n", "k1", "k2", "short", "late"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        signed, "doc_id long, n int, k1 long, k2 long, short array<long>, late boolean")


def _in_blocks(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (h, block, side, the columns of ``docs``, with): ``docs`` go to where their pairs (a, b, h) are.

    The pairs that share h form a rectangle that is cut into blocks of some hundred documents a side, and
    each block gets each of its documents once: those of side 0 first, then those of side 1 ``with`` the
    ids they are to be held against.
    """
    pairs = materialize(pairs.groupBy("a", "b").agg(F.min("h").alias("h")), "pairs")
    # sides of more than one block; the documents of a side are counted, however few are on the other
    wide = [pairs.select("h", x).distinct().groupBy("h").agg((F.floor(F.count(F.lit(1)) / BLOCK_SIDE) + 1).cast("int").alias(f"g_{x}")).where(f"g_{x} > 1")
            for x in "ab"]
    placed = pairs.join(wide[0], "h", "left").join(wide[1], "h", "left").fillna(1, ["g_a", "g_b"]).withColumn(
        "block", F.pmod(F.xxhash64("a"), F.col("g_a")) * F.col("g_b") + F.pmod(F.xxhash64("b"), F.col("g_b")))
    placed = materialize(placed.groupBy("h", "block", "b").agg(F.collect_list("a").alias("with")), "pair-blocks")
    size = placed.agg(F.coalesce(F.sum(F.size("with") * 8 + 40), F.lit(0))).first()[0]
    firsts = placed.select("h", "block", F.explode("with").alias("doc_id")).distinct()
    own = [F.col(c) for c in docs.columns]
    rows = docs.join(small(firsts, size, 1), "doc_id").select("h", "block", F.lit(0).alias("side"), *own, F.lit(None).cast("array<bigint>").alias("with"))
    rows = rows.unionByName(docs.join(small(placed, size, 1), F.col("doc_id") == F.col("b")).select("h", "block", F.lit(1).alias("side"), *own, "with"))
    return rows.repartition("h", "block").sortWithinPartitions("h", "block", "side")


def _held_against(rows: DataFrame, entries, decide) -> DataFrame:
    """The pairs (a, b, h) that ``decide(entries of some a, entry of b)`` accepts; ``entries`` makes them from a batch.

    Partitions are read as streams that hold the entries of one block side at a time.
    """

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for batch in batches:
            for i, j in stretches(batch.column("text")) if "text" in batch.schema.names else _batches(batch):
                part = batch.slice(i, j - i)
                out = [], [], []
                columns = [part.column(c).to_pylist() for c in ("h", "block", "side", "doc_id", "with")]
                for h, block, side, doc, others, s in zip(*columns, entries(part), strict=True):
                    if (h, block) != key:
                        key, held = (h, block), {}
                    if not side:
                        held.setdefault(doc, []).append(s)  # more than one only where an id repeats
                        continue
                    of = [(a, x) for a in others for x in held.get(a, ())]
                    for (a, _), yes in zip(of, decide([x for _, x in of], s), strict=True):
                        if yes:
                            for column, value in zip(out, (a, doc, h), strict=True):
                                column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in out], ["a", "b", "h"])

    return rows.mapInArrow(probed, "a long, b long, h long")


def verify(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity; ``pairs`` also has ``h``, a shingle they share."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = _held_against(_in_blocks(pairs, texts), lambda part: shingle_sets(part.column("text")), lambda xs, y: linked(xs, y, percent))
    return found.select("a", "b").distinct()


def promising(pairs: DataFrame, signs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b, h) that their short lists don't rule out: common shingles are counted, and the long lists could add the rest.

    Short lists are about a fifth of the sets, so this spares most of the texts their way.
    """

    def entries(part: pa.RecordBatch) -> list[tuple]:
        short = part.column("short")
        ends = short.offsets.to_numpy()
        every = short.values.to_numpy(zero_copy_only=False)
        return [(np.sort(every[i:j]), n, (late, int(every[j - 1]))) for i, j, n, late in zip(
            ends[:-1], ends[1:], part.column("n").to_pylist(), part.column("late").to_pylist(), strict=True)]

    def possible(xs: list[tuple], y: tuple) -> list[bool]:
        out = []
        for shared, (_, n, end) in zip(common([x[0] for x in xs], y[0]), xs, strict=True):
            rest = -(-(n if end <= y[2] else y[1]) * percent // 100) - 1
            out.append((100 + percent) * (int(shared) + rest) >= percent * (n + y[1]))
        return out

    return _held_against(_in_blocks(pairs, signs.select("doc_id", "n", "short", "late")), entries, possible)


def common(xs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """How many values of each sorted set another has, by binary probes."""
    size = np.fromiter(map(len, xs), dtype=np.int64, count=len(xs))
    if not len(y) or not size.sum():
        return np.zeros(len(xs), dtype=np.int64)
    every = np.concatenate(xs)
    hit = y[np.minimum(np.searchsorted(y, every), len(y) - 1)] == every
    ends = np.cumsum(size)
    sums = np.concatenate([[0], np.cumsum(hit)])
    return sums[ends] - sums[ends - size]


def linked(xs: list[np.ndarray], y: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Which of the sorted sets reach the similarity with another."""
    size = np.fromiter(map(len, xs), dtype=np.int64, count=len(xs))
    both = common(xs, y)
    return (size > 0) & (100 * both >= percent * (size + len(y) - both))


def _possible(found: Column, percent: int) -> Column:
    """T-occurrence with what the long lists could add: those of the set whose short lists end first hold all that is left."""
    n = F.when(F.col("end_a") <= F.col("end_b"), F.col("n_a")).otherwise(F.col("n_b"))
    rest = F.ceil(n * percent / 100) - 1
    return ((100 + percent) * (found + rest) >= percent * (F.col("n_a") + F.col("n_b"))) & _sizes(percent)


def _sizes(percent: int) -> Column:
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def _first(percent: int) -> Column:
    """Whether a common shingle at these places can be the first: it and all after it must reach T in both sets."""
    left = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    return (100 + percent) * left >= percent * (F.col("n_a") + F.col("n_b"))


def _sides(df: DataFrame, side: str) -> DataFrame:
    return df.select("h", *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c != "h"])


def open_cells(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(h, n_a, pos_a, n_b, pos_b): cells of a list, in order, between which a first common shingle can link two components."""
    cells = rows.groupBy("h", "n", "pos").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    one_component = (F.col("low_a") == F.col("high_a")) & (F.col("low_b") == F.col("high_b")) & (F.col("low_a") == F.col("low_b"))
    in_order = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("pos_a") <= F.col("pos_b")))
    return (_sides(cells, "a").join(_sides(cells, "b"), "h").where(in_order & _sizes(percent) & _first(percent) & ~one_component)
            .select("h", "n_a", "pos_a", "n_b", "pos_b"))


def meetings(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of different components that share a shingle early enough in both sets to be linked.

    ``rows(h, cid, n, pos, end, comp)`` are postings. What decides whether a common shingle can be a pair's first one is
    size and place alone, so the cells (n, pos) of a list meet first, then the components in two
    cells that pass, then their documents: documents that share a passage without being able to link, and those of
    one component, never meet. Returns a, b, n, end of both, a common shingle h, ``found`` (common shingles
    that can be first) and ``later`` (at most so many more lie behind them in the short lists).
    """
    same_cell = (F.col("n_a") == F.col("n_b")) & (F.col("pos_a") == F.col("pos_b"))
    comps = rows.select("h", "n", "pos", "comp").distinct()
    met = (open_cells(rows, percent).join(_sides(comps, "a"), ["h", "n_a", "pos_a"]).join(_sides(comps, "b"), ["h", "n_b", "pos_b"])
           .where((F.col("comp_a") != F.col("comp_b")) & (~same_cell | (F.col("comp_a") < F.col("comp_b")))))
    pairs = (met.join(_sides(rows, "a"), ["h", "n_a", "pos_a", "comp_a"]).join(_sides(rows, "b"), ["h", "n_b", "pos_b", "comp_b"])
             .where("cid_a <> cid_b"))
    ordered = F.col("cid_a") < F.col("cid_b")
    pick = lambda c, x, y: F.when(ordered, F.col(f"{c}_{x}")).otherwise(F.col(f"{c}_{y}"))
    turned = pairs.select("h", *[pick(c, *sides).alias(name) for c, first, second in (("cid", "a", "b"), ("n", "n_a", "n_b"), ("end", "end_a", "end_b"), ("pos", "pos_a", "pos_b"))
                                 for name, sides in ((first, "ab"), (second, "ba"))])
    left = lambda x: F.col(f"n_{x}") - F.ceil(F.col(f"n_{x}") * percent / 100) - F.max(f"pos_{x}")
    return turned.groupBy("a", "b", "n_a", "n_b", "end_a", "end_b").agg(
        F.count(F.lit(1)).alias("found"), F.min("h").alias("h"), F.least(left("a"), left("b")).alias("later"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, long: int = LONG) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of ``docs``."""
    ship(docs.sparkSession)
    signs = materialize(signatures(docs, percent, frequent(docs, long)), "jaccard-signatures")
    reps = materialize(signs.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("cid")), "jaccard-classes")
    n_reps = reps.count()
    own = signs.select("doc_id", "n", "k1", "k2", "short", "late").join(
        small(reps.where("cid is not null"), n_reps, 48).withColumnRenamed("cid", "doc_id"), ["doc_id", "n", "k1", "k2"], "left_semi")
    end = F.struct("late", F.element_at("short", -1).alias("h"))
    postings = own.select(F.posexplode("short").alias("pos", "h"), F.col("doc_id").alias("cid"), "n", end.alias("end"))

    shared = materialize(postings.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("h"), "jaccard-lists")
    lists = materialize(postings.join(small(shared, shared.count(), 16), "h", "left_semi").distinct(), "jaccard-postings")

    # every list links its members to its most typical one: the one with the most shared shingles
    typical = lists.groupBy("cid").agg((F.count(F.lit(1)) / F.max("n")).alias("share"))
    head = lists.join(typical, "cid").groupBy("h").agg(F.min_by(
        F.struct("cid", "n", "end"), F.struct((-F.col("share")).alias("s"), "cid")).alias("r")).select(
        "h", F.col("r.cid").alias("a"), F.col("r.n").alias("n_a"), F.col("r.end").alias("end_a"))
    stars = (lists.select("h", F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("end").alias("end_b")).join(head, "h").where("a <> b")
             .groupBy("a", "b", "n_a", "n_b", "end_a", "end_b").agg(F.count(F.lit(1)).alias("found"), F.min("h").alias("h"))
             .where(_possible(F.col("found"), percent)))
    links = materialize(verify(stars, docs, percent), "jaccard-stars")
    joined = materialize(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "jaccard-joined")
    n_joined = joined.count()

    def with_component(df: DataFrame) -> DataFrame:
        known = small(joined.select(F.col("id").alias("cid"), F.col("component_id").alias("comp")), n_joined, 32)
        return df.join(known, "cid", "left").select("h", "cid", "n", "pos", "end", F.coalesce("comp", "cid").alias("comp"))

    # members of different components meet in the lists that still hold several
    members = with_component(lists)
    several = materialize(members.select("h", "comp").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("h"), "jaccard-mixed")
    rows = materialize(members.join(small(several, several.count(), 16), "h", "left_semi"), "jaccard-met")
    met = promising(meetings(rows, percent).where(_possible(F.col("found") + F.col("later"), percent)), own, percent)
    more = materialize(verify(met, docs, percent), "jaccard-links")
    every = components(links.unionByName(more).select(F.col("a").alias("u"), F.col("b").alias("v")))
    every = materialize(every, "jaccard-components")
    placed = small(reps, n_reps, 48).withColumnRenamed("cid", "_cid")
    return (signs.select("doc_id", "n", "k1", "k2").join(placed, ["n", "k1", "k2"], "left")
            .join(small(every, every.count(), 32), F.col("_cid") == F.col("id"), "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "_cid", "doc_id").alias("component_id")))
