"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one for each half of the (normalized) vectors, form a product grid; every
vector is filed in the one cell of its two nearest codewords. A vector searches the cells that
multi-sequence traversal visits first: pairs of codewords in the order of the sum of both halves'
distances. How many it visits is set by a target recall, measured on pairs of exactly the least
cosine around sampled vectors, where neighbours fall furthest apart. What is found is verified by the cosine in double precision,
so no reported link is below the limit.

Equal vectors are one class. A cell meets its visitors in blocks of bounded size; a block
reports for each vector how many it is linked to, and a spanning set of its links, so groups of
near copies don't leave a task as pairs. If x visits the cell of y but not the other way
round, the task in y's cell counts the link for both; so each link counts once on each side.

The codebooks and the number of visits come from a bounded sample (``SAMPLE`` vectors, by
hashed content); every vector is filed and searched. Vectors of each length have an index of their own, and a
cell's number says whose it is. Defined cases: null vectors, zero vectors, null or non-finite
components and null ids link with nothing (a null id has no component); vectors link with those of their own
length only; a vector repeated under the same id is several vectors that link with each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgate.llm.common import materialize, ship, small
from tripgate.llm.components import components

COSINE = 0.9
RECALL = 0.98
SAMPLE = 20_000
PROBES = 1_000
BLOCK = 1_024
#: Bits of a cell's number within its index; the vectors' length stands above them.
CELL_BITS = 40
#: Distances that are held at once while the number of visits is fitted.
_GRID = 1 << 24


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """k-means by Lloyd's rounds."""
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


class Index:
    """Two codebooks, and how many cells of the grid a search visits."""

    def __init__(self, sample: np.ndarray, rows: int, cosine: float = COSINE, recall: float = RECALL):
        rng = np.random.default_rng(20240)
        self.cosine = cosine
        self.half = (sample.shape[1] + 1) // 2 if sample.size else 1
        k = 1 << max(3, round(math.log2(max(8.0, math.sqrt(rows) / 7))))
        self.k = k
        if not sample.size:
            sample = np.zeros((1, 2))
        self.books = [_codebook(h, k, rng) for h in self._halves(sample)]
        self.visits = self._fitted(sample[rng.choice(len(sample), min(PROBES, len(sample)), replace=False)], rng, recall)

    def _halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.ascontiguousarray(x[:, :self.half]), np.ascontiguousarray(x[:, self.half:])]

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        return [(h * h).sum(1)[:, None] + (c * c).sum(1) - 2 * h @ c.T for h, c in zip(self._halves(x), self.books, strict=True)]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (np.argmin(d, axis=1) for d in self.distances(x))
        return a.astype(np.int64) * self.k + b

    def _fitted(self, x: np.ndarray, rng: np.random.Generator, recall: float) -> int:
        """Visits after which pairs of the least cosine, in random directions, are met from either side."""
        z = rng.normal(size=x.shape)
        z -= (z * x).sum(1)[:, None] * x
        z /= np.maximum(np.linalg.norm(z, axis=1), 1e-12)[:, None]
        y = self.cosine * x + math.sqrt(1 - self.cosine ** 2) * z
        ranks = []
        for p, q in ((x, y), (y, x)):
            a, b = self.distances(p)
            goal = self.cells(q)
            limit = a[np.arange(len(p)), goal // self.k] + b[np.arange(len(p)), goal % self.k]
            step = max(1, _GRID // self.k ** 2)
            ranks.append(np.concatenate([(a[i:i + step, :, None] + b[i:i + step, None, :] < limit[i:i + step, None, None]).sum((1, 2)) for i in range(0, len(p), step)]))
        return min(self.k ** 2 - 1, int(np.quantile(np.minimum(*ranks), recall)) + 1)

    def visited(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cells [vectors x visits], limit): the first cells of the traversal, and a distance between the last of them and the next.

        The n nearest cells of the grid lie among those whose two ranks i, j have (i + 1) (j + 1) <= n.
        """
        n = self.visits
        i, j = np.array([(i, j) for i in range(min(n + 1, self.k)) for j in range(min((n + 1) // (i + 1), self.k))]).T
        a, b = self.distances(x)
        order_a, order_b = np.argsort(a, axis=1), np.argsort(b, axis=1)
        total = np.take_along_axis(a, order_a[:, i], 1) + np.take_along_axis(b, order_b[:, j], 1)
        near = np.argsort(total, axis=1, kind="stable")[:, :n + 1]
        sums = np.take_along_axis(total, near, 1)
        cell = order_a[:, i].astype(np.int64) * self.k + order_b[:, j]
        limit = (sums[:, n - 1] + sums[:, n]) / 2 if near.shape[1] > n else np.full(len(x), np.inf)
        return np.take_along_axis(cell, near[:, :n], 1), limit

    def distance_to(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Of each vector to one cell's codewords."""
        h = self._halves(x)
        return ((h[0] - self.books[0][cell // self.k]) ** 2).sum(1) + ((h[1] - self.books[1][cell % self.k]) ** 2).sum(1)


class Indexes:
    """An index for each length of vectors, by the numbers of its cells."""

    def __init__(self, samples: dict[int, np.ndarray], rows: dict[int, int], cosine: float = COSINE, recall: float = RECALL):
        self.of = {d: Index(samples.get(d, np.zeros((0, d))), n, cosine, recall) for d, n in rows.items()}

    def parts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, positions, normalized matrix) of the vectors of each length."""
        lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
        for d in np.unique(lengths):
            at = np.flatnonzero(lengths == d)
            yield int(d), at, _matrix(column.take(pa.array(at)))

    def cells(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column), np.int64)
        for d, at, x in self.parts(column):
            out[at] = self.of[d].cells(x) + (d << CELL_BITS)
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Normalized rows in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _good(e: Column) -> Column:
    return F.coalesce(e.isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(e, lambda x: x != 0), F.lit(False))


def _identity(e: Column) -> list[Column]:
    return [F.xxhash64(e).alias("k1"), F.xxhash64(F.lit(1), e).alias("k2")]


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of ``vectors(vec_id, embedding)``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    good = rows.where(F.col("vec_id").isNotNull() & _good(F.col("embedding")))
    classes = materialize(good.groupBy(*_identity(F.col("embedding"))).agg(
        F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")), "vectors")
    of_length = {r["d"]: r["n"] for r in classes.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(of_length.values())
    # a bounded sample: its size doesn't grow with the table
    each = max(1, SAMPLE // max(1, len(of_length)))
    shares = F.create_map(*[F.lit(x) for d, rows_of in of_length.items() for x in (d, min(1 << 20, -(-each * (1 << 20) // rows_of)))]) if of_length else F.lit(None)
    in_sample = F.pmod(F.xxhash64("k1", F.lit("sample")), F.lit(1 << 20)) < (shares[F.size("embedding")] if of_length else F.lit(0))
    picked = classes.where(in_sample).select("embedding").toArrow().column(0).combine_chunks()
    samples = {d: x for d, _, x in Indexes({}, {}).parts(picked)} if len(picked) else {}
    index = spark.sparkContext.broadcast(Indexes(samples, of_length, cosine, recall))

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(index.value.cells(b.column("embedding")))], [*b.schema.names, "cell"])

    members = materialize(classes.select("cid", "copies", "embedding").mapInArrow(filed, "cid long, copies long, embedding array<float>, cell long"), "vector-cells")
    # cells in blocks of bounded size
    blocks = materialize(members.groupBy("cell").agg(F.floor((F.count(F.lit(1)) - 1) / BLOCK + 1).cast("int").alias("blocks")), "vector-blocks")
    n_blocks = blocks.count()
    filed_rows = members.join(small(blocks, n_blocks, 24), "cell").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, len(b), 1024):
                part = b.slice(i, 1024)
                for d, of, x in index.value.parts(part.column("embedding")):
                    cells = index.value.of[d].visited(x)[0] + (d << CELL_BITS)
                    at = pa.array(np.repeat(of, cells.shape[1]))
                    yield pa.RecordBatch.from_arrays([part.column(c).take(at) for c in ("cid", "copies", "embedding", "cell")] + [pa.array(cells.ravel())],
                                                     ["cid", "copies", "embedding", "own", "cell"])

    visits = members.mapInArrow(searched, "cid long, copies long, embedding array<float>, own long, cell long").join(small(blocks, n_blocks, 24), "cell")
    visits = visits.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # one stream for each partition: the members of a block, then its visitors
    both = (filed_rows.select("cell", "block", F.lit(0).alias("side"), "cid", "copies", "embedding", F.col("cell").alias("own"))
            .unionByName(visits.select("cell", "block", F.lit(1).alias("side"), "cid", "copies", "embedding", "own")))
    both = both.repartition("cell", "block").sortWithinPartitions("cell", "block", "side")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = None, None

        def result(found: _Found) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found.rows()], ["cid", "links", "root"])

        for b in batches:
            cell, block, side = (b.column(c).to_numpy() for c in ("cell", "block", "side"))
            cuts = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (block[1:] != block[:-1]) | (side[1:] != side[:-1]), [True]]))
            cid, copies = (b.column(c).to_numpy() for c in ("cid", "copies"))
            own = b.column("own").to_numpy() & ((1 << CELL_BITS) - 1)
            for i, j in zip(cuts, cuts[1:], strict=False):
                if (cell[i], block[i]) != key:
                    if held is not None and held.links:
                        yield result(held)
                    key, held = (cell[i], block[i]), _Found(index.value.of[int(cell[i]) >> CELL_BITS])
                x = _matrix(b.column("embedding").slice(i, j - i))
                if side[i] == 0:
                    held.add(x, cid[i:j], copies[i:j], cell[i] & ((1 << CELL_BITS) - 1))
                else:
                    for k in range(i, j, BLOCK):
                        at = slice(k, min(j, k + BLOCK))
                        held.visit(x[k - i:k - i + BLOCK], cid[at], copies[at], own[at])
        if held is not None and held.links:
            yield result(held)

    found = materialize(both.mapInArrow(met, "cid long, links long, root long"), "vector-links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = materialize(components(found.select(F.col("cid").alias("u"), F.col("root").alias("v"))), "vector-components")
    result = (classes.select("k1", "k2", "cid", "copies").join(counts, "cid", "left")
              .join(joined.withColumnRenamed("id", "cid"), "cid", "left")
              .select(F.col("k1").alias("_1"), F.col("k2").alias("_2"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                      F.coalesce("component_id", "cid").alias("component_id")))
    mark = F.col("vec_id").isNotNull() & _good(F.col("embedding"))
    keyed = rows.select("vec_id", mark.alias("good"), *_identity(F.col("embedding")))
    return (keyed.join(small(result, n, 40), (F.col("k1") == F.col("_1")) & (F.col("k2") == F.col("_2")) & F.col("good"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


class _Found:
    """The links that one block's members have with its visitors."""

    def __init__(self, index: Index):
        self.index, self.links, self.root = index, {}, {}
        self.parts: list[tuple] = []
        self.x = None

    def add(self, x: np.ndarray, cid: np.ndarray, copies: np.ndarray, cell: int) -> None:
        self.parts.append((x, cid, copies))
        self.cell, self.x = cell, None

    def _ready(self) -> None:
        if self.x is None:
            self.x, self.cid, self.copies = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            self.limit = self.index.visited(self.x)[1]

    def visit(self, x: np.ndarray, cid: np.ndarray, copies: np.ndarray, own: np.ndarray) -> None:
        self._ready()
        q, m = np.nonzero((x @ self.x.T >= self.index.cosine) & (cid[:, None] != self.cid[None, :]))
        if not len(q):
            return
        links, root = self.links, self.root
        # of a link that only the visitor finds, the member hears here
        alone = self.index.distance_to(self.x[m], own[q]) > self.limit[m]
        for ids, n in ((cid, np.bincount(q, weights=self.copies[m], minlength=len(cid))),
                       (self.cid, np.bincount(m[alone], weights=copies[q[alone]], minlength=len(self.cid)))):
            for c, k in zip(ids.tolist(), n.astype(np.int64).tolist(), strict=True):
                if k:
                    links[c] = links.get(c, 0) + k
        # a spanning set: every linked vector points to the least it reaches within the block
        ids, at = np.unique(np.concatenate([cid[q], self.cid[m]]), return_inverse=True)
        u, v, least = at[:len(q)], at[len(q):], ids.copy()
        while True:
            low = np.minimum(least[u], least[v])
            new = least.copy()
            np.minimum.at(new, u, low)
            np.minimum.at(new, v, low)
            if (new == least).all():
                break
            least = new
        for c, r in zip(ids.tolist(), least.tolist(), strict=True):
            if c != r:
                root.setdefault(c, set()).add(r)
            links.setdefault(c, 0)

    def rows(self) -> tuple[list[int], list[int], list[int]]:
        out = [(c, n, c) for c, n in self.links.items() if n] + [(c, 0, r) for c, rs in self.root.items() for r in rs]
        return tuple(list(x) for x in zip(*out, strict=True)) if out else ([], [], [])
